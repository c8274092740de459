"""Operator 11, byte-pair encoding and decoding by forced boundaries.

Two neighbouring bytes that stand side by side in no token of the vocabulary can't be
inside one token of an encoding either: no merge ever crosses them. Such a place is a
certain cut. Merges on its two sides don't see each other, so the fragments between
cuts are encoded each on its own and their tokens concatenated.

* ``inside`` holds, for all 256 x 256 byte pairs, whether a token has them as neighbours.
* A byte with cuts on both sides against every other byte, as white space has in a
  vocabulary of words, cuts whole texts; the tokenizer's own normaliser and splitter
  then see one part at a time.
* The pieces that the splitter finds are cut by ``inside``; the last fragment of a
  piece carries the vocabulary's end mark.

A corpus repeats its parts, so each batch is reduced to its different parts, each of
which is encoded once, and the documents are put together from them in Arrow. The work is a map
over whole texts; nothing is shuffled. A batch is taken in slices of bounded bytes (at
least one text), and the tables kept between batches are bounded by ``KEEP``.

Results: NULL and empty texts have no tokens and decode to ''. Strings of special
tokens inside texts are their ids, as the library has it by default. Repeated rows get
equal results; further columns of the input, whatever their names, are not read. An
empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import WHITE_SPACE
from custlens.llm.token_counts import byte_symbols

VOCABULARY = "word_bpe_49k.json"
SLICE_BYTES = 8 << 20
KEEP = 400_000
KEEP_BYTES = 64
SHORT = 48
NEVER = 1 << 60


class Codec:
    """Encoder and decoder of a byte-level BPE vocabulary in the library's JSON form."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE vocabulary")
        decoder = spec["decoder"] and spec["decoder"]["type"]
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"unknown decoder {decoder}")
        self.joins_bytes = decoder == "ByteLevel"
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.end = model.get("end_of_word_suffix") or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = added
        self.special_split = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.byte_table = np.zeros(1 << 16, dtype=np.uint8)
        self.byte_table[[ord(s) for s in self.byte_of]] = [*self.byte_of.values()]
        self.inside = np.zeros((256, 256), dtype=bool)
        for token in self.vocab:
            data = self.token_bytes(token)
            self.inside[list(data[:-1]), list(data[1:])] = True
        space = [ord(c) for c in WHITE_SPACE]
        certain = not (self.inside[space].any() or self.inside[:, space].any())
        self.by_parts = certain and self.pieces(f"a {WHITE_SPACE}b") == self.pieces("a") + self.pieces("b")
        self.words = self._words(added)
        self.fragments: dict[tuple[str, bool], list[int]] = {}
        self.parts: dict[bytes, bytes] = {}

    def token_bytes(self, token: str) -> bytes:
        if self.end and token.endswith(self.end) and token != self.end:
            token = token[: -len(self.end)]
        return bytes(self.byte_of[c] for c in token)

    def _words(self, added: dict[str, int]) -> pa.Array:
        """What each id decodes to: its string, or its bytes for a byte decoder."""
        out = [b""] * (max([*self.vocab.values(), *added.values()]) + 1)
        for token, i in self.vocab.items():
            out[i] = self.token_bytes(token) if self.joins_bytes else token.encode()
        for token, i in added.items():
            out[i] = token.encode()
        return pa.array(out, pa.large_binary())

    def pieces(self, text: str) -> list[str]:
        """The pieces within which merges happen, in the vocabulary's byte symbols."""
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        return [p for p, _ in self.splitter.pre_tokenize_str(text)]

    def cut(self, pieces: list[str]) -> tuple[list[str], np.ndarray]:
        """The fragments of all pieces in a row, and which of them end a piece: a piece is
        cut wherever two bytes are never neighbours inside a token."""
        joined = "".join(pieces)
        data = self.byte_table[np.frombuffer(joined.encode("utf-16-le"), dtype="<u2")]
        ends = np.cumsum([len(p) for p in pieces])
        cuts = np.ones(len(data), dtype=bool)
        cuts[:-1] = ~self.inside[data[:-1], data[1:]]
        cuts[ends - 1] = True
        at = np.flatnonzero(cuts) + 1
        last = np.zeros(len(data) + 1, dtype=bool)
        last[ends] = True
        return [joined[a:b] for a, b in zip([0, *at.tolist()], at.tolist(), strict=False)], last[at]

    def merged(self, symbols: list[str]) -> list[str]:
        """Tokens of the symbols: the best ranked pair first, from the left."""
        if len(symbols) > SHORT:
            return self._merged_long(symbols)
        get = self.rank.get
        ranks = [get(p, NEVER) for p in zip(symbols, symbols[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((symbols[i - 1], symbols[i]), NEVER)
            if i < len(ranks):
                ranks[i] = get((symbols[i], symbols[i + 1]), NEVER)
        return symbols

    def _merged_long(self, symbols: list[str]) -> list[str]:
        """The same with the pairs in a heap and the symbols in a linked list."""
        rank, n = self.rank, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := rank.get((symbols[x], symbols[y]))) is not None:
                    heapq.heappush(heap, (r, x, symbols[x], symbols[y]))
        return [s for s in symbols if s]

    def fragment(self, fragment: str, last: bool) -> list[int]:
        found = self.fragments.get((fragment, last))
        if found is None:
            symbols = list(fragment)
            if last:
                symbols[-1] += self.end
            found = [self.vocab[t] for t in self.merged(symbols)]
            if len(fragment) <= KEEP_BYTES:
                if len(self.fragments) >= KEEP:
                    self.fragments.clear()
                self.fragments[fragment, last] = found
        return found

    def of_pieces(self, pieces: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """The ids of each fragment of the pieces, and which fragments end a piece."""
        if not pieces:
            return [], np.zeros(0, dtype=bool)
        fragments, last = self.cut(pieces)
        return list(map(self.fragment, fragments, last.tolist())), last

    def ids(self, text: str) -> list[int]:
        """Token ids of a text: those of its fragments in a row."""
        out: list[int] = []
        for run in self.special_split.split(text) if self.special_split else [text]:
            if run in self.special:
                out.append(self.special[run])
            elif run:
                out += itertools.chain.from_iterable(self.of_pieces(self.pieces(run))[0])
        return out

    def new_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of the parts, as bytes. Parts that keep their places in a joined text are
        normalised, split and cut together; those with white space of other kinds or
        special tokens one by one."""
        out = [b""] * len(parts)
        plain = [i for i, p in enumerate(parts) if self.by_parts and len(p.split()) == 1 and not any(s in p for s in self.special)]
        text = " ".join([parts[i] for i in plain])
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        if len(text.split(" ")) != len(plain):
            plain = []
        if plain:
            found = self.splitter.pre_tokenize_str(text)
            of_fragment, last = self.of_pieces([p for p, _ in found])
            ends = np.cumsum([len(p) + 1 for p in text.split(" ")])
            owner = np.searchsorted(ends, [at for _, (at, _) in found], side="right")
            size = np.fromiter(map(len, of_fragment), dtype=np.int64, count=len(of_fragment))
            piece = np.cumsum(last) - last
            upto = np.cumsum(np.bincount(owner[piece], weights=size, minlength=len(plain)).astype(np.int64)) * 4
            data = np.fromiter(itertools.chain.from_iterable(of_fragment), dtype="<u4").tobytes()
            for i, a, b in zip(plain, [0, *upto.tolist()], upto.tolist(), strict=False):
                out[i] = data[a:b]
        for i in sorted({*range(len(parts))}.difference(plain)):
            out[i] = np.array(self.ids(parts[i]), dtype="<u4").tobytes()
        return out

    def known_parts(self, parts: list[bytes]) -> list[bytes]:
        """Ids of different parts; those of short parts are kept for the next batches."""
        known = [self.parts.get(p) for p in parts]
        new = [i for i, k in enumerate(known) if k is None]
        if len(self.parts) + len(new) > KEEP:
            self.parts.clear()
        for i, data in zip(new, self.new_parts([parts[i].decode() for i in new]), strict=True):
            known[i] = data
            if len(parts[i]) <= KEEP_BYTES and len(self.parts) < KEEP:
                self.parts[parts[i]] = data
        return known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place where each text begins and the last ends."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.by_parts:
            lists = pc.ascii_split_whitespace(texts)
            parts, starts = lists.flatten(), lists.offsets.to_numpy()
        else:
            parts, starts = texts, np.arange(len(texts) + 1)
        coded = parts.dictionary_encode()
        index = coded.indices.to_numpy()
        known = self.known_parts(coded.dictionary.cast(pa.large_binary()).to_pylist())
        size = np.array([len(k) // 4 for k in known], dtype=np.int64)
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        first = np.cumsum(size) - size
        ends = np.concatenate(([0], np.cumsum(size[index]))).astype(np.int64)
        at = np.repeat(first[index] - ends[:-1], size[index]) + np.arange(ends[-1])
        return flat[at], ends[starts - starts[0]]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The text of each run of ids, special tokens included."""
        words = self.words.take(pa.array(ids.astype(np.int64)))
        lists = pa.LargeListArray.from_arrays(pa.array(starts.astype(np.int64)), words)
        joined = pc.binary_join(lists, pa.scalar(b"" if self.joins_bytes else b" ", pa.large_binary()))
        if not self.joins_bytes:
            return joined.cast(pa.large_string())
        return pa.array([b.decode(errors="replace") for b in joined.to_pylist()], pa.large_string())


@functools.cache
def codec_of(path: str) -> Codec:
    """One codec for all tasks that a Python worker runs."""
    return Codec(path)


def slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(from, length) of runs of rows that hold at most ``limit`` bytes, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to - at
        at = to


def _mapped(docs: DataFrame, id_col: str, column: Column, kind: str, ddl: str, run) -> DataFrame:
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), column.cast(kind).alias("value"))
    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {id_type}, {ddl}")


def encoded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for at, n in slices(batch.column(1), slice_bytes):
                ids, starts = codec.encode(batch.column(1).slice(at, n))
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), lists], names=["doc_id", "ids"])

    return _mapped(docs, id_col, F.col(f"`{text_col}`"), "string", "ids array<int>", run)


def decoded(encoded_docs: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text): what the ids stand for; NULL for NULL ids, '' for none."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            lists = batch.column(1)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            text = codec.decode(ids, np.concatenate(([0], np.cumsum(n))))
            text = pc.if_else(lists.is_valid(), text, pa.scalar(None, pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["doc_id", "text"])

    return _mapped(encoded_docs, id_col, F.col(f"`{ids_col}`"), "array<int>", "text string", run)


def round_trip(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids as little-endian
    unsigned 32-bit integers and of the text that they decode to."""
    path = path or public_tokenizers.path(VOCABULARY)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            for at, n in slices(batch.column(1), slice_bytes):
                ids, starts = codec.encode(batch.column(1).slice(at, n))
                data = memoryview(ids.astype("<u4").tobytes())
                of_ids = [sha(data[4 * a : 4 * b]) for a, b in zip(starts, starts[1:], strict=False)]
                texts = codec.decode(ids, starts).cast(pa.large_binary())
                of_text = [sha(t.as_buffer()) for t in texts]
                columns = [batch.column(0).slice(at, n), pa.array(np.diff(starts), pa.int64()), pa.array(of_ids), pa.array(of_text)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ddl = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, id_col, F.col(f"`{text_col}`"), "string", ddl, run)
