"""Operator 5, token counts by prefix dynamic programming.

The tokenizer lower-cases, splits a text into pieces (runs of letters, single
digits, runs of other characters) and merges the bytes of each piece by ranked
pairs; the last byte of a piece carries an end mark. Such an encoding has two
properties that make every prefix countable in one pass:

* a prefix of a valid token sequence is valid;
* a sequence is valid if each two neighbours are, that is if the two tokens'
  bytes alone are encoded as just these two tokens.

So for each prefix of a piece exactly one last token fits: one that ends there and
gets on with the last token of the prefix before it. Count = that prefix's count
+ 1. ``PrefixCounter`` fills this table for each different piece once, and a document's
table is the running sum over its white-space separated parts. Truncation and budget questions are
then look-ups, and no text is encoded again.

The work is a map over whole texts; nothing is shuffled. NULL or empty text: no
tokens. Repeated rows get equal results; extra columns are ignored. Words of any
length are handled; the tables kept between documents are bounded by ``KEEP``.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
KEEP = 600_000
KEEP_BYTES = 64
END = "</w>"

# Texts of these characters only are normalised alike by Python and by the tokenizer.
PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class PrefixCounter:
    """Token counts of the prefixes of a text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.longest = max(map(len, self.vocab))
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.symbol = byte_symbols()
        self.fit: dict[tuple[str, str], bool] = {}
        self.pieces: dict[str, int] = {}
        self.parts: dict[bytes, int] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Tokens of the symbols: the best ranked pair first, from the left."""
        while len(symbols) > 1:
            ranked = [(self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False))]
            best, i = min(ranked)
            if best == 1 << 30:
                break
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def fits(self, a: str, b: str) -> bool:
        """Whether the tokens ``a`` (may be empty) and ``b`` stand side by side in an encoding."""
        found = self.fit.get((a, b))
        if found is None:
            symbols = list(a + (b[: -len(END)] if b.endswith(END) else b))
            if b.endswith(END):
                symbols[-1] += END
            found = self.merged(symbols) == ([a, b] if a else [b])
            if len(self.fit) >= KEEP:
                self.fit.clear()
            self.fit[a, b] = found
        return found

    def prefixes(self, symbols: str) -> tuple[list[str], list[int]]:
        """For each prefix without an end mark its last token and its count."""
        last, count, vocab, known = [""], [0], self.vocab, self.fit.get
        for k in range(1, len(symbols) + 1):
            for j in range(max(0, k - self.longest), k):
                token = symbols[j:k]
                if token not in vocab:
                    continue
                found = known((last[j], token))
                if self.fits(last[j], token) if found is None else found:
                    last.append(token)
                    count.append(count[j] + 1)
                    break
        return last, count

    def closed(self, symbols: str, k: int, last: list[str], count: list[int]) -> int:
        """Tokens of the first ``k`` symbols as a piece of their own, end mark included."""
        for j in range(max(0, k - self.longest), k):
            token = symbols[j:k] + END
            if token in self.vocab and self.fits(last[j], token):
                return count[j] + 1
        raise ValueError("the vocabulary lacks a byte")

    def symbols(self, piece: str) -> str:
        return "".join([self.symbol[b] for b in piece.encode()])

    def piece_table(self, piece: str) -> list[int]:
        """Counts of the prefixes of a piece by code points, from 0 to its length."""
        symbols = self.symbols(piece)
        last, count = self.prefixes(symbols)
        ends = np.cumsum([len(c.encode()) for c in piece]).tolist()
        return [0, *(self.closed(symbols, k, last, count) for k in ends)]

    def piece(self, piece: str) -> int:
        found = self.pieces.get(piece)
        if found is None:
            symbols = self.symbols(piece)
            last, count = self.prefixes(symbols[:-1])
            found = self.closed(symbols, len(symbols), last, count)
            if len(piece) <= KEEP_BYTES:
                if len(self.pieces) >= KEEP:
                    self.pieces.clear()
                self.pieces[piece] = found
        return found

    def split(self, part: str) -> list[str | None]:
        """The pieces of a part; None stands for a special token."""
        if PLAIN.fullmatch(part) and not any(s in part for s in self.special):
            return PLAIN_PIECES.findall(part.lower())
        out: list[str | None] = []
        for run in self.special_split.split(part):
            if run in self.special:
                out.append(None)
            elif run:
                out += self._pieces_of(run)
        return out

    def _pieces_of(self, run: str) -> list[str]:
        back = {s: b for b, s in enumerate(self.symbol)}
        normal = self.tokenizer.normalizer.normalize_str(run)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(back[c] for c in p).decode() for p, _ in pieces]

    def part(self, part: bytes) -> int:
        """Tokens of a part without white space of ASCII inside."""
        found = self.parts.get(part)
        if found is None:
            found = sum(1 if p is None else self.piece(p) for p in self.split(part.decode()))
            if len(part) <= KEEP_BYTES:
                if len(self.parts) >= KEEP:
                    self.parts.clear()
                self.parts[part] = found
        return found

    def table(self, text: bytes) -> np.ndarray:
        """Counts of the prefixes that end with each white-space separated part, from 0 on."""
        known, parts = self.parts.get, text.split()
        counts = [n if (n := known(p)) is not None else self.part(p) for p in parts]
        return np.cumsum([0, *counts], dtype=np.int64)

    def longest_prefix(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of ``text`` whose tokens are at most ``limit``.

        The parts' table finds the part in which the limit falls; inside that part
        the prefixes are compared one by one. A longer prefix of a part may need
        fewer tokens than a shorter one, so the longest that fits counts.
        """
        data = text.encode()
        table = self.table(data)
        if table[-1] <= limit:
            return len(text)
        at = int(np.searchsorted(table, limit, side="right")) - 1  # parts that fit whole
        spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)]
        start, end = spans[at]
        part = data[start:end].decode()
        for k in range(len(part), 0, -1):
            count = sum(1 if p is None else self.piece(p) for p in self.split(part[:k]))
            if table[at] + count <= limit:
                return len(data[:start].decode()) + k
        return len(data[:start].decode())


@functools.cache
def counter_of(path: str) -> PrefixCounter:
    """One counter for all tasks that a Python worker runs."""
    return PrefixCounter(path)


def _mapped(docs: DataFrame, id_col: str, text_col: str, path: str, fields: list[pa.Field], ddl: str, row) -> DataFrame:
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = [row(counter, t.as_py() or b"") for t in texts]
            columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, fields, strict=True))],
                names=["doc_id", *(f.name for f in fields)],
            )

    return found.mapInArrow(run, f"doc_id {id_type}, {ddl}")


def prefix_tables(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = os.path.join(TOKENIZER_DIR, VOCABULARY),
) -> DataFrame:
    """(doc_id, n_bytes, prefix_tokens): tokens up to each white-space separated part, from 0 on."""

    def row(counter: PrefixCounter, text: bytes) -> tuple:
        return len(text), counter.table(text)

    fields = [pa.field("n_bytes", pa.int64()), pa.field("prefix_tokens", pa.list_(pa.int64()))]
    return _mapped(docs, id_col, text_col, path, fields, "n_bytes long, prefix_tokens array<long>", row)


def counts(
    docs: DataFrame,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = os.path.join(TOKENIZER_DIR, VOCABULARY),
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), read off the prefix table inside the task."""

    def row(counter: PrefixCounter, text: bytes) -> tuple:
        n = int(counter.table(text)[-1])
        return len(text), n, n > limit

    fields = [pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("over_limit", pa.bool_())]
    return _mapped(docs, id_col, text_col, path, fields, "n_bytes long, n_tokens long, over_limit boolean", row)


def truncated(
    docs: DataFrame,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = os.path.join(TOKENIZER_DIR, VOCABULARY),
) -> DataFrame:
    """(doc_id, kept_chars): the longest prefix of each text within ``limit`` tokens."""

    def row(counter: PrefixCounter, text: bytes) -> tuple:
        return (counter.longest_prefix(text.decode(), limit),)

    return _mapped(docs, id_col, text_col, path, [pa.field("kept_chars", pa.int64())], "kept_chars long", row)
