"""Operator 12, alignment of two tokenizers' tokens by interval coalescing.

Both tokenizers cut the same bytes, so each token is an interval. All tokens of a
block of documents are sorted by start (``lexsort``), the running maximum of their
ends is taken (``maximum.accumulate``), and a group breaks where a start reaches that
maximum, that is where a token of A and a token of B end together. Within a group the
overlaps expand to links: a token of A meets a run of neighbouring tokens of B.

How often an id pair is linked is counted over the whole corpus:

* Both tokenizers begin a token at a blank between two words, so a block's texts are
  cut there, and each different part is encoded once.
* A task takes its texts in blocks of bounded bytes. The block's different pairs are
  kept once, with the number of its documents that hold each; a document keeps places
  in that list and multiplicities. Both are staged once, so no text is encoded twice.
* The counts are an aggregate over blocks, their maximum by A id an aggregate over the
  pairs.
* A block asks once for each of its pairs, whatever its number of documents, and
  documents meet their block's counts in a cogroup, which is as large as a block. A pair
  that every block holds is split by the adaptive join: both its sides are staged tables.

Results: a document without text, or whose joined token bytes differ from
a blank and the text in one of the tokenizers, has no tokens. Every row counts as a document of its
own, also when ids or texts repeat or are NULL. Further columns of the input, whatever
their names, are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.bpe import slices
from custlens.llm.common import stage
from custlens.llm.token_counts import byte_symbols

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20
BLANK = "▁"
KEEP, KEEP_CHARS, PARTS_AT_ONCE = 500_000, 48, 10_000

# A single blank between letters, digits, marks of ASCII: both tokenizers begin a token there.
BETWEEN = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")


class Side:
    """One tokenizer: ids of texts, and the bytes that each id stands for."""

    def __init__(self, data: list[bytes]) -> None:
        self.bytes = pa.array(data, pa.large_binary())
        self.size = np.array([len(d) for d in data], dtype=np.int64)
        names = [b"%d" % i for i in range(len(data))]
        # An id's decimal form with what follows it: nothing, then the three separators.
        self.written = pa.array([n + mark for n in names for mark in (b"", b",", b"|", b";")], pa.large_binary())
        self.kept: dict[str, bytes] = {}
        # No token goes on with a blank after another character: texts may be cut at such blanks.
        self.cuts = all(b" " not in d.lstrip(b" ") for d in data)

    def lists(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def coded(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts as 32-bit integers; those of short parts are kept for the next blocks."""
        found = [self.kept.get(p) for p in parts]
        new = [i for i, f in enumerate(found) if f is None]
        if len(self.kept) + len(new) > KEEP:
            self.kept.clear()
        for at in range(0, len(new), PARTS_AT_ONCE):
            some = new[at : at + PARTS_AT_ONCE]
            for i, ids in zip(some, self.lists([parts[i] for i in some]), strict=True):
                found[i] = array("i", ids).tobytes()
                if len(parts[i]) <= KEEP_CHARS and len(self.kept) < KEEP:
                    self.kept[parts[i]] = found[i]
        return found

    def encode(self, parts: list[str], index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and the last ends. Text
        ``i`` is the parts ``index[starts[i]:starts[i + 1]]``."""
        known = self.coded(parts)
        size = np.array([len(k) // 4 for k in known], dtype=np.int64)
        flat = np.frombuffer(b"".join(known), dtype=np.int32)
        ends = np.concatenate(([0], np.cumsum(size[index]))).astype(np.int64)
        at = np.repeat((np.cumsum(size) - size)[index] - ends[:-1], size[index]) + np.arange(ends[-1])
        return flat.astype(np.int64)[at], ends[starts]

    def joined(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        lists = pa.LargeListArray.from_arrays(pa.array(starts), self.bytes.take(pa.array(ids)))
        return pc.binary_join(lists, pa.scalar(b"", pa.large_binary())).to_pylist()


class ByteLevel(Side):
    """A byte-level vocabulary in the library's JSON form, over a blank and the text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in texts are plain text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        known = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()} | special
        super().__init__([known.get(i, b"") for i in range(max(known) + 1)])

    def lists(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(Side):
    """A sentence-piece vocabulary, which puts the blank before the text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = m = SentencePieceProcessor(model_file=path)
        piece = lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(BLANK, " ").encode()
        super().__init__([piece(i) for i in range(m.get_piece_size())])

    def lists(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1) if texts else []


@functools.cache
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """One pair of tokenizers for all tasks that a Python worker runs; a task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteLevel(path_a), Pieces(path_b)


class Aligned:
    """The tokens, groups and links of a block of texts. A text's tokens are ``a[a_at[i]:a_at[i + 1]]``."""

    def __init__(self, a: Side, b: Side, texts: list[str | None]) -> None:
        self.sides = a, b
        asked = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in asked]
        split = [BETWEEN.split(t) if a.cuts and b.cuts else [t] for t in given]
        starts = np.cumsum([0, *map(len, split)])
        parts = pa.array(itertools.chain.from_iterable(split), pa.large_string()).dictionary_encode()
        different, index = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        coded = [(side, *side.encode(different, index, starts)) for side in (a, b)]
        whole = [b" " + t.encode() for t in given]
        same = np.ones(len(given), dtype=bool)
        for side, ids, starts in coded:
            same &= np.array([x == y for x, y in zip(side.joined(ids, starts), whole, strict=True)], dtype=bool)
        kept = []
        for _, ids, starts in coded:
            n = np.zeros(len(texts), dtype=np.int64)
            n[asked] = np.diff(starts) * same
            kept.append((ids[np.repeat(same, np.diff(starts))], np.concatenate(([0], np.cumsum(n)))))
        (self.a, self.a_at), (self.b, self.b_at) = kept
        # Both sides cover the same bytes of the block, text by text, so places in the block compare.
        self.a_end, self.b_end = np.cumsum(a.size[self.a]), np.cumsum(b.size[self.b])
        self.a_start, self.b_start = self.a_end - a.size[self.a], self.b_end - b.size[self.b]

    # A token is 8 bytes in each of a dozen arrays: a block's size bounds them.
    @functools.cached_property
    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each token of A and of each token of B, from 0 on."""
        start, end = np.concatenate([self.a_start, self.b_start]), np.concatenate([self.a_end, self.b_end])
        side = np.repeat([0, 1], [len(self.a), len(self.b)])
        order = np.lexsort((side, start))
        reach = np.maximum.accumulate(end[order])
        breaks = np.zeros(len(order), dtype=np.int64)
        breaks[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(breaks)
        return group[: len(self.a)], group[len(self.a) :]

    def per_text(self, of_token: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(of_token)))
        return total[at[1:]] - total[at[:-1]]

    @functools.cached_property
    def n_groups(self) -> np.ndarray:
        first = np.diff(self.groups[0], prepend=-1) > 0
        return self.per_text(first, self.a_at)

    @functools.cached_property
    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in A and in B of all pairs of tokens that overlap."""
        low = np.searchsorted(self.b_end, self.a_start, side="right")
        n = np.searchsorted(self.b_start, self.a_end, side="left") - low
        done = np.cumsum(n) - n
        of_a = np.repeat(np.arange(len(self.a)), n)
        return of_a, np.repeat(low - done, n) + np.arange(len(of_a))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's different id pairs; and by text: where its pairs begin, their places
        in the block's list, and how often the text has each."""
        of_a, of_b = self.links
        coded = pa.array(self.a[of_a] << 32 | self.b[of_b]).dictionary_encode()
        different, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        text = np.searchsorted(self.a_at, of_a, side="right") - 1
        key, times = np.unique(text * max(len(different), 1) + place, return_counts=True)
        text, place = np.divmod(key, max(len(different), 1))
        return different, np.searchsorted(text, np.arange(len(self.a_at))), place, times

    def written(self) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        out = []
        (a, b), (of_a, of_b) = self.sides, self.groups
        # What follows a token: 1 a comma, 2 the bar, 3 the semicolon, 0 nothing.
        mark_a = np.where(np.append(of_a[1:] == of_a[:-1], False)[: len(of_a)], 1, 2)
        mark_b = np.where(np.append(of_b[1:] == of_b[:-1], False)[: len(of_b)], 1, 3)
        ends = self.b_at[1:][np.diff(self.b_at) > 0] - 1
        mark_b[ends] = 0
        order = np.argsort(np.concatenate([of_a * 2, of_b * 2 + 1]), kind="stable")
        table = pa.concat_arrays([a.written, b.written])
        which = np.concatenate([self.a * 4 + mark_a, len(a.written) + self.b * 4 + mark_b])[order]
        lists = pa.LargeListArray.from_arrays(pa.array(self.a_at + self.b_at), table.take(pa.array(which)))
        out = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
        return out.to_pylist()


def _blocks(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], limit: int) -> Iterator[tuple[pa.Array, Aligned]]:
    a, b = sides(*paths)
    for batch in batches:
        for at, n in slices(batch.column(1), limit):
            yield batch.column(0).slice(at, n), Aligned(a, b, batch.column(1).slice(at, n).to_pylist())


def _input(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return found, found.schema["doc_id"].dataType.simpleString()


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B)


def aligned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, groups): each text's groups in order as (start, end, a, b), byte offsets in
    a blank and the text, and the ids of both sides."""
    paths = _paths(path_a, path_b)

    def of_side(ids: np.ndarray, group: np.ndarray, n: int) -> pa.Array:
        at = np.searchsorted(group, np.arange(n + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _blocks(batches, paths, block_bytes):
            of_a, of_b = block.groups
            n = int(block.n_groups.sum())
            first = np.searchsorted(of_a, np.arange(n))
            last = np.searchsorted(of_a, np.arange(n), side="right") - 1
            text = np.repeat(np.arange(len(ids)), block.n_groups)
            base = np.concatenate(([0], block.a_end))[block.a_at[text]]
            columns = [
                pa.array((block.a_start[first] - base).astype(np.int32)),
                pa.array((block.a_end[last] - base).astype(np.int32)),
                of_side(block.a, of_a, n),
                of_side(block.b, of_b, n),
            ]
            rows = pa.StructArray.from_arrays(columns, names=["start", "end", "a", "b"])
            at = np.concatenate(([0], np.cumsum(block.n_groups))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(at), rows)], names=["doc_id", "groups"])

    found, id_type = _input(docs, id_col, text_col)
    group = "struct<start: int, end: int, a: array<int>, b: array<int>>"
    return found.mapInArrow(run, f"doc_id {id_type}, groups array<{group}>")


def _measured(docs: DataFrame, id_col: str, text_col: str, paths: tuple[str, str], block_bytes: int) -> DataFrame:
    """A row per document, and in the first row of each block the block's pairs with the
    number of the block's documents that hold each. Staged."""
    found, id_type = _input(docs, id_col, text_col)
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "pairs", "held"]

    def lists(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for k, (ids, block) in enumerate(_blocks(batches, paths, block_bytes)):
            different, at, place, times = block.pairs()
            held = np.bincount(place, minlength=len(different))
            n_a, n_b = np.diff(block.a_at), np.diff(block.b_at)
            text = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(block.written(), n_a.tolist(), strict=True)]
            n_links = block.per_text(np.bincount(block.links[0], minlength=len(block.a)), block.a_at)
            once = np.full(len(ids) + 1, len(different))
            once[0] = 0
            columns = [
                pa.array(np.full(len(ids), base + k), pa.int64()),
                ids,
                *(pa.array(x, pa.int64()) for x in (n_a, n_b, block.n_groups, n_links)),
                pa.array(text, pa.string()),
                lists(place, at, pa.int32()),
                lists(times, at, pa.int32()),
                lists(different, once, pa.int64()),
                lists(held, once, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ddl = (
        f"block long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "places array<int>, times array<int>, pairs array<long>, held array<int>"
    )
    return stage(found.mapInArrow(run, ddl), "alignment-blocks")


def _counted(measured: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold each pair, and whether no pair of its A id has more. Staged."""
    pairs = measured.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
    counts = stage(pairs.agg(F.sum("p.held").cast("long").alias("docs")), "alignment-counts")
    a = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))  # a row per id of A's vocabulary
    joined = counts.withColumn("a", a).join(F.broadcast(most), "a")
    return stage(joined.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "alignment-best")


def pair_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(a, b, docs, best): every id pair that is linked somewhere, the number of documents
    that hold it, and whether that is the most of its A id."""
    counts = _counted(_measured(docs, id_col, text_col, _paths(path_a, path_b), block_bytes))
    a, b = F.shiftright("pair", 32).cast("int"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int")
    return counts.select(a.alias("a"), b.alias("b"), "docs", "best")


def report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row:
    numbers of tokens, groups and links; links whose pair is the commonest of its A id;
    the sum of the counts of the links' pairs; the digest of the groups, '' without tokens."""
    measured = _measured(docs, id_col, text_col, _paths(path_a, path_b), block_bytes)
    counts = _counted(measured)
    asked = measured.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("of_block", "place", "docs", "best")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = measured.select("block", *kept, "places", "times")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        place = right["place"].to_numpy()
        docs_of, best_of = np.zeros((2, len(place)), dtype=np.int64)
        docs_of[place], best_of[place] = right["docs"].to_numpy(), right["best"].to_numpy()
        places, times = left["places"].combine_chunks(), left["times"].combine_chunks()
        n = pc.list_value_length(places).to_numpy(zero_copy_only=False)
        at = np.concatenate(([0], np.cumsum(n)))
        of, by = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)

        def sums(values: np.ndarray) -> pa.Array:
            total = np.concatenate(([0], np.cumsum(values[of] * by)))
            return pa.array(total[at[1:]] - total[at[:-1]], pa.int64())

        return left.select(kept).append_column("n_best", sums(best_of)).append_column("count_sum", sums(docs_of))

    ddl = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept) + ", n_best long, count_sum long"
    found = rows.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(summed, ddl)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
