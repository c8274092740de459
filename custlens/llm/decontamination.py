"""Operator 1, benchmark decontamination by rare n-gram seeds and alignment.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text, so
that case and punctuation don't matter. One pass counts in how many documents each n-gram of
the benchmark occurs. Of every ``RUN`` neighbouring n-grams of an item the rarest
is a seed; ranks are taken within the item, so that an item whose copies are many
keeps its seeds. A second pass joins the documents' n-grams to the seeds and, around each hit,
aligns the item with the passage by Smith-Waterman over words (match, mismatch
and gap as below). An item leaks into a document if the best local alignment
reaches ``MIN_SCORE`` of the score of a full copy; edited and paraphrased copies still do.

The benchmark is the stated query set. It goes to the tasks in blocks of about ``BLOCK_BYTES``
of text, each block against all documents; nothing of the documents is shuffled but the counts of benchmark n-grams.

Defined results: NULL or empty documents or items match nothing. A row without
an id is reported with a NULL id. Repeated rows are each reported. Items under
``GRAM`` words are one seed as a whole. Empty tables give empty results. Extra columns of the documents
are kept by ``clean`` and ignored by ``leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm import text_arrays as A
from custlens.llm.common import fresh, stage

GRAM = 3
RUN = 2
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
BLOCK_BYTES = 8 << 20

# Every ASCII byte but letters and digits separates words.
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

Item = tuple[int, np.ndarray]  # id, word hashes


def words_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, ...]]]:
    """(first row, offsets, (start, end, row, hash) of words) for runs of rows."""
    for first, data, offsets in A.chunks(column):
        found = A.word_hashes(data, offsets, blank=SEPARATORS)
        yield first, offsets, found


def grams_of(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram, number of its first word) of the n-grams that stay within a row."""
    grams = A.gram_hashes(hashes, n)
    at = np.flatnonzero(rows[: len(grams)] == rows[n - 1 :]) if len(grams) else np.zeros(0, np.int64)
    return grams[at], at


def hits_of(grams: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``grams``, index in the sorted ``keys``) of the grams that are keys."""
    if not len(keys) or not len(grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    found = np.flatnonzero(keys[at] == grams)
    return found, at[found]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score, and the first and last word (exclusive) of its part of the passage."""
    n = len(passage)
    ramp = np.arange(n + 1) * -GAP
    row = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)  # where the best alignment that ends here begins
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        new = np.concatenate([[0], np.maximum(0, np.maximum(diagonal, above))])
        begin = np.concatenate([[0], np.where(diagonal >= above, start[:-1], start[1:])])
        begin = np.where(new > 0, begin, np.arange(n + 1))
        # A gap in the item: the best value to the left, less its distance.
        left = np.maximum.accumulate(new + ramp)
        source = np.maximum.accumulate(np.where(new + ramp == left, np.arange(n + 1), 0))
        row, start = left - ramp, begin[source]
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), int(start[at]), at)
    return best


class Seeds:
    """The seeds of a block of items, to be looked up in documents."""

    def __init__(self, items: list[Item], counts: dict[int, int], run: int) -> None:
        self.items = items
        seeds: dict[int, set[tuple[int, int, int]]] = {}  # by length: (gram, item, position)
        for number, (_, words) in enumerate(items):
            n = min(GRAM, len(words))
            grams = A.gram_hashes(words, n).tolist()
            rarity = [(counts.get(g, 0), i) for i, g in enumerate(grams)]
            for i in range(max(1, len(grams) - run + 1)):
                at = min(rarity[i : i + run])[1]
                seeds.setdefault(n, set()).add((grams[at], number, at))
        self.by_length = {}
        for n, found in seeds.items():
            rows = sorted(found)
            keys = np.array([r[0] for r in rows], A.U64)
            known, first = np.unique(keys, return_index=True)
            self.by_length[n] = known, np.append(first, len(rows)), np.array([r[1:] for r in rows], np.int64)

    def found(self, hashes: np.ndarray, rows: np.ndarray, min_score: float) -> list[tuple[int, int, float, int, int]]:
        """(row, item number, score, first word, last word) of the leaks in a run of documents."""
        places: list[np.ndarray] = []
        for n, (keys, first, uses) in self.by_length.items():
            grams, at = grams_of(hashes, rows, n)
            hit, key = hits_of(grams, keys)
            for k in range(int(np.diff(first).max(initial=0))):  # the k-th use of each seed
                more = first[key] + k < first[key + 1]
                use = uses[first[key[more]] + k]
                where = at[hit[more]]
                places.append(np.stack([rows[where], use[:, 0], where - use[:, 1]], axis=1))
        if not places:
            return []
        cuts = np.searchsorted(rows, np.arange(int(rows[-1]) + 2)) if len(rows) else np.zeros(1, np.int64)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for row, number, begin in np.unique(np.concatenate(places), axis=0).tolist():
            words = self.items[number][1]
            # One alignment covers the hits whose copies would start within half an item.
            slack = len(words) // 2 + 1
            if begin <= done.get((row, number), -(1 << 62)):
                continue
            done[row, number] = begin + slack
            low, high = max(cuts[row], begin - slack), min(cuts[row + 1], begin + len(words) + 2 * slack)
            score, a, b = align(words, hashes[low:high])
            score /= MATCH * len(words)
            if score >= min_score and score > best.get((row, number), (0.0, 0, 0))[0]:
                best[row, number] = (score, int(low) + a, int(low) + b)
        return [(*k, *v) for k, v in best.items()]


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.select(
        F.col(f"`{id_col}`").cast("long").alias("item_id"), F.lower(F.col(f"`{text_col}`").cast("string")).alias("text")
    ).where("text is not null")


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[Item]]:
    """The items in blocks of about ``block_bytes`` of text."""
    held = stage(items, "benchmark-items")
    size = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // block_bytes + 1
    for block in range(n):
        rows = held.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text").collect()
        column = pa.array([r["text"] for r in rows], pa.string())
        found = []
        for first, offsets, (_, _, owner, hashes) in words_of(column):
            cuts = np.searchsorted(owner, np.arange(len(offsets)))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b > a:
                    found.append((rows[first + i]["item_id"], hashes[a:b]))
        if found:
            yield found


def document_counts(texts: DataFrame, items: list[Item]) -> dict[int, int]:
    """In how many documents each n-gram of the items occurs; as many entries as the items have n-grams."""
    lengths = sorted({min(GRAM, len(w)) for _, w in items})
    keys = {n: np.unique(np.concatenate([A.gram_hashes(w, n) for _, w in items if min(GRAM, len(w)) == n])) for n in lengths}
    shared = texts.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, (_, _, rows, hashes) in words_of(batch.column(0)):
                for n, known in shared.value.items():
                    grams, at = grams_of(hashes, rows, n)
                    hit, key = hits_of(grams, known)
                    pairs = np.unique(np.stack([rows[at[hit]], key], axis=1), axis=0)
                    found, count = np.unique(pairs[:, 1], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(known[found].view(np.int64)), pa.array(count)], names=["gram", "n"]
                    )

    counted = texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"] & (1 << 64) - 1: r["n"] for r in counted.collect()}


def _seeds(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, text_col: str, run: int, block_bytes: int) -> list:
    """The seeds of each block, as broadcast variables."""
    texts = docs.select(F.lower(F.col(f"`{text_col}`").cast("string")).alias("text"))
    context = docs.sparkSession.sparkContext
    return [
        context.broadcast(Seeds(block, document_counts(texts, block), run))
        for block in _blocks(_items(items, item_id, item_text), block_bytes)
    ]


def leaks(
    docs: DataFrame,
    items: DataFrame,
    min_score: float = MIN_SCORE,
    run: int = RUN,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): the best passage of each item that leaks into a document."""
    schema = "doc_id long, item_id long, score double, start_word long, end_word long"
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.lower(F.col(f"`{text_col}`").cast("string")).alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for seeds in _seeds(docs, items, item_id, item_text, text_col, run, block_bytes):

        def search(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for first, _, (_, _, rows, hashes) in words_of(batch.column(1)):
                    for row, number, score, a, b in seeds.value.found(hashes, rows, min_score):
                        begin = int(np.searchsorted(rows, row))
                        item = seeds.value.items[number][0]
                        out.append((batch.column(0)[first + row].as_py(), item, score, a - begin, b - begin))
                if out:
                    types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        names=["doc_id", "item_id", "score", "start_word", "end_word"],
                    )

        found = found.union(own.mapInArrow(search, schema))
    return found


def clean(
    docs: DataFrame,
    items: DataFrame,
    min_score: float = MIN_SCORE,
    run: int = RUN,
    block_bytes: int = BLOCK_BYTES,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with the columns of ``docs``."""
    schema, lower = docs.schema, fresh(docs, "lower")
    for seeds in _seeds(docs, items, item_id, item_text, text_col, run, block_bytes):

        def keep(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                for first, _, (_, _, rows, hashes) in words_of(batch.column(batch.num_columns - 1)):
                    for row, *_ in seeds.value.found(hashes, rows, min_score):
                        kept[first + row] = False
                yield batch.filter(pa.array(kept)).drop_columns([lower])

        lowered = F.lower(F.col(f"`{text_col}`").cast("string")).alias(lower)
        docs = docs.select("*", lowered).mapInArrow(keep, schema)
    return docs
