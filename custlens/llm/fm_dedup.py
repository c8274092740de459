"""Operator 10, substring dedup by a compressed FM-index per shard.

Removes each word that is covered by a window of ``WINDOW`` words whose sequence also
starts in a document with a smaller id; windows are judged on the input. ``repeats``
brings together the spans (as word hashes) around equal anchors.

Spans are dealt to shards by their anchor's key, so that equal windows are in one
shard. A shard's spans become one sequence, with a separator after each, and of it an
FM-index is kept: the counts of smaller symbols, and the Burrows-Wheeler transform in a
wavelet matrix whose bits are packed, with running counts for every 64 of them. All spans of
the shard then stream through it from their right ends, in step: a backward search
prepends one word to the match, and a match of WINDOW words drops its last word by
widening its interval to the suffixes that share WINDOW - 1 words. These are the
matching statistics up to the threshold: at each position whose match reaches it, the interval
holds all occurrences of that window, and with it the least document id.

Defined results: NULL or empty text has no words. Documents under WINDOW words lose
nothing. A row without an id counts as the greatest, so that it can lose words but never
take them. Repeated rows are treated alike. An empty table gives an empty result;
extra columns are ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm import repeats
from custlens.llm import text_arrays as A

WINDOW = 50
GRAM = 8
SHARD = 4_000  # spans to a shard, about


class WaveletMatrix:
    """Counts of a symbol in prefixes of a sequence, from packed bits per level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bits = (symbols >> level) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level before the positions."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros(len(symbol), np.int64)
        at = np.concatenate([start, low, high])
        n = len(symbol)
        symbol = np.tile(symbol, 3)
        for level in range(self.levels):
            ones = self.ones(level, at)
            one = (symbol >> (self.levels - 1 - level)) & 1 == 1
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return at[n : 2 * n] - at[:n], at[2 * n :] - at[:n]


class FMIndex:
    """Of a sequence of symbols (0 and up) whose suffixes differ within ``reach`` symbols or more.

    ``window`` is the length at which matches stop to grow.
    """

    def __init__(self, symbols: np.ndarray, window: int) -> None:
        n = len(symbols)
        self.n_symbols = int(symbols.max()) + 1
        rank, length, whole = symbols.astype(np.int64), 1, {}
        powers = {1 << i for i in range(window.bit_length())}
        while True:
            if length in powers:
                whole[length] = rank
            if length >= window and rank.max() == n - 1:
                break
            after = np.concatenate([rank[length:] + 1, np.zeros(min(length, n), np.int64)])[:n]
            pair = rank * (n + self.n_symbols + 2) + after
            order = np.argsort(pair, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], np.diff(pair[order]) != 0]))
            rank, length = new, 2 * length
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[rank] = np.arange(n)
        before = symbols[self.suffixes - 1]
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.n_symbols))])
        self.wavelet = WaveletMatrix(before, self.n_symbols)
        self.shared = [self._sharing(whole, window - 1, n), self._sharing(whole, window, n)]

    def _sharing(self, whole: dict[int, np.ndarray], length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(group of each suffix in order, first suffix of each group): groups share ``length`` symbols."""
        if length < 1:
            return np.zeros(n, np.int64), np.array([0, n])
        part = 1 << (length.bit_length() - 1)
        rank, shift = whole[part], length - part
        second = np.minimum(self.suffixes + shift, n - 1)
        a, b = rank[self.suffixes], rank[second]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        return np.cumsum(first) - 1, np.concatenate([np.flatnonzero(first), [n]])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with a symbol put before them."""
        a, b = self.wavelet.rank(symbol, low, high)
        return self.smaller[symbol] + a, self.smaller[symbol] + b

    def widen(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the suffixes that share window - 1 symbols with those at ``low``."""
        group, first = self.shared[0]
        return first[group[low]], first[group[low] + 1]


def occurrences(contents: list[np.ndarray], ids: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(span, start, least id) of the windows of the spans, least over all their occurrences in the shard."""
    lengths = np.array([len(c) for c in contents])
    known, symbols = np.unique(np.concatenate(contents), return_inverse=True)
    # Each span ends with a separator of its own, which no match can cross.
    ends = np.cumsum(lengths + 1) - 1
    sequence = np.empty(int(lengths.sum()) + len(contents), np.int64)
    inside = np.ones(len(sequence), bool)
    inside[ends] = False
    sequence[inside] = symbols + len(contents)
    sequence[ends] = np.arange(len(contents))
    index = FMIndex(sequence, window)
    owner = np.repeat(ids, lengths + 1)
    group, first = index.shared[1]
    least = np.minimum.reduceat(owner[index.suffixes], first[:-1])

    span = np.arange(len(contents))
    low, high = np.zeros(len(contents), np.int64), np.full(len(contents), len(sequence))
    for step in range(1, int(lengths.max()) + 1):
        live = lengths[span] >= step
        span, low, high = span[live], low[live], high[live]
        if step > window:
            low, high = index.widen(low)
        at = ends[span] - step
        low, high = index.extend(sequence[at], low, high)
        if step >= window:
            yield span, at - (ends[span] - lengths[span]), least[group[low]]


def search(spans: DataFrame, n_shards: int, kind: repeats.Units) -> DataFrame:
    """(key, cls, low, high, least): runs of windows and the least id that has them, from the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for _, group in groupby(rows(), key=lambda r: r[0]):
            _, keys, classes, lefts, least, contents = map(list, zip(*group, strict=True))
            found = occurrences([np.frombuffer(c, A.U64) for c in contents], np.array(least, np.int64), kind.window)
            span, start, first = map(np.concatenate, zip(*found, strict=True))
            order = np.lexsort((start, span))
            span, start, first = span[order], start[order], first[order]
            # Neighbouring windows with the same least id make one answer.
            new = np.concatenate([[True], (span[1:] != span[:-1]) | (first[1:] != first[:-1])])
            begin = np.flatnonzero(new)
            end = np.concatenate([begin[1:], [len(span)]]) - 1
            who = span[begin]
            left = np.array(lefts, np.int64)[who]
            columns = (
                np.array(keys, np.int64)[who], np.array(classes, np.int64)[who],
                start[begin] - left, start[end] + kind.window - left, first[begin],
            )
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["key", "cls", "low", "high", "least"])

    return (
        spans.select(F.pmod("key", F.lit(n_shards)).alias("shard"), "key", "cls", "left", "least", "content")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(run, "key long, cls long, low long, high long, least long")
    )


def deduplicated(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    shard: int = SHARD,
    group: int = repeats.GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_sha256), a row for each input row.

    ``spans`` are the maximal removed runs of words, the end exclusive.
    """
    kind = repeats.Units(window, gram, words=True)
    texts = repeats.keyed(docs, id_col, text_col)
    found = repeats.anchors(texts, kind)
    spans = repeats.spans(texts, found, kind)
    searched = spans.where(spans["classes"] <= group)
    answers = search(searched, searched.count() // shard + 1, kind)
    crowded = spans.where(spans["classes"] > group)
    if crowded.limit(1).count():
        answers = answers.union(repeats.by_window(crowded, kind).select(answers.columns))
    ranges = repeats.intervals(found, repeats.stage(answers, "repeat-answers"), smaller_only=True)

    def row(text: bytes, runs: list[dict] | None) -> tuple:
        words = text.split()
        cut, total = repeats.removed(len(words), runs)
        for a, b in reversed(cut):
            del words[a:b]
        digest = hashlib.sha256(b" ".join(words)).hexdigest()
        return len(words) + total, total, [list(r) for r in cut], digest

    fields = [
        pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()),
        pa.field("spans", pa.list_(pa.list_(pa.int64()))), pa.field("kept_sha256", pa.string()),
    ]
    ddl = "n_words long, n_removed long, spans array<array<long>>, kept_sha256 string"
    return repeats.kept_rows(docs, ranges, row, fields, ddl, id_col, text_col)
