"""Operator 6, an exact n-gram Jaccard join by T-occurrence search.

Two documents link when their sets of word shingles have a Jaccard similarity of
``PERCENT`` / 100 or more; the result is the component of every document.

1. Equal sets form a class (a 128-bit hash of the set); the document with the least
   id stands for it.
2. Sets that may link come together by the pigeonhole principle. If the smaller of
   two linked sets has at most H shingles, they differ in d(H) shingles at most, so
   of B buckets of a hash B - d(H) at least hold the same shingles in both. Each
   class sends a hash of a bucket's content, for its own band of sizes and, if it
   may be the larger of a pair, for the band below. Buckets that strangers may share
   are weak: empty ones, ones with a single shingle (where the threshold lets sets have
   enough fuller ones) and ones with heavy shingles only. What is heavy a table of ``SLOTS``
   counters tells, added up over all documents; a shingle that shares its slot costs
   speed only. A class with fewer than B - d(H) weak buckets sends the others alone, as one of
   these is shared with each linked set; else it sends all but the empty ones, and if too
   many are empty it repeats the round with another hash.
   Equal bucket hashes give star links, thinned on the map side; their connected
   components are the blocks.
   Linked pairs meet under every salt of the hash: should shared passages still chain
   strangers to a block of more than ``BLOCK`` shingles, it is split into the components that
   its members form under another salt, again and again while that makes it smaller.
3. Within a block the sets meet once. Every class is a query against an inverted
   index of the block: with required overlap T, the L longest of its lists are set aside, the
   short lists are merged by a heap, and what occurs T - L times in them is looked up
   in the long lists by binary search (DivideSkip). Sets that are in the query's component
   already are taken out of the lists, as a link to them adds nothing.
   What is still larger than ``BLOCK`` is searched in parts with some members shared.
   Then the classes outside of the block's largest component meet all others, in cells
   of two parts of half of ``BLOCK`` each: a search holds about ``BLOCK`` shingles,
   whatever the number of such classes, and no pair is left out.
4. The components of the links found are the result.

Words are maximal runs without the six blanks, A-Z in lower case. Fewer words than
a shingle are one shingle. Without words, NULL text included, the set is empty: it links
with nothing and the document is its own component. A row without an id links
nothing and gets a NULL component. Repeated rows are in one class. Empty tables give empty results;
extra columns are ignored. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm import text_arrays as A
from custlens.llm.common import fresh, stage, unstage
from custlens.llm.graph import components

WORDS = 4
PERCENT = 85
BLOCK = 1_000_000
SLOTS = 1 << 20  # counters of shingles, 4 MB in all
SLICE = 1 << 12  # counters in a row of the table that adds them up
FLUSH = 100_000  # signatures that a task gathers before it sends them
PIVOTS = 64
SALTS = 12  # how often a large block is split by another salt at most
SHRINKS = 0.95  # a block that keeps more of its shingles is not split again
SHINGLE_BYTES = 8  # of text, roughly
PART_BYTES = 16 << 20
HEAVY_SHARE = 0.05  # of a set's buckets that may well hold heavy shingles only
BAND = 1.3  # ratio of the greatest to the least set size of a band
LEAST_PERCENT = 75  # below it sets may differ in more shingles than buckets can be filled with
MU = 0.001  # of the formula for the number of long lists; a look-up is cheap beside a merge step


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each row the sorted 64-bit hashes of its different shingles."""
    for _, data, offsets in A.chunks(column):
        _, _, rows, hashes = A.word_hashes(data, offsets, lower=True)
        cuts = np.searchsorted(rows, np.arange(len(offsets)))
        grams = A.gram_hashes(hashes, words)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                yield A.gram_hashes(hashes[a:b], int(b - a)) ^ A.U64(b - a)
            else:
                yield np.zeros(0, dtype=A.U64)


def required(a: int, b: int, percent: int) -> int:
    """Least overlap of linked sets of sizes ``a`` and ``b``."""
    return -(-percent * (a + b) // (100 + percent))


def bucket_count(differ: int, size: int) -> tuple[int, int, int]:
    """(buckets, weak ones allowed, shingles of a strong one) for sets of ``size`` shingles or
    more that differ in ``differ`` at most.

    More buckets cost more hashes, fewer make more sets send their weak buckets as well: the
    least expected cost, by the normal approximation of the number of weak buckets. Strong
    buckets have two shingles if most sets can have enough of these, and one otherwise.
    """
    for width in (2, 1):
        best = None
        for spare in range(1, 2 * differ + 8):
            n = differ + 1 + spare
            load = size / n
            weak = min(0.99, math.exp(-load) * (1 + load * (width - 1)) + HEAVY_SHARE)
            spread = math.sqrt(max(0.05, n * weak * (1 - weak)))
            enough = 0.5 * (1 + math.erf((spare + 0.5 - n * weak) / spread / math.sqrt(2)))
            cost = n / max(enough, 1e-9)
            if best is None or cost < best[0]:
                best = cost, enough, n, spare
        if best[1] >= 0.8 or width == 1:
            return *best[2:], width


class Bands:
    """Bands of set sizes, and for each how many buckets its linked pairs need."""

    def __init__(self, percent: int) -> None:
        if not LEAST_PERCENT <= percent <= 100:
            raise ValueError(f"percent must be from {LEAST_PERCENT} to 100")
        self.percent = percent
        self.low = [1]
        self.known: dict[int, tuple[int, int, int]] = {}

    def _buckets(self, band: int) -> tuple[int, int, int]:
        if band not in self.known:
            high = self.low[band + 1] - 1
            differ = (100 - self.percent) * (high + high * 100 // self.percent) // (100 + self.percent)
            self.known[band] = bucket_count(differ, self.low[band]) if differ else (0, 0, 0)
        return self.known[band]

    def rounds(self, n: int) -> list[tuple[int, int, int, int]]:
        """(band, buckets, weak ones allowed, shingles of a strong one) of the rounds of a set of ``n`` shingles.

        Pairs whose smaller set is in a band meet in that band's round. No buckets:
        the linked sets of the band are equal.
        """
        while self.low[-1] <= n:
            # Wide enough that a linked larger set is in the same band or the next one.
            ratio = max(BAND, 100 / self.percent * 1.05)
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * ratio) + 1))
        own = bisect_left(self.low, n + 1) - 1
        found = [(own, *self._buckets(own))]
        if own and n * self.percent <= 100 * (self.low[own] - 1):
            found.append((own - 1, *self._buckets(own - 1)))
        return [f for f in found if f[1]]


def signatures(shingles: np.ndarray, bands: Bands, heavy: np.ndarray, turn: int = 0) -> np.ndarray:
    """Hashes of the contents of the buckets of a set that tell it from strangers, of all if these
    are too few; another ``turn`` deals the shingles to other buckets."""
    out = []
    light = ~heavy[_slots(shingles)]
    with np.errstate(over="ignore"):
        for band, buckets, spare, width in bands.rounds(len(shingles)):
            seed = 0
            while True:
                salt = A.U64((turn << 40 | band << 20 | seed) + 1) * A.STEP
                h = A.mixed(shingles + salt)
                order = np.argsort(h)
                h = h[order]
                bucket = ((h >> A.U64(32)) * A.U64(buckets)) >> A.U64(32)
                first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                total = np.add.reduceat(A.mixed(h ^ A.STEP), first)
                found = A.mixed(total + (bucket[first] + A.U64(1)) * A.STEP + salt)
                strong = np.logical_or.reduceat(light[order], first) & (np.diff(first, append=len(h)) >= width)
                if buckets - np.count_nonzero(strong) <= spare:
                    out.append(found[strong])
                    break
                out.append(found)
                if buckets - len(first) <= spare:
                    break
                seed += 1
    return np.concatenate(out) if out else np.zeros(0, dtype=A.U64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _set_id(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        low, high = A.mixed(s ^ A.STEP).sum(dtype=A.U64), A.mixed(s + A.STEP).sum(dtype=A.U64)
    return int(low.astype(np.int64)), int(high.astype(np.int64))


def _slots(shingles: np.ndarray) -> np.ndarray:
    return A.mixed(shingles) >> A.U64(64 - SLOTS.bit_length() + 1)


def heavy_slots(counts: np.ndarray) -> np.ndarray:
    """Which slots of the counters occur clearly more often than chance lets slots of rare shingles do."""
    mean = float(counts.mean())
    return counts > mean + 8 * math.sqrt(mean) + 8


def _slices(counts: np.ndarray) -> pa.RecordBatch:
    """Counters that aren't all 0, by slices, in as few bytes each as they need."""
    numbers, blobs = [], []
    for i, part in enumerate(counts.reshape(-1, SLICE)):
        if top := int(part.max()):
            numbers.append(i)
            width = "u1" if top < 1 << 8 else "u2" if top < 1 << 16 else "u4"
            blobs.append(zlib.compress(np.minimum(part, (1 << 32) - 1).astype(width).tobytes(), 1))
    nothing = pa.nulls(len(numbers), pa.int64())
    return pa.RecordBatch.from_arrays(
        [nothing] * 4 + [pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], names=_SETS
    )


_SETS = ["doc_id", "n_shingles", "s1", "s2", "slice", "counts"]


def sets_and_counts(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, s1, s2): the size and a 128-bit hash of each row's set; and from
    each task, as rows (slice, counts) beside them, how many of its sets hold a shingle of each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), words))
            columns = np.array([(len(s), *_set_id(s)) for s in sets], dtype=np.int64).reshape(-1, 3).T
            if sets:
                counts += np.bincount(_slots(np.concatenate(sets)).astype(np.int64), minlength=SLOTS)
            nothing = [pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns), *nothing], names=_SETS)
        yield _slices(counts)

    schema = "doc_id long, n_shingles long, s1 long, s2 long, slice long, counts binary"
    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def sets_of(found: DataFrame) -> DataFrame:
    return found.where("slice is null").select(*_SETS[:4])


def slot_counts(found: DataFrame) -> np.ndarray:
    """The counters of all tasks of ``sets_and_counts`` added up, ``SLOTS`` whatever the input."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = zlib.decompress(blob)
                part = np.frombuffer(raw, f"u{len(raw) // SLICE}")
                total[number] = total.get(number, 0) + part.astype(np.int64)
        blobs = [np.minimum(t, (1 << 32) - 1).astype("u4").tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(blobs, pa.binary())], names=["slice", "counts"])

    counts = np.zeros(SLOTS, dtype=np.uint32)
    parts = found.where("slice is not null").select("slice", "counts").repartition("slice")
    for number, blob in parts.mapInArrow(add, "slice long, counts binary").collect():
        counts[number * SLICE : (number + 1) * SLICE] = np.frombuffer(blob, np.uint32)
    return counts


def _stars(sig: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links from each id of a signature to the least one, and (signature, least id)."""
    order = np.lexsort((ids, sig))
    sig, ids = sig[order], ids[order]
    first = np.concatenate([[True], sig[1:] != sig[:-1]])
    head = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    apart = head != ids
    links = np.unique(np.stack([ids[apart], head[apart]], axis=1), axis=0) if apart.any() else np.zeros((0, 2), np.int64)
    return links, sig[first], ids[first]


def candidate_links(
    docs: DataFrame,
    words: int,
    percent: int,
    id_col: str,
    text_col: str,
    size: int,
    heavy: Broadcast,
    turn: int = 0,
    inside: DataFrame | None = None,
) -> DataFrame:
    """Links (a, b) of set hashes that connect all sets with an equal bucket that they send.

    Only the documents of ``inside`` (doc_id, block) if given, and only within a block;
    ``size`` is about the bytes of their texts.
    """
    texts = _texts(docs, id_col, text_col).where("doc_id is not null")
    if inside is None:
        texts = texts.withColumn("block", F.lit(0).cast("long"))
    else:
        texts = texts.join(inside.hint("merge"), "doc_id").select("doc_id", "text", "block")
    parts = int(size // PART_BYTES) + 1

    def packed(sigs: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        links, sig, least = _stars(np.concatenate(sigs), np.concatenate(ids))
        part = (sig % A.U64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rows = np.stack([sig[order].view(np.int64), least[order]], axis=1)
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
        blobs = [rows[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True)]
        numbers = part[order][cuts].tolist()
        if len(links):
            numbers.append(int(links[0, 0]) % parts)
            blobs.append(links.tobytes())
        signed = [n < len(cuts) for n in range(len(numbers))]
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(signed), pa.array(blobs, pa.binary())], names=["part", "signed", "rows"]
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, sigs, ids, held = Bands(percent), [], [], 0
        for batch in batches:
            within = batch.column(2).to_numpy().view(A.U64)
            for s, own in zip(shingle_sets(batch.column(1), words), within, strict=True):
                if not len(s) or not len(sig := signatures(s, bands, heavy.value, turn)):
                    continue
                sigs.append(A.mixed(sig ^ own))
                ids.append(np.full(len(sig), _set_id(s)[0], dtype=np.int64))
                held += len(sig)
                if held >= FLUSH:
                    yield packed(sigs, ids)
                    sigs, ids, held = [], [], 0
        if held:
            yield packed(sigs, ids)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, bool, bytes]]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for _, group in groupby(rows(), key=lambda r: r[0]):
            links, signed = [], []
            for _, kind, blob in group:
                (signed if kind else links).append(np.frombuffer(blob, np.int64).reshape(-1, 2))
            if signed:
                both = np.concatenate(signed)
                links.append(_stars(both[:, 0], both[:, 1])[0])
            found = np.unique(np.concatenate(links), axis=0)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return (
        texts.mapInArrow(emit, "part long, signed boolean, rows binary")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(meet, "a long, b long")
        .distinct()  # most stars of a group of copies have the same least member
    )


class Index:
    """Inverted lists of a block: for each shingle of two sets or more the ascending numbers of its sets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        """``sets`` in ascending order of size."""
        self.sets, self.sizes = sets, [len(s) for s in sets]
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        every = every[order]
        numbers = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        count = np.diff(np.append(first, len(every)))
        self.shingles = every[first[count > 1]]
        self.numbers = numbers[np.repeat(count > 1, count)]
        self.first = np.concatenate([[0], np.cumsum(count[count > 1])])

    def lists(self, query: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The shingles of a set that have an inverted list, from the shortest list on, and these lists."""
        if not len(self.shingles):
            return query[:0], []
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        at = at[self.shingles[at] == query]
        at = at[np.argsort(self.first[at + 1] - self.first[at], kind="stable")]
        ends = zip(self.first[at].tolist(), self.first[at + 1].tolist(), strict=True)
        return self.shingles[at], [self.numbers[a:b] for a, b in ends]

    def looked_up(self, shingles: np.ndarray, number: int) -> int:
        """In how many lists of the shingles a set occurs, by binary search for each of them."""
        own = self.sets[number]
        return int((own[np.minimum(np.searchsorted(own, shingles), len(own) - 1)] == shingles).sum())


def occurrence_search(query: np.ndarray, index: Index, wanted: np.ndarray, percent: int) -> Iterator[int]:
    """Numbers of the ``wanted`` (a mask of numbers up to the query's) indexed sets that link with ``query`` (DivideSkip).

    ``wanted`` may change meanwhile: a set is looked at only if it is still wanted.
    """
    n = len(query)
    smallest = -(-percent * n // 100)
    low = bisect_left(index.sizes, smallest, 0, len(wanted))
    least = required(n, smallest, percent)
    shingles, lists = index.lists(query)
    if low == len(wanted) or len(lists) < least:
        return
    n_long = min(least - 1, int(least / (MU * np.log2(len(lists[-1])) + 1)))
    n_short = len(lists) - n_long
    short = []
    for numbers in lists[:n_short]:
        numbers = numbers[np.searchsorted(numbers, low) : np.searchsorted(numbers, len(wanted))]
        numbers = numbers[wanted[numbers]]
        if len(numbers):
            short.append(numbers.tolist())
    for number, hits in groupby(heapq.merge(*short)):
        count = sum(1 for _ in hits)
        if count < least - n_long or not wanted[number]:
            continue
        if count + index.looked_up(shingles[n_short:], number) >= required(n, index.sizes[number], percent):
            yield number


def block_links(ids: list[int], sets: list[np.ndarray], asked: list[bool], percent: int) -> list[tuple[int, int]]:
    """Links that join all linked sets of a block; those not asked for are one component."""
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    index = Index([sets[i] for i in order])
    component = np.arange(len(order), dtype=np.int32)
    links: list[tuple[int, int]] = []

    def join(x: int, y: int) -> None:
        a, b = component[x], component[y]
        if a != b:
            component[component == max(a, b)] = min(a, b)
            links.append((ids[order[x]], ids[order[y]]))

    rest = None
    for x, i in enumerate(order):
        query = index.sets[x]
        if not asked[i]:
            rest = x if rest is None else rest
            join(x, rest)
        if x and index.looked_up(query, x - 1) >= required(len(query), index.sizes[x - 1], percent):
            join(x, x - 1)
        wanted = component[:x] != component[x]
        if wanted.any():
            for y in occurrence_search(query, index, wanted, percent):
                join(x, y)
                np.not_equal(component[:x], component[x], out=wanted)
    return links


def _search(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for _, group in groupby(rows(), key=lambda r: r[:2]):
        ids, sets, asked = [], [], []
        for _, _, doc_id, ask, data in group:
            ids.append(doc_id)
            sets.append(np.frombuffer(data, A.U64))
            asked.append(ask)
        found = np.array(block_links(ids, sets, asked, percent), np.int64).reshape(-1, 2)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def _with_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` (doc_id, block, part, ask) with each document's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(4), words)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(sets, pa.binary())], names=["block", "part", "doc_id", "ask", "shingles"]
            )

    # Always a shuffle join: the plan, and what it writes, is alike at every size.
    texts = _texts(docs, id_col, text_col).join(wanted.hint("merge"), "doc_id").select("block", "part", "doc_id", "ask", "text")
    return texts.mapInArrow(run, "block long, part long, doc_id long, ask boolean, shingles binary")


def _found(with_sets: DataFrame, percent: int) -> DataFrame:
    return (
        with_sets.repartition("block", "part")
        .sortWithinPartitions("block", "part")
        .mapInArrow(lambda batches: _search(batches, percent), "a long, b long")
    )


def classes_of(sets: DataFrame) -> DataFrame:
    """(s1, s2, main, n, copies): the different sets that aren't empty."""
    of = sets.where("n_shingles > 0").groupBy("s1", "s2")
    return of.agg(F.min("doc_id").alias("main"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"))


def blocks(
    docs: DataFrame, classes: DataFrame, heavy: np.ndarray, words: int, percent: int, block: int, id_col: str, text_col: str
) -> DataFrame:
    """(doc_id, block, n): the classes that may link with others; all that link are in one block."""
    heavy = docs.sparkSession.sparkContext.broadcast(heavy)

    def members(of: DataFrame, links: DataFrame, parent) -> DataFrame:
        found = of.join(components(links), F.col("s1") == F.col("id"))
        columns = [F.col("doc_id"), F.col("s1"), F.col("component").alias("block"), F.col("n"), parent.alias("parent")]
        return stage(found.select(*columns), "join-members")

    first = classes.withColumnRenamed("main", "doc_id")
    size = (classes.agg(F.sum(F.col("n") * F.col("copies"))).first()[0] or 0) * SHINGLE_BYTES
    links = candidate_links(docs, words, percent, id_col, text_col, size, heavy)
    member = members(first, links, F.lit(None).cast("long"))
    settled = []
    for turn in range(1, SALTS + 1):
        totals = member.groupBy("block").agg(F.sum("n").alias("total"), F.max("parent").alias("parent"))
        shrinks = F.col("parent").isNull() | (F.col("total") <= SHRINKS * F.col("parent"))
        large = stage(totals.where((F.col("total") > block) & shrinks).select("block", "total"), "join-large")
        size = large.agg(F.sum("total")).first()[0]
        if not size:
            break
        settled.append(member.join(large, "block", "left_anti").select("doc_id", "block", "n"))
        inside = member.select("doc_id", "s1", "block", "n").join(large, "block")
        within = inside.select("doc_id", "block")
        links = candidate_links(docs, words, percent, id_col, text_col, size * SHINGLE_BYTES, heavy, turn, within)
        member = members(inside.drop("block"), links, F.col("total"))
    for part in settled:
        member = member.select("doc_id", "block", "n").union(part)
    return member.select("doc_id", "block", "n")


def linked(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each input row."""
    found = stage(sets_and_counts(docs, words, id_col, text_col), "join-sets")
    sets, heavy = sets_of(found), heavy_slots(slot_counts(found))
    classes = stage(classes_of(sets), "join-classes")
    member = blocks(docs, classes, heavy, words, percent, block, id_col, text_col)
    sizes = stage(
        member.groupBy("block")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("members"))
        .withColumn("parts", F.ceil(F.col("total") / F.lit(block))),
        "join-blocks",
    )
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    own = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    pivot = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.ceil(F.col("members") / F.lit(PIVOTS))) == 0
    placed = member.join(sizes, "block")
    wanted = stage(
        placed.select(
            "doc_id", "block", F.lit(True).alias("ask"), F.explode(F.when(pivot, every).otherwise(F.array(own))).alias("part")
        ),
        "join-wanted",
    )
    links = stage(_found(_with_sets(docs, wanted, words, id_col, text_col), percent), "join-links")
    unstage(wanted)
    groups = components(links)
    if sizes.where("parts > 1").limit(1).count():
        links = links.union(_across(docs, placed.where("parts > 1"), groups, words, percent, block, id_col, text_col))
        groups = components(stage(links, "join-all-links"))
    groups = groups.withColumnRenamed("id", "main")
    by_class = classes.join(groups, "main", "left").select(
        "s1", "s2", F.coalesce("component", "main").alias("component_id")
    )
    empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (
        sets.where("n_shingles > 0")
        .join(by_class, ["s1", "s2"])
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
        .union(empty)
    )


def cells(grouped: DataFrame, block: int) -> DataFrame:
    """(doc_id, block, part, ask): the cells in which split blocks are searched across their parts.

    ``grouped``: doc_id, block, n and the component so far. Two sets that no link joins
    yet are in different components, so one of them is outside of the block's largest
    and asks. The asking and the other sets of a block are dealt to parts of about half
    of ``block`` shingles each; a cell is two asking parts, or an asking and another one.
    """
    largest = (
        grouped.groupBy("block", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("block")
        .agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("groups"))
    )
    asking = grouped.join(largest, "block").where("groups > 1").withColumn("ask", F.col("component") != F.col("largest"))
    halves = [F.ceil(2 * F.sum(F.when(c, F.col("n")).otherwise(0)) / F.lit(block)) for c in (F.col("ask"), ~F.col("ask"))]
    parts = asking.groupBy("block").agg(halves[0].alias("askers"), halves[1].alias("others"))
    zero = F.lit(0).cast("long")
    own = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.when(F.col("ask"), F.col("askers")).otherwise(F.col("others")))
    width = F.col("askers") + F.col("others")
    asked = F.transform(
        F.sequence(zero, width - 1), lambda other: F.least(F.col("own"), other) * width + F.greatest(F.col("own"), other)
    )
    met = F.transform(F.sequence(zero, F.col("askers") - 1), lambda other: other * width + F.col("askers") + F.col("own"))
    dealt = asking.join(parts, "block").withColumn("own", own)
    return dealt.select("doc_id", "block", F.explode(F.when(F.col("ask"), asked).otherwise(met)).alias("part"), "ask")


def _across(
    docs: DataFrame, placed: DataFrame, groups: DataFrame, words: int, percent: int, block: int, id_col: str, text_col: str
) -> DataFrame:
    """Links across the parts of split blocks."""
    grouped = stage(
        placed.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id")
        ),
        "join-split",
    )
    wanted = stage(cells(grouped, block).select("doc_id", "block", "ask", "part"), "join-asking")
    return _found(_with_sets(docs, wanted, words, id_col, text_col), percent)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Of each group of rows with linked or equal sets the one with the least id, and every row with an empty set.

    Sets decide, not ids: rows without an id take part as any other, after those with
    one; rows that share an id but not their text are told apart. Of rows with the least
    id the one with the least hash of its values stays.
    """
    row = fresh(docs, "row_id")
    # A hash skips NULLs, so their places go in as well.
    values = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    own = docs.withColumn(row, F.xxhash64(*values))
    found = linked(own, id_col=row, text_col=text_col, **settings).groupBy(F.col("doc_id").alias(row))
    found = found.agg(F.first("component_id").alias("component"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"))
    ids = own.groupBy(row).agg(F.first(F.col(f"`{id_col}`").cast("long")).alias("id"))
    rows = stage(found.join(ids, row), "join-rows")
    least = rows.where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", row, "copies")).alias("least"))
    keep = stage(least.select(f"least.{row}", "least.copies"), "join-kept")
    kept = own.join(keep.select(row), row, "left_semi")
    if keep.where("copies > 1").limit(1).count():
        kept = kept.dropDuplicates([row])
    empty = own.join(rows.where("n = 0").select(row), row, "left_semi")
    return kept.union(empty).select(*(F.col(f"`{c}`") for c in docs.columns))
