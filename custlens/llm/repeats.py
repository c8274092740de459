"""Repeated windows of a corpus: what the two substring operators share.

A window is ``window`` consecutive units (bytes or words) of one document. All
occurrences of a window choose the same anchor in it: the run of ``gram`` units with
the least hash, the first one of equals. An anchor's span holds all windows that
choose it. So windows can only be equal if their anchors have the same key,
and each document sends an anchor for about every ``(window - gram) / 2`` units, not
its whole text.

1. ``anchors``: (key, cls, id, th, pos, left, right) of every anchor, cls being a hash of its
   span. Spans with the same key and cls are one class.
2. ``spans``: the classes of keys that occur twice or more, each with its content,
   cut out of the document with the least id.
3. The operator's own search answers for each class which of its windows occur elsewhere.
   A key with more than ``GROUP`` classes is not searched in one task: ``by_window``
   counts its windows by hash in an ordinary aggregate.
4. ``intervals``: the answers of a class go to all documents that have it.

Documents are told apart by id and a hash of the text; a missing id counts as the
greatest one. Rows that agree in both are equal texts, and each is met as often as
it occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm import text_arrays as A
from custlens.llm.common import stage

NO_ID = 2**63 - 1
GROUP = 20_000
POSITION = A.U64((1 << 24) - 1)
SEGMENT = 1 << 22  # units of a document that are worked on at once


@dataclass(frozen=True)
class Units:
    """What a document consists of, and the length of a window and of an anchor in it."""

    window: int
    gram: int
    words: bool

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(units, offsets in units) of texts: the bytes themselves, or a hash for each word."""
        if not self.words:
            return data, offsets
        _, _, rows, hashes = A.word_hashes(data, offsets)
        return hashes, np.searchsorted(rows, np.arange(len(offsets)))

    def prefix(self, units: np.ndarray) -> np.ndarray:
        """Running hash of the units; differences give the hash of any run."""
        if not self.words:
            return A.prefix_hash(units)
        with np.errstate(over="ignore"):
            out = np.zeros(len(units) + 1, dtype=A.U64)
            np.cumsum(A.mixed(units + A.STEP) * A.powers(len(units))[0][: len(units)], out=out[1:])
        return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors_of(units: np.ndarray, offsets: np.ndarray, kind: Units) -> tuple[np.ndarray, ...]:
    """(row, key, class, position, left, right) of the anchors of texts, given as units."""
    lengths = np.diff(offsets)
    n_windows = np.maximum(0, lengths - kind.window + 1)
    if not n_windows.any():
        return (np.zeros(0, np.int64),) * 6
    prefix = kind.prefix(units)
    at = np.arange(len(units) - kind.gram + 1)
    grams = A.run_hash(prefix, at, at + kind.gram)
    least = _sliding_least((grams & ~POSITION) | at.astype(A.U64), kind.window - kind.gram + 1)
    rows = np.repeat(np.arange(len(lengths)), n_windows)
    starts = np.arange(len(rows)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + offsets[:-1][rows]
    chosen = (least[starts] & POSITION).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (rows[1:] != rows[:-1])]))
    last = np.concatenate([first[1:], [len(rows)]]) - 1
    low, high, at, row = starts[first], starts[last] + kind.window, chosen[first], rows[first]
    left, right = at - low, high - at
    with np.errstate(over="ignore"):
        content = A.mixed(A.run_hash(prefix, low, high) + left.astype(A.U64) * A.STEP + right.astype(A.U64))
    return row, grams[at].view(np.int64), content.view(np.int64), at - offsets[row], left, right


def _segments(units: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, shift of positions, units, offsets); a long text comes in overlapping pieces."""
    if len(units) <= SEGMENT:
        yield 0, 0, units, offsets
        return
    for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for low in range(a, max(a + 1, b - window + 1), SEGMENT - window + 1):
            high = min(b, low + SEGMENT)
            yield row, low - a, units[low:high], np.array([0, high - low])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): how documents are told apart."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")
    )


def anchors(texts: DataFrame, kind: Units) -> DataFrame:
    """(key, cls, id, th, pos, left, right) of every anchor of the keyed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for first, data, offsets in A.chunks(batch.column(2)):
                units, cuts = kind.of(data, offsets)
                for row, shift, part, where in _segments(units, cuts, kind.window):
                    rows, key, cls, pos, left, right = anchors_of(part, where, kind)
                    rows = rows + first + row
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (key, cls, ids[rows], hashes[rows], pos + shift)]
                        + [pa.array(x.astype(np.int32)) for x in (left, right)],
                        names=["key", "cls", "id", "th", "pos", "left", "right"],
                    )

    schema = "key long, cls long, id long, th long, pos long, left int, right int"
    return stage(texts.mapInArrow(run, schema), "repeat-anchors")


def spans(texts: DataFrame, found: DataFrame, kind: Units) -> DataFrame:
    """(key, cls, left, right, n, least, classes, content) of the classes of repeated keys."""
    classes = found.groupBy("key", "cls").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("least"),
        F.min(F.struct("id", "th", "pos", "left", "right")).alias("main"),
    )
    classes = stage(classes, "repeat-classes")
    keys = classes.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes")).where("total > 1")
    wanted = (
        classes.join(keys, "key")
        .groupBy("main.id", "main.th")
        .agg(
            F.collect_list(
                F.struct("key", "cls", "main.pos", "main.left", "main.right", "n", "least", "classes")
            ).alias("wanted")
        )
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            for first, data, offsets in A.chunks(batch.column(0)):
                units, cuts = kind.of(data, offsets)
                bytes_ = np.ascontiguousarray(units).view(np.uint8)
                size = units.dtype.itemsize
                lists = wanted.slice(first, len(offsets) - 1)
                flat = lists.flatten()
                get = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                low = (cuts[row] + get["pos"] - get["left"]) * size
                high = (cuts[row] + get["pos"] + get["right"]) * size
                whole = bytes_.tobytes()
                content = [whole[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                names = ["key", "cls", "left", "right", "n", "least", "classes"]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(get[n]) for n in names), pa.array(content, pa.binary())], names=[*names, "content"]
                )

    schema = "key long, cls long, left int, right int, n long, least long, classes long, content binary"
    # Staged, so that the shuffles up to here can go.
    return stage(texts.join(wanted, ["id", "th"]).select("text", "wanted").mapInArrow(cut, schema), "repeat-spans")


def by_window(crowded: DataFrame, kind: Units) -> DataFrame:
    """(key, cls, low, high, least) of the repeated windows of classes, by hashes of the windows.

    For keys with so many classes that they shouldn't meet in one task.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, cls, left, n, least, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                units = np.frombuffer(content, A.U64 if kind.words else np.uint8)
                start = np.arange(len(units) - kind.window + 1)
                h = A.run_hash(kind.prefix(units), start, start + kind.window).view(np.int64)
                same = [np.full(len(h), x, np.int64) for x in (key, cls, n, least)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, same), pa.array(start - left), pa.array(h)],
                    names=["key", "cls", "n", "least", "low", "h"],
                )

    each = stage(
        crowded.select("key", "cls", "left", "n", "least", "content").mapInArrow(
            windows, "key long, cls long, n long, least long, low long, h long"
        ),
        "repeat-windows",
    )
    known = each.groupBy("key", "h").agg(F.sum("n").alias("total"), F.min("least").alias("first")).where("total > 1")
    return each.join(known, ["key", "h"]).select(
        "key", "cls", "low", (F.col("low") + kind.window).alias("high"), F.col("first").alias("least")
    )


def intervals(found: DataFrame, answers: DataFrame, smaller_only: bool) -> DataFrame:
    """(id, th, runs): merged ranges [low, high) of units to remove, by document."""
    hit = found.select("key", "cls", "id", "th", "pos").join(answers, ["key", "cls"])
    if smaller_only:
        hit = hit.where("least < id")
    return hit.groupBy("id", "th").agg(
        F.collect_set(F.struct((F.col("pos") + F.col("low")).alias("low"), (F.col("pos") + F.col("high")).alias("high"))).alias("runs")
    )


def removed(n_units: int, runs: list[dict] | None) -> tuple[list[tuple[int, int]], int]:
    """The maximal runs that ``runs`` cover, and their total length."""
    merged: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in runs or ()):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged, sum(b - a for a, b in merged)


def kept_rows(
    docs: DataFrame,
    ranges: DataFrame,
    row: Callable[[bytes, list[dict] | None], tuple],
    fields: list[pa.Field],
    ddl: str,
    id_col: str,
    text_col: str,
) -> DataFrame:
    """(doc_id, ...): ``row(text, runs)`` for each input row."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("th"),
        text.alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = batch.column(1).cast(pa.binary()), batch.column(2)
            rows = [row(t.as_py(), r.as_py()) for t, r in zip(texts, runs, strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, fields, strict=True))],
                names=["doc_id", *(f.name for f in fields)],
            )

    id_type = own.schema["doc_id"].dataType.simpleString()
    joined = own.join(ranges, ["id", "th"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, f"doc_id {id_type}, {ddl}")
