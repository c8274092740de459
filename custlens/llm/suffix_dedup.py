"""Operator 8, suffix-array dedup by deep-shallow sorting.

Removes each byte that is covered by a string of ``WINDOW`` bytes that also starts
anywhere else, in the same document or another; strings are judged on the input and
never cross documents. ``repeats`` brings together the spans around equal anchors.

In a group of spans with the same anchor, the suffixes that start at the anchor are
sorted, and so are the reversed prefixes that end there. Sorting is deep-shallow:
multikey quicksort compares up to ``SHALLOW`` bytes; suffixes that are still equal
then go into a blind trie, which compares each with one other suffix only, however
long their common prefix is. Neighbours in the sorted orders have the longest
common prefixes, so merging the sets of equal prefixes from the longest down (the
smaller set into the larger) finds for every span the longest match to both sides.
A match of WINDOW bytes or more covers what it spans. A class of spans that occurs
twice or more enters twice.

Defined results: NULL or empty text keeps nothing and removes nothing. A row that
occurs twice (same id and text) is found in its copy. A row without an id takes part as any other.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from custlens.llm import repeats

WINDOW = 400
GRAM = 32
SHALLOW = 64


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def multikey_quicksort(strings: list[bytes], order: list[int], depth: int, limit: int) -> list[list[int]]:
    """Groups of ``order`` in sorted order; the members of a group agree in ``limit`` bytes or wholly.

    Eight bytes count as one letter; a string's end sorts first.
    """
    done: list[list[int]] = []
    todo = [(order, depth)]
    while todo:
        group, depth = todo.pop()
        if len(group) == 1 or depth >= limit:
            done.append(group)
            continue
        letters = [strings[i][depth : depth + 8] for i in group]
        pivot = sorted(letters)[len(letters) // 2]
        less = [i for i, x in zip(group, letters, strict=True) if x < pivot]
        same = [i for i, x in zip(group, letters, strict=True) if x == pivot]
        more = [i for i, x in zip(group, letters, strict=True) if x > pivot]
        if more:
            todo.append((more, depth))
        # A short letter ends its string: all in the group are equal.
        todo.append((same, depth + 8 if len(pivot) == 8 else limit))
        if less:
            todo.append((less, depth))
    return done


class _Node:
    """Of a blind trie: where its strings first differ, and the branches by that byte."""

    __slots__ = ("branches", "depth", "leaf")

    def __init__(self, depth: int, leaf: int) -> None:
        self.depth, self.branches, self.leaf = depth, {}, leaf


def blind_trie_order(strings: list[bytes], group: list[int]) -> list[int]:
    """``group`` in sorted order of the strings, by way of a blind trie.

    A string walks down by the branching bytes alone to some leaf, is compared with
    that leaf once, and then enters at the depth where they differ.
    """

    def byte(i: int, depth: int) -> int:
        return strings[i][depth] if depth < len(strings[i]) else -1

    equal: dict[int, list[int]] = {group[0]: [group[0]]}
    root = _Node(-1, group[0])  # depth -1: a leaf
    for i in group[1:]:
        node = root
        while node.branches:
            node = node.branches.get(byte(i, node.depth)) or next(iter(node.branches.values()))
        leaf = node.leaf
        if strings[leaf] == strings[i]:
            equal[leaf].append(i)
            continue
        equal[i] = [i]
        differ = common_prefix(strings[leaf], strings[i])
        parent, node = None, root
        while node.branches and node.depth < differ:
            parent, node = node, node.branches[byte(i, node.depth)]
        new = _Node(-1, i)
        if node.branches and node.depth == differ:
            node.branches[byte(i, differ)] = new
            continue
        split = _Node(differ, leaf)
        split.branches = {byte(leaf, differ): node, byte(i, differ): new}
        if parent is None:
            root = split
        else:
            parent.branches[byte(i, parent.depth)] = split
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.branches:
            todo += [node.branches[b] for b in sorted(node.branches, reverse=True)]
        else:
            out += equal[node.leaf]
    return out


def deep_shallow_order(strings: list[bytes], skip: int = 0) -> list[int]:
    """The numbers of ``strings`` in sorted order; all agree in their first ``skip`` bytes."""
    order: list[int] = []
    for group in multikey_quicksort(strings, list(range(len(strings))), skip, skip + SHALLOW):
        order += group if len(group) == 1 else blind_trie_order(strings, group)
    return order


def matches(spans: list[bytes], lefts: list[int], window: int, gram: int) -> list[tuple[int, int] | None]:
    """For each span how far its matches of ``window`` bytes or more reach to the left and right of the anchor."""
    tails = [s[a:] for s, a in zip(spans, lefts, strict=True)]
    heads = [s[:a][::-1] for s, a in zip(spans, lefts, strict=True)]
    rank = [0] * len(spans)
    by_tail = deep_shallow_order(tails, gram)
    for at, i in enumerate(by_tail):
        rank[i] = at
    by_head = deep_shallow_order(heads)
    reach: list[tuple[int, int] | None] = [None] * len(spans)

    def met(i: int, j: int, left: int) -> None:
        right = common_prefix(tails[i], tails[j])
        if left + right >= window:
            for k in (i, j):
                known = reach[k] or (0, 0)
                reach[k] = (max(known[0], left), max(known[1], right))

    # Neighbours by head, the longest common heads first; a set holds ranks by tail.
    joints = sorted(
        ((common_prefix(heads[a], heads[b]), at) for at, (a, b) in enumerate(zip(by_head, by_head[1:], strict=False))), reverse=True
    )
    up = list(range(len(spans)))
    sets = [[rank[i]] for i in by_head]

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for left, at in joints:
        a, b = root(at), root(at + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets[b]
        for r in small:
            place = bisect_left(large, r)
            for near in (place - 1, place):
                if 0 <= near < len(large):
                    met(by_tail[r], by_tail[large[near]], left)
        for r in small:
            insort(large, r)
        up[b], sets[b] = a, []
    return reach


def search(spans: DataFrame, kind: repeats.Units) -> DataFrame:
    """(key, cls, low, high, least): what the matches of each class cover, from its anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for key, group in groupby(rows(), key=lambda r: r[0]):
            classes, contents, lefts = [], [], []
            for _, cls, left, n, content in group:
                for _ in range(min(n, 2)):
                    classes.append(cls)
                    contents.append(content)
                    lefts.append(left)
            reach = matches(contents, lefts, kind.window, kind.gram)
            found = {c: r for c, r in zip(classes, reach, strict=True) if r}
            if found:
                sides = np.array(list(found.values()), np.int64)
                keys = np.full(len(found), key, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (keys, np.array(list(found), np.int64), -sides[:, 0], sides[:, 1], keys * 0)],
                    names=["key", "cls", "low", "high", "least"],
                )

    return (
        spans.select("key", "cls", "left", "n", "content")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(run, "key long, cls long, low long, high long, least long")
    )


def deduplicated(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = repeats.GROUP, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256), a row for each input row.

    ``spans`` are the maximal removed runs of bytes, the end exclusive.
    """
    kind = repeats.Units(window, gram, words=False)
    texts = repeats.keyed(docs, id_col, text_col)
    found = repeats.anchors(texts, kind)
    spans = repeats.spans(texts, found, kind)
    answers = search(spans.where(spans["classes"] <= group), kind)
    crowded = spans.where(spans["classes"] > group)
    if crowded.limit(1).count():
        answers = answers.union(repeats.by_window(crowded, kind).select(answers.columns))
    ranges = repeats.intervals(found, repeats.stage(answers, "repeat-answers"), smaller_only=False)

    def row(text: bytes, runs: list[dict] | None) -> tuple:
        cut, total = repeats.removed(len(text), runs)
        kept, at = hashlib.sha256(), 0
        for a, b in [*cut, (len(text), len(text))]:
            kept.update(text[at:a])
            at = b
        return len(text), total, len(cut), [list(r) for r in cut], kept.hexdigest()

    fields = [
        pa.field("n_bytes", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("n_spans", pa.int64()),
        pa.field("spans", pa.list_(pa.list_(pa.int64()))), pa.field("kept_sha256", pa.string()),
    ]
    ddl = "n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept_sha256 string"
    return repeats.kept_rows(docs, ranges, row, fields, ddl, id_col, text_col)
