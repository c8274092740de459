import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from custlens.llm import fm_dedup, repeats, suffix_dedup
from custlens.llm.queries import QUERIES

# Names that clash with those inside the operators.
SCHEMA = "doc_id long, text string, ID string, th int, runs string, key int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in rows], SCHEMA)


def corpus(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(40)]
    passages = [" ".join(rng.choices(vocabulary, k=words)) for _ in range(3)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randrange(1, words))) for _ in range(rng.randrange(1, 4))]
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    return rows + [(n, rows[0][1]), (n + 1, "ab " * 40), (n + 2, None), (n + 3, ""), (n + 4, " \t"), (None, rows[1][1]), (2, rows[2][1])]


def brute_bytes(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + window] for _, b in texts for i in range(len(b) - window + 1))
    out = []
    for d, b in texts:
        cut = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                cut[i : i + window] = True
        runs = int((cut & ~np.concatenate([[False], cut[:-1]])[: len(cut)]).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~cut])
        out.append((d, len(b), int(cut.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_words(rows, window):
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, repeats.NO_ID), repeats.NO_ID if d is None else d)
    out = []
    for d, w in texts:
        cut = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (repeats.NO_ID if d is None else d):
                cut[i : i + window] = [True] * window
        kept = " ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out.append((d, len(w), sum(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
def test_suffix_dedup_equals_brute_force(spark, group):
    rows = corpus(5, 40, 30)
    got = suffix_dedup.deduplicated(frame(spark, rows), window=40, gram=8, group=group)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == brute_bytes(rows, 40)


def test_op8_finds_planted_passages_and_leaves_clean_documents(spark, tmp_path):
    rng = random.Random(8)

    def words(n, least):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(least, least + 4))) for _ in range(n))

    passage, short = words(60, 7), words(55, 3)
    assert len(passage) >= 400 > len(short) + 2
    planted = [(i, f"{words(30, 5)} {passage} {words(30, 5)}") for i in range(4)]
    # Over 50 words in common, but fewer than 400 bytes.
    below = [(i, f"{words(30, 5)}.{short}.{words(30, 5)}") for i in range(4, 8)]
    clean = [(i, words(200, 5)) for i in range(8, 12)]
    rows = planted + below + clean
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op8_suffix_dedup"](spark, str(tmp_path))
    # Further columns only follow those of the contract.
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    found = sorted(map(tuple, got.collect()))
    assert [r[:5] for r in found] == sorted(brute_bytes(rows, 400))
    assert [r[2] >= len(passage) for r in found] == [True] * 4 + [False] * 8
    assert [r[2] for r in found[4:]] == [0] * 8
    assert [[b - a for a, b in r[5]] for r in found] == [[r[2]] if r[2] else [] for r in found]


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
def test_fm_dedup_equals_brute_force(spark, group):
    rows = corpus(6, 40, 20)
    got = fm_dedup.deduplicated(frame(spark, rows), window=9, gram=3, shard=10, group=group)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == brute_words(rows, 9)


def test_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 100)
    rng = random.Random(1)
    data = np.array([rng.randrange(97, 100) for _ in range(1000)], np.uint8)
    kind = repeats.Units(20, 5, words=False)
    windows = 0
    for _, shift, part, where in repeats._segments(data, np.array([0, 1000]), 20):
        _, key, _, pos, left, right = repeats.anchors_of(part, where, kind)
        windows += int((left + right - 19).sum())
        for k, p in zip(key, pos + shift, strict=True):
            same = [q for q in range(996) if bytes(data[q : q + 5]) == bytes(data[p : p + 5])]
            assert p in same and k
    assert windows == 1000 - 20 + 1


def test_empty_tables(spark):
    assert suffix_dedup.deduplicated(frame(spark, [])).collect() == []
    assert fm_dedup.deduplicated(frame(spark, [])).collect() == []


def test_deep_shallow_order_sorts():
    rng = random.Random(1)
    for _ in range(60):
        base = bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 70, 200])))
        strings = [base + bytes(rng.choices(b"abc", k=rng.randrange(12))) for _ in range(rng.choice([1, 3, 20]))]
        order = suffix_dedup.deep_shallow_order(strings)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)


def test_fm_index_gives_all_occurrences():
    rng = random.Random(3)
    for _ in range(40):
        spans = [np.array(rng.choices(range(3), k=rng.randrange(5, 15)), np.uint64) for _ in range(rng.randrange(1, 12))]
        ids = np.array([rng.randrange(100) for _ in spans])
        got = {(int(s), int(i)): int(x) for batch in fm_dedup.occurrences(spans, ids, 5) for s, i, x in zip(*batch, strict=True)}
        places = {}
        for s, w in enumerate(spans):
            for i in range(len(w) - 4):
                places.setdefault(tuple(w[i : i + 5]), []).append((s, i))
        assert got == {p: min(int(ids[s]) for s, _ in group) for group in places.values() for p in group}


def test_wavelet_matrix_counts():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 37, 500)
    wavelet = fm_dedup.WaveletMatrix(symbols, 37)
    asked, low = rng.integers(0, 37, 200), rng.integers(0, 501, 200)
    a, b = wavelet.rank(asked, low, np.full(200, 500))
    assert a.tolist() == [int((symbols[:x] == s).sum()) for s, x in zip(asked, low, strict=True)]
    assert b.tolist() == [int((symbols == s).sum()) for s in asked]
