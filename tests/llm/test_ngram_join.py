import random
import re

import numpy as np
import pytest

from custlens.llm import ngram_join
from custlens.llm import text_arrays as arrays

SCHEMA = "doc_id long, text string, N_SHINGLES string, component_id int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words=4, percent=85):
    sets = []
    for doc_id, text in rows:
        found = WORD.findall((text or "").translate(LOWER))
        grams = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or ({tuple(found)} if found else set())
        sets.append((doc_id, frozenset(grams)))
    up = {d: d for d, _ in sets if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if None not in (a, b) and both and 100 * both >= percent * (len(s) + len(t) - both):
                a_, b_ = root(a), root(b)
                up[max(a_, b_)] = min(a_, b_)
    return sorted(((d, len(s), d if d is None else root(d)) for d, s in sets), key=repr)


def run(spark, rows, **settings):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    return sorted(map(tuple, ngram_join.linked(docs, **settings).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.75:
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: max(1, len(words) - rng.randrange(12))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 8, 20, 60, 150]))]
        texts.append(" ".join(words))
        rows.append((i, texts[-1].upper() if rng.random() < 0.1 else texts[-1]))
    return rows


def test_components_equal_brute_force(spark):
    rows = corpus(3, 260) + [(900, None), (901, ""), (902, " \n"), (None, "w1 w2 w3 w4 w5"), (5, corpus(3, 260)[5][1])]
    assert run(spark, rows) == brute(rows)


def test_split_blocks_find_the_same(spark):
    rows = corpus(4, 160)
    assert run(spark, rows, block=300) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_of_each_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "x", 1), (2, "A b c d e", "y", 2), (3, "q", "z", 3), (3, "q", "z", 3)], SCHEMA)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("percent", [75, 80, 85, 90])
def test_every_linked_pair_shares_a_signature(percent):
    rng, bands = np.random.default_rng(1), ngram_join.Bands(percent)
    for turn in range(400):
        heavy = rng.random(ngram_join.SLOTS) < (0, 0.1, 0.5, 1)[turn % 4] if turn % 40 < 4 else heavy
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = a[rng.random(len(a)) > rng.choice([0, 0.02, 0.08, 0.15])]
        b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 6))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and not np.array_equal(a, b) and 100 * both >= percent * (len(a) + len(b) - both):
            assert len(np.intersect1d(ngram_join.signatures(a, bands, heavy), ngram_join.signatures(b, bands, heavy)))


def test_occurrence_search_equals_counting():
    rng = random.Random(2)
    sets = sorted((sorted(rng.sample(range(60), rng.randrange(20, 40))) for _ in range(60)), key=len)
    sets = [np.array(s, np.uint64) for s in sets]
    index = ngram_join.Index(sets)
    for x, s in enumerate(sets):
        got = list(ngram_join.occurrence_search(s, index, np.ones(x, bool), 60))
        want = [y for y in range(x) if len(np.intersect1d(s, sets[y])) >= ngram_join.required(len(s), len(sets[y]), 60)]
        assert sorted(got) == want


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["", None, "  a B\n", "x", " y", "É z\x0bq", "a\xa0b A"]
    for _, data, offsets in arrays.chunks(pa.array(texts), 4):
        starts, ends, rows, hashes = arrays.word_hashes(data, offsets, lower=True)
        assert len(starts) == len(hashes) == len(rows) == len(ends)
    _, data, offsets = next(arrays.chunks(pa.array(texts)))
    starts, ends, rows, hashes = arrays.word_hashes(data, offsets, lower=True)
    words = [data[a:b].tobytes().lower() for a, b in zip(starts, ends, strict=True)]
    assert words == [w for t in texts for w in (t or "").encode().lower().split()]
    assert len(set(hashes.tolist())) == len(set(words))


def strangers(n, words, share):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(int(words * share))]
    return [(i, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(words - len(passage))])) for i in range(n)]


def test_a_shared_passage_does_not_keep_strangers_in_a_block(spark):
    rows = strangers(200, 200, 0.2)
    rows += [(1000 + i, t.replace(" p7 ", " q ")) for i, t in rows[:12]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.sets_and_counts(docs, 4, "doc_id", "text")
    classes, counts = ngram_join.classes_of(ngram_join.sets_of(found)), ngram_join.slot_counts(found)
    sizes = {}
    for name, heavy in (("counted", ngram_join.heavy_slots(counts)), ("none", counts < 0)):
        for block in (10**9, 3000):
            found = ngram_join.blocks(docs, classes, heavy, 4, 85, block, "doc_id", "text").collect()
            of = {r.doc_id: r.block for r in found}
            assert len(of) == len(found) and all(of[i] == of[1000 + i] for i in range(12))
            sizes[name, block] = max(sum(r.n for r in found if r.block == b) for b in set(of.values()))
    # Knowing the heavy shingles keeps strangers apart; without that the further salts must.
    assert sizes["counted", 10**9] < 500
    assert sizes["none", 10**9] > 3000 >= sizes["none", 3000]
    assert run(spark, rows, block=3000) == brute(rows)


def test_a_block_that_stays_large_is_searched_in_bounded_cells(spark):
    rows = [(i, 1, 20, 0 if i % 3 == 0 else i) for i in range(300)] + [(900, 2, 20, 900), (901, 2, 20, 900)]
    grouped = spark.createDataFrame(rows, "doc_id long, block long, n long, component long")
    held = {}
    for r in ngram_join.cells(grouped, 1000).collect():
        assert r.block == 1 and r.ask == (r.doc_id % 3 != 0)
        held.setdefault(r.part, []).append(r.doc_id)
    assert max(20 * len(x) for x in held.values()) <= 1600  # parts are dealt by a hash
    met = {(a, b) for x in held.values() for a in x for b in x}
    assert all((a, b) in met for a in range(300) for b in range(300) if a % 3 or b % 3)


def test_near_copies_meet_across_cells(spark):
    rng, rows = random.Random(5), strangers(60, 60, 0.8)
    for i, t in rows[:40]:
        words = t.split()
        words[rng.randrange(10, 60)] = "z"
        rows.append((500 + i, " ".join(words)))
    assert run(spark, rows, block=400, percent=80) == brute(rows, percent=80)


def test_one_of_each_goes_by_sets_and_not_by_ids(spark):
    rows = [(1, "a b c d e"), (None, "A b c d e"), (None, "f g h i"), (None, "j k l m"), (None, "J K L M"), (7, "n o p q"), (7, "r s t u"), (8, "R S T U"), (9, None), (None, ""), (7, "n o p q"), (6, " ")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    kept = [(r.doc_id, (r.text or "").lower()) for r in ngram_join.one_of_each(docs).collect()]
    want = [(1, "a b c d e"), (None, "f g h i"), (None, "j k l m"), (7, "n o p q"), (7, "r s t u"), (9, ""), (None, ""), (6, " ")]
    assert sorted(kept, key=repr) == sorted(want, key=repr)
    again = [(r.doc_id, r.text) for r in ngram_join.one_of_each(docs.repartition(5)).collect()]
    assert sorted(again, key=repr) == sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect()), key=repr)


@pytest.mark.parametrize("percent", [75, 80, 85, 90])
def test_thresholds_and_shared_passages_equal_brute_force(spark, percent):
    rng, rows = random.Random(percent), corpus(6, 60)
    for k, share in enumerate((0.2, 0.5, 0.8, 0.9)):
        rows += [(1000 * (k + 1) + i, t) for i, t in strangers(12, 50, share)]
    for i, t in rows[-12:]:
        words = t.split()
        words[rng.randrange(50)] = "z"
        rows.append((9000 + i, " ".join(words)))
    assert run(spark, rows, percent=percent) == brute(rows, percent=percent)


def test_slot_counts_count_sets(spark):
    docs = spark.createDataFrame([(i, f"a b c d x{i % 3}") for i in range(30)], "doc_id long, text string").repartition(4)
    counts = ngram_join.slot_counts(ngram_join.sets_and_counts(docs, 4, "doc_id", "text"))
    assert sorted(counts[counts > 0].tolist()) == [10, 10, 10, 30]


def test_components_of_hubs_chains_and_rings(spark):
    from custlens.llm.graph import components

    rng = random.Random(4)
    links = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    links += [(5, 5), (3001, 3000), (3000, 3001)] + [(199, 1100)]
    rng.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    want = {i: 0 for i in [*range(200), *range(1000, 1201)]} | {2000 + i: 2000 for i in range(50)} | {3000: 3000, 3001: 3000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
