"""The pipeline stage by stage against brute force, on a fixture with near and exact copies,
leaked benchmark items, junk, empty texts, and NULL and repeated ids."""

from collections import Counter

import numpy as np

import corpus_pipeline
from custlens.llm import decontamination, quality, sharding

from .test_ngram_join import LOWER, WORD
from .test_operators import SF, slow_alignment, slow_base, slow_distance, slow_histograms, slow_targets


def fixture(spark, folder):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(3)
    base = [r for r in documents.where("n_chars between 450 and 1200").orderBy("doc_id").collect() if not slow_base(r.text)[-1]][:16]
    rows = [tuple(r) for r in base]
    at = documents.columns.index("text")

    def add(row, ident, text):
        rows.append((ident, *row[1:at], text, *row[at + 1 :]))

    def edited(text, *places):
        words = text.split(" ")
        for p in places:
            words[p % len(words)] = f"edit{p}"
        return " ".join(words)

    one, two, three, four = rows[:4]
    add(one, 5001, edited(one[at], -1))  # near copies, a chain of them, one in capitals
    add(one, 5002, edited(one[at], -1, -2))
    add(one, None, one[at].upper())
    add(two, two[0], two[at])  # a repeated row
    add(two, None, two[at])
    add(three, 5003, edited(three[at], *range(0, 200, 4)))  # too far
    add(four, 5004, f"{four[at]} one more line")
    add(rows[5], 5005, f"{rows[5][at]} {items.collect()[0].text} {rows[6][at]}")  # leaks
    add(rows[7], None, f"{rows[8][at]} {items.collect()[1].text.upper()} {rows[9][at]}")
    add(rows[7], 5006, "buy now " * 60)
    add(rows[7], 5006, "")
    add(rows[7], None, None)
    documents.sparkSession.createDataFrame(rows, documents.schema).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return [r.text for r in items.collect()]


def quality_keeps(rows):
    own = [slow_histograms(r.text, r.lang) for r in rows]
    langs = [r.lang or "" for r in rows]
    for r, h, lang in zip(rows, own, langs, strict=True):
        refs = [np.sum([o[k] for o, x in zip(own, langs, strict=True) if x == lang], axis=0) for k in (0, 1)]
        chars, hits = (slow_distance(h[k], refs[k]) for k in (0, 1))
        base = slow_base(r.text)
        near = chars <= quality.MAX_CLASS_DISTANCE and hits <= quality.MAX_WORD_DISTANCE
        if not base[-1] and (base[0] < quality.MIN_WORDS or near):
            yield r


def groups(rows, words=5, percent=80):
    """The rows by component of linked sets; rows with an empty set alone."""
    found = [WORD.findall((r.text or "").translate(LOWER)) for r in rows]
    sets = [{tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()) for w in found]
    up = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in range(i):
            if s & sets[j] and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                up = [up[j] if u == up[i] else u for u in up]
    return [[r for r, u in zip(rows, up, strict=True) if u == g] for g in sorted(set(up))]


def leaks(text, items):
    def hashed(t):
        cut = "".join(" " if ord(c) < 128 and not c.isalnum() else c for c in (t or "").lower())
        return np.array([hash(w) for w in cut.split(" ") if w])

    passage = hashed(text)
    return any(slow_alignment(i, passage) >= decontamination.MIN_SCORE * decontamination.MATCH * len(i) for i in map(hashed, items))


def test_stages_equal_brute_force(spark, tmp_path):
    items = fixture(spark, tmp_path)
    outputs = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for n, (_, apply) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/stage{n}"
        apply(spark, outputs[-1], str(tmp_path)).write.parquet(path)
        outputs.append(spark.read.parquet(path))
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])
    given, good, different, clean, mixed, placed = [df.collect() for df in outputs]

    assert Counter(good) == Counter(quality_keeps(given)) and 20 < len(good) < len(given)

    parts = groups(good)
    left = Counter(different)
    assert len(different) == len(parts) < len(good)
    for part in parts:
        least = min((r.doc_id is None, r.doc_id or 0) for r in part)
        best = {r for r in part if (r.doc_id is None, r.doc_id or 0) == least}
        assert sum(left[r] for r in best) == sum(left[r] for r in set(part)) == 1

    want = [r for r in different if not leaks(r.text, items)]
    assert Counter(clean) == Counter(want) and len(different) - len(want) >= 2

    sizes = Counter()
    size = {r: len(WORD.findall(r.text or "")) for r in clean}
    for r in clean:
        sizes[r.source] += size[r]
    taken, copies = Counter(), Counter(mixed)
    for r, n in copies.items():
        assert n <= 2 * Counter(clean)[r]
        taken[r.source] += n * size[r]
    for source, target in slow_targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= max(size[r] for r in clean if r.source == source)

    assert Counter(tuple(r)[:-1] for r in placed) == Counter(map(tuple, mixed))
    assert {r.shard for r in placed} <= set(range(len(sharding.SHARDS)))
    whole = {}
    for r in placed:
        assert whole.setdefault(r.doc_id, r.shard) == r.shard
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, run.collect()), key=repr) == sorted(map(tuple, placed), key=repr)
