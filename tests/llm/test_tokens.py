"""Operators 11 and 12 against the tokenizer libraries and plain restatements."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from custlens.llm import alignment, bpe
from custlens.llm.queries import QUERIES
from custlens.llm.token_counts import byte_symbols

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, ids string, block int, pairs string, DOC_ID_ int"
EDGES = [
    None,
    "",
    " \n\t ",
    "x",
    "a\x0bb \xa0c\x85d",
    "Don't they'RE 12.5% ½²",
    "<|endoftext|>a<|startoftext|> <|endoftext|",
    "İstanbul ΣΑΣ ſtraße ﬁ é é",
    "中文字符 русский \U0001f600\U0001f600 a‍b",
    "tail  ",
    "▁x ▁",
    "<s> <unk> <0x41>",
    "\x00\x01",
    "same text",
    "same text",
]
LONG = ["a" * 30_000, "!?" * 9_000 + "x", "word " * 12_000, "ab" * 40 + "é" * 5_000]


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in zip(ids, texts, strict=True)], DOCS)


def random_texts(n=300):
    rng = random.Random(5)
    pool = [*"abcXYZ019 \t\n'éßΣς½!?<|>_-.,中ﬁ\xa0́", "<|endoftext|>", "'s", "the "]
    return ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(n)]


def sample(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]


# --- 11 ----------------------------------------------------------------------


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_codec_equals_the_library(spark, name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    codec = bpe.Codec(public_tokenizers.path(name))
    texts = [t or "" for t in EDGES + LONG] + random_texts() + sample(spark)
    ids, starts = codec.encode(pa.array(texts))
    texts_again = codec.decode(ids, starts).to_pylist()
    for text, a, b, again in zip(texts, starts, starts[1:], texts_again, strict=False):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want
        assert again == library.decode(want, skip_special_tokens=False)


def test_cuts_are_where_no_token_has_the_pair():
    codec = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    tokens = {codec.token_bytes(t) for t in codec.vocab}
    pieces = ["hello", "!?a", "zqxj", "".join(byte_symbols()[b] for b in "中文é".encode())]
    fragments, last = codec.cut(pieces)
    assert "".join(fragments) == "".join(pieces) and last.sum() == len(pieces)
    for a, b, ends in zip(fragments, fragments[1:], last, strict=False):
        if not ends:
            pair = codec.token_bytes(a[-1]) + codec.token_bytes(b[0])
            assert not any(pair in t for t in tokens)
    for f in fragments:
        data = codec.token_bytes(f)
        assert all(any(data[i : i + 2] in t for t in tokens) for i in range(len(data) - 1))
    assert codec.by_parts


def test_long_and_short_merging_agree():
    codec = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    rng = random.Random(1)
    for _ in range(300):
        symbols = rng.choices("aehinorst", k=rng.randint(1, bpe.SHORT))
        assert codec.merged(list(symbols)) == codec._merged_long(list(symbols))


def test_kept_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 10)
    library, codec = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY)), bpe.Codec(public_tokenizers.path(bpe.VOCABULARY))
    for text in random_texts(60):
        ids, _ = codec.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(codec.parts) <= 10 and len(codec.fragments) <= 10


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    again = library.decode(ids, skip_special_tokens=False)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(again.encode())


@pytest.mark.parametrize("limit", [bpe.SLICE_BYTES, 40])
def test_round_trip_and_real_outputs(spark, limit):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    texts = EDGES + LONG[:2]
    ids = [None, 7, 7, *range(10, 10 + len(texts) - 3)]
    frame = docs(spark, texts, ids)
    got = bpe.round_trip(frame, slice_bytes=limit)
    want = Counter((i, *digests(library, t)) for i, t in zip(ids, texts, strict=True))
    assert Counter(tuple(r) for r in got.collect()) == want
    coded = bpe.encoded(frame, slice_bytes=limit)
    again = Counter((r.doc_id, r.text) for r in bpe.decoded(coded).collect())
    plain = [library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for t in texts]
    assert again == Counter(zip(ids, plain, strict=True))
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {tuple(r) for r in bpe.decoded(nothing).collect()} == {(1, None), (2, "")}
    assert bpe.round_trip(frame.limit(0)).count() == 0 and bpe.encoded(frame.limit(0)).count() == 0


def test_op11_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {(r.doc_id, *digests(library, r.text)) for r in rows}
    assert {tuple(r) for r in QUERIES["op11_bpe"](spark, SF).collect()} == want


# --- 12 ----------------------------------------------------------------------


def slow_alignment(texts):
    """Per text: (A ids, B ids, groups, links), by offsets that both sides have."""
    a_lib = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    a_lib.encode_special_tokens = True
    b_lib = SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    out = []
    for text in texts:
        if not text:
            out.append(([], [], [], []))
            continue
        whole = b" " + text.encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        of_a = [bytes(byte_of[c] for c in a_lib.id_to_token(i)) for i in a]
        of_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_lib.id_to_piece(i)]]
        if b"".join(of_a) != whole or b"".join(of_b) != whole:
            out.append(([], [], [], []))
            continue
        at = 0
        spans = []
        for tokens in (of_a, of_b):
            at, side = 0, []
            for t in tokens:
                side.append((at, at + len(t)))
                at += len(t)
            spans.append(side)
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        low = 0
        for high in both:
            inside = lambda s: low <= s[0] and s[1] <= high  # noqa: E731, B023
            groups.append(([i for i, s in zip(a, spans[0], strict=True) if inside(s)], [i for i, s in zip(b, spans[1], strict=True) if inside(s)], low, high))
            low = high
        links = [(i, j) for i, s in zip(a, spans[0], strict=True) for j, t in zip(b, spans[1], strict=True) if s[0] < t[1] and t[0] < s[1]]
        out.append((a, b, groups, links))
    return out


def slow_report(texts):
    found = slow_alignment(texts)
    docs_of = Counter(p for _, _, _, links in found for p in set(links))
    most = defaultdict(int)
    for (a, _), n in docs_of.items():
        most[a] = max(most[a], n)
    rows = []
    for a, b, groups, links in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y, _, _ in groups)
        rows.append(
            (
                len(a),
                len(b),
                len(groups),
                len(links),
                sum(docs_of[p] == most[p[0]] for p in links),
                sum(docs_of[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if a else "",
            )
        )
    return rows, docs_of


@pytest.mark.parametrize("limit", [alignment.BLOCK_BYTES, 300])
def test_alignment_equals_brute_force(spark, limit):
    texts = EDGES + [t[:60] for t in LONG] + random_texts(80) + [(t or "")[:400] for t in sample(spark)[:20]]
    ids = [None, 3, 3, *range(10, 10 + len(texts) - 3)]
    rows, docs_of = slow_report(texts)
    frame = docs(spark, texts, ids).repartition(3)
    got = Counter(tuple(r) for r in alignment.report(frame, block_bytes=limit).collect())
    assert got == Counter((i, *r) for i, r in zip(ids, rows, strict=True))
    pairs = {(r.a, r.b): (r.docs, r.best) for r in alignment.pair_counts(frame, block_bytes=limit).collect()}
    assert {p: n for p, (n, _) in pairs.items()} == docs_of
    most = defaultdict(int)
    for (a, _), n in docs_of.items():
        most[a] = max(most[a], n)
    assert all(best == (n == most[a]) for (a, _), (n, best) in pairs.items())


def test_real_groups(spark):
    texts = EDGES + random_texts(30)
    got = {r.doc_id: r.groups for r in alignment.aligned(docs(spark, texts), block_bytes=200).collect()}
    for i, (_, _, groups, _) in enumerate(slow_alignment(texts)):
        assert [(g.a, g.b, g.start, g.end) for g in got[i]] == groups


def test_alignment_of_long_and_of_no_texts(spark):
    frame = docs(spark, LONG)
    for r in alignment.report(frame).collect():
        assert r.n_a and r.n_b and r.n_groups and r.n_links >= max(r.n_a, r.n_b)
    assert alignment.report(frame.limit(0)).count() == 0
    assert alignment.pair_counts(docs(spark, [None, ""])).count() == 0
    assert [tuple(r) for r in alignment.report(docs(spark, [None])).collect()] == [(0, 0, 0, 0, 0, 0, 0, "")]


def test_op12_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = [r for r in rows if r.text is None or len(r.text) < 6000]
    want, _ = slow_report([r.text for r in short])
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_token_alignment"](spark, SF).collect()}
    assert len(got) == len(rows)
    # Counts over the corpus need all documents; the other columns are a document's own.
    for r, w in zip(short, want, strict=True):
        assert got[r.doc_id][:4] == w[:4] and got[r.doc_id][-1] == w[-1]
    if len(short) == len(rows):
        assert {i: t for i, t in got.items()} == {r.doc_id: w for r, w in zip(short, want, strict=True)}
