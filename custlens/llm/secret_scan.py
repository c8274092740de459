"""Operator 2, secret scans by token efficiency.

Three patterns give the base spans: assignments to a name such as ``password``,
cloud access keys, and long hexadecimal strings. The method adds spans of kind
``random``: runs of key characters (letters, digits, ``+/_=-``) of ``MIN_RUN`` code
points or more that a byte-level vocabulary encodes badly, at fewer than
``MAX_CHARS_PER_TOKEN`` characters per token. Words of any language take few
tokens; random strings take nearly one for two characters. In a run that looks like
a path or a name of words and numbers, or that is encoded well as a whole, the token
ratio decides for each part between separators, letters alone included; badly encoded
neighbours and the short parts between them are joined to ``MIN_RUN`` code points.
Of a long part that is encoded well, the stretches of ``MIN_RUN`` code points that
are not are found by a sliding window, so words around a secret don't hide it. Known digests (hexadecimal of a digest's length, with or without an algorithm's
name), UUIDs, plain numbers, dates and parts that are encoded well are left out,
and base spans are cut out of a run: what they leave of it is judged for itself.

The work is a map over whole texts; nothing is shuffled. Null or empty text: no
spans. Repeated rows get equal results; extra columns are ignored.

Spans are (kind, start, end) in code points, the end exclusive, in order of start
and then of kind as listed in ``KINDS``.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
MIN_RUN = 20
MAX_CHARS_PER_TOKEN = 2.2

# The kinds in their order, the base patterns and the least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16

# The splitting pattern of the vocabulary, and lengths of digests in hexadecimal.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))

RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
UUID_APART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])")
HEX_ANY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
DIGEST_NAME = re.compile(r"(?i)(md5|sha-?1|sha-?224|sha-?256|sha-?384|sha-?512)[-_=]")
PART = re.compile(r"[A-Za-z0-9]+")
# Parts too short to tell: they join neighbours, but prove nothing themselves.
SHORT = re.compile(r"(?=.{1,3}$)[A-Za-z]*[0-9]*|[0-9]{1,5}")
# A name of words and numbers: parts of letters or of digits, joined by separators.
IDENTIFIER = re.compile(r"[A-Za-z]+[0-9]{0,4}([+/_=-]+([A-Za-z]+[0-9]{0,4}|[0-9]{1,10}))*|[0-9+/_=-]+")


@functools.cache
def vocabulary(path: str):
    """The vocabulary as an encoding of the library."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def known(run: str) -> bool:
    """True for digests, UUIDs and plain numbers."""
    named = DIGEST_NAME.match(run)
    bare = run[named.end() :] if named else run
    return bool(
        (HEX_ANY.fullmatch(bare) and len(bare) in DIGEST_LENGTHS) or UUID.fullmatch(run) or not any(map(str.isalpha, run))
    )


def inefficient(run: str, encoding) -> bool:
    return len(run) < MAX_CHARS_PER_TOKEN * len(encoding.encode_ordinary(run))


def windows(part: str, encoding) -> list[tuple[int, int]]:
    """(start, end) of the stretches of whole tokens of a part in which each ``MIN_RUN`` code points are badly encoded."""
    cuts = [0]
    for token in encoding.encode_ordinary(part):
        cuts.append(cuts[-1] + len(encoding.decode_single_token_bytes(token)))
    found: list[tuple[int, int]] = []
    last = 0
    for first, start in enumerate(cuts):
        while last < len(cuts) and cuts[last] < start + MIN_RUN:
            last += 1
        if last == len(cuts):
            break
        if cuts[last] - start < MAX_CHARS_PER_TOKEN * (last - first):
            if found and start <= found[-1][1]:
                found[-1] = found[-1][0], cuts[last]
            else:
                found.append((start, cuts[last]))
    return found


def stretches(run: str, encoding) -> Iterator[tuple[int, int]]:
    """(start, end) of the badly encoded stretches of a run."""
    if known(run):
        return
    if any(map(str.isdigit, run)) and not IDENTIFIER.fullmatch(run) and inefficient(run, encoding):
        yield 0, len(run)
        return
    start = end = None
    bad = False
    for m in [*PART.finditer(run), None]:
        part = m.group() if m else ""
        short = bool(SHORT.fullmatch(part))
        worse = bool(part) and not short and not known(part) and inefficient(part, encoding)
        if short or worse:
            start, end, bad = m.start() if start is None else start, m.end(), bad or worse
            continue
        if bad and end - start >= MIN_RUN and inefficient(run[start:end], encoding):
            yield start, end
        start, bad = None, False
        if len(part) >= MIN_RUN and not known(part):
            yield from ((m.start() + a, m.start() + b) for a, b in windows(part, encoding))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the three patterns."""
    spans = []
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(name in lower for name in ASSIGN_NAMES):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # A run of 32 or more is found from its first character, as the plain pattern finds it.
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def random_spans(text: str, taken: list[tuple[str, int, int]], encoding) -> list[tuple[str, int, int]]:
    """Runs that the vocabulary encodes badly, outside the spans in ``taken``."""
    spans = []
    for m in RUN.finditer(text):
        start, end = m.span()
        if known(m.group()):
            continue
        # What the base spans and UUIDs leave of the run.
        cut = [(a, b) for _, a, b in taken if a < end and start < b]
        cut += [u.span() for u in UUID_APART.finditer(text, start, end)]
        low = start
        for a, b in [*sorted(cut), (end, end)]:
            if a - low >= MIN_RUN:
                spans += [("random", low + x, low + y) for x, y in stretches(text[low:a], encoding)]
            low = max(low, b)
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


_FIELDS = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_path: str = os.path.join(TOKENIZER_DIR, VOCABULARY),
) -> DataFrame:
    """(doc_id, counts by kind, base_sha256, spans), a row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(vocabulary_path)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                more = random_spans(text, base, encoding)
                counts = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*counts, len(more), digest, joined(base + more)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {id_type}, {_FIELDS}")
