"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The instruction-tuning prompt layout used for training rows.
PROMPT_HEADER = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request."
)
PROMPT_TEMPLATE = PROMPT_HEADER + "\n\n### Instruction:\n{}\n\n### Input:\n{}\n\n### Response:\n{}"
# Region prefixes removed before the ETA lookup.
REGION_PREFIXES = ("Kab. ", "Kota ")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_name(c: ColumnOrName, rules: list[tuple[str, str]]) -> Column:
    """case-insensitive *contains* rules, applied in order to the current
    value; a later rule that matches overwrites an earlier one (each pandas
    assignment overwrites the previous). No rule → the name is kept. NULL
    names never match (``na=False``). Needles are literal text."""
    col = _col(c)
    out = col
    for needle, canonical in rules:
        hit = F.lower(out).contains(F.lit(needle.lower()))
        out = F.when(col.isNotNull() & hit, F.lit(canonical)).otherwise(out)
    return out


def clean_region(c: ColumnOrName) -> Column:
    """strip the literal prefixes ``Kab. `` / ``Kota `` anywhere, lower-case."""
    out = _col(c)
    for prefix in REGION_PREFIXES:
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return F.lower(out)


def prompt_text(instruction: ColumnOrName, input_: ColumnOrName, output: ColumnOrName, eos: str) -> Column:
    """fill the prompt template and append the end-of-sequence token.
    Built with ``concat`` so a NULL field gives a NULL text (never 'None')."""
    head, rest = PROMPT_TEMPLATE.split("{}", 1)
    mid, tail = rest.split("{}", 1)
    mid2, end = tail.split("{}", 1)
    return F.concat(
        F.lit(head), _col(instruction), F.lit(mid), _col(input_), F.lit(mid2), _col(output), F.lit(end), F.lit(eos)
    )


def strip_suffix_token(c: ColumnOrName, token: str) -> Column:
    """drop one trailing ``token`` if present."""
    col = _col(c)
    return F.when(col.endswith(F.lit(token)), F.left(col, F.length(col) - F.lit(len(token)))).otherwise(col)


def normalise_person_name(c: ColumnOrName) -> Column:
    """collapse blanks, trim, title-case."""
    return F.initcap(F.trim(F.regexp_replace(_col(c), r"\s+", " ")))


def clean_tweet(c: ColumnOrName) -> Column:
    """lower-case; drop URLs and @mentions; keep letters, digits, '#';
    collapse blanks."""
    col = F.lower(_col(c))
    col = F.regexp_replace(col, r"https?://\S+|www\.\S+", " ")
    col = F.regexp_replace(col, r"@\w+", " ")
    col = F.regexp_replace(col, r"[^\p{L}\p{N}#\s]", " ")
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def word_count(c: ColumnOrName) -> Column:
    """Number of non-blank runs in the whole text (0 when blank)."""
    return F.size(F.regexp_extract_all(_col(c), F.lit(r"\S+"), 0))
