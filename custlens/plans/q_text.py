"""Registered queries for text preparation and the scalar text/time helpers:
C16–C18, F13, F19–F23, P8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.dates import parse_timestamp_any
from custlens.functions.text import PROMPT_TEMPLATE, canonical_name, clean_tweet, normalise_person_name
from custlens.operators.textprep import (
    DEFAULT_EOS,
    TOKEN_PATTERN,
    flag_overlength,
    instruction_dataset,
    keyword_filter,
    render_transcript,
    strip_eos,
    transcript_messages,
    transcripts,
    with_prompt_text,
)
from custlens.plans.registry import edge, query
from custlens.sources import fixtures as fx
from custlens.sources.tables import read_table


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_HEAD, _REST = PROMPT_TEMPLATE.split("{}", 1)
_MID1, _REST = _REST.split("{}", 1)
_MID2, _END = _REST.split("{}", 1)
_PROMPT_SQL = (
    f"{_lit(_HEAD)} || instruction || {_lit(_MID1)} || input || {_lit(_MID2)} || output || {_lit(_END)} || {_lit(DEFAULT_EOS)}"
)


@query("prompt_text", fx.with_fixtures(f"SELECT doc_id, {_PROMPT_SQL} AS text FROM instructions", "instructions"))
def q_prompt_text(spark: SparkSession, sf: str) -> DataFrame:
    """The training text of every instruction row (whole texts)."""
    return with_prompt_text(fx.instructions(spark, sf)).select("doc_id", "text")


@query("instruction_union", fx.with_fixtures(f"SELECT doc_id, {_PROMPT_SQL} AS text FROM instructions", "instructions"))
def q_instruction_union(spark: SparkSession, sf: str) -> DataFrame:
    """C16 (U1, P2, P10): two instruction sets with differently cased headers,
    English and all other rows, stacked into one."""
    rows = fx.instructions(spark, sf)
    english = F.col("instruction").eqNullSafe("en")
    cased = rows.filter(english).select(*[F.col(c).alias(c.capitalize() if c != "doc_id" else "DOC_ID") for c in rows.columns])
    return instruction_dataset([cased, rows.filter(~english)], check_empty=False).select("doc_id", "text")


@query(
    "eos_strip",
    fx.with_fixtures(
        f"""SELECT doc_id, CASE WHEN suffix(t, {_lit(DEFAULT_EOS)}) THEN left(t, length(t) - {len(DEFAULT_EOS)}) ELSE t END AS text
FROM (SELECT doc_id, {_PROMPT_SQL} AS t FROM instructions)""",
        "instructions",
    ),
)
def q_eos_strip(spark: SparkSession, sf: str) -> DataFrame:
    """the end marker removed again from the training text."""
    return strip_eos(with_prompt_text(fx.instructions(spark, sf))).select("doc_id", "text")


@query(
    "transcripts",
    fx.with_fixtures("""SELECT conv_id, count(*) AS n_messages,
       string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript
FROM (SELECT * FROM chat_turns
      QUALIFY NOT (row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1
                   AND role = 'assistant' AND coalesce(text, '') = ''))
GROUP BY conv_id""", "chat_turns"),
)
def q_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """C17: ordered role/content messages per conversation, rendered."""
    t = transcripts(fx.chat_turns(spark, sf))
    return t.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        render_transcript(F.col("messages")).alias("transcript"),
    )


@query(
    "transcript_messages",
    fx.with_fixtures("""SELECT conv_id, turn, role, text AS content
FROM (SELECT * FROM chat_turns
      QUALIFY NOT (row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1
                   AND role = 'assistant' AND coalesce(text, '') = ''))""", "chat_turns"),
)
def q_transcript_messages(spark: SparkSession, sf: str) -> DataFrame:
    """C17 long form: ordered messages, one row each, no per-conversation gather."""
    return transcript_messages(fx.chat_turns(spark, sf))


@query(
    "overlength",
    """SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS INTEGER) AS n_words,
       len(regexp_extract_all(text, '\\S+')) > 2048 AS over_length
FROM documents""",
)
def q_overlength(spark: SparkSession, sf: str) -> DataFrame:
    """Words per document and the over-length flag (2048)."""
    return flag_overlength(read_table(spark, sf, "documents", ["doc_id", "text"])).select("doc_id", "n_words", "over_length")


_KEYWORDS = ["that", "und", "que"]


@query(
    "keyword_filter",
    f"""SELECT doc_id, lang, source FROM documents
WHERE len(list_intersect(regexp_extract_all(lower(text), '{TOKEN_PATTERN}'), {_KEYWORDS!r})) > 0""",
)
def q_keyword_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Documents containing any keyword as a whole word (no row cap)."""
    docs = read_table(spark, sf, "documents", ["doc_id", "lang", "source", "text"])
    return keyword_filter(docs, _KEYWORDS).select("doc_id", "lang", "source")


_SINCE, _UNTIL, _ROW_CAP = "2024-01-05 00:00:00", "2024-01-20 12:00:00", 500


@query(
    "event_search",
    f"""SELECT event_id, ts, event_type FROM events
WHERE lower(event_type) IN ('purchase', 'signup') AND ts >= TIMESTAMP '{_SINCE}' AND ts < TIMESTAMP '{_UNTIL}'
ORDER BY ts, event_id LIMIT {_ROW_CAP}""",
)
def q_event_search(spark: SparkSession, sf: str) -> DataFrame:
    """A search with keywords, a date range and a row cap (the cap is
    part of the search) after a total order."""
    events = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    return keyword_filter(
        events, ["Purchase", "signup"], "event_type", "ts", _SINCE, _UNTIL, limit=_ROW_CAP, order_by=["ts", "event_id"]
    )


@query(
    "text_cleaned",
    """SELECT doc_id, trim(regexp_replace(
         regexp_replace(regexp_replace(regexp_replace(lower(text), 'https?://\\S+|www\\.\\S+', ' ', 'g'),
                                       '@\\w+', ' ', 'g'),
                        '[^\\p{L}\\p{N}#\\s]', ' ', 'g'),
         '\\s+', ' ', 'g')) AS cleaned
FROM documents""",
)
def q_text_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """text cleaning (lower, no URLs / mentions / symbols, one blank)."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", clean_tweet("text").alias("cleaned"))


@query(
    "name_normalised",
    fx.with_fixtures(
        """SELECT staff_id, array_to_string(list_transform(string_split(lower(trim(regexp_replace(staff_name, '\\s+', ' ', 'g'))), ' '),
                          lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS staff_name
FROM staff_directory""",
        "staff_directory",
    ),
)
def q_name_normalised(spark: SparkSession, sf: str) -> DataFrame:
    """employee names with single blanks and title case."""
    d = fx.staff_directory(spark, sf)
    return d.select("staff_id", normalise_person_name("staff_name").alias("staff_name"))


# The timestamp layouts accepted by the cleaning step, in order.
TS_FORMATS = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"]


@query(
    "timestamps_cleaned",
    "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
)
def q_timestamps_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """event times written in three layouts (rotating by event id) are
    parsed back to one timestamp."""
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    k = F.col("event_id") % len(TS_FORMATS)
    text = F.when(k == 0, F.date_format("ts", TS_FORMATS[0]))
    for i, fmt in enumerate(TS_FORMATS[1:], start=1):
        text = text.when(k == i, F.date_format("ts", fmt))
    return ev.select("event_id", parse_timestamp_any(text, TS_FORMATS).alias("ts"))


_CANON_RULES = [("brand#1", "Brand#1x"), ("brand#2", "Brand#2x")]


@query(
    "product_canonical",
    """SELECT p_partkey, p_brand,
       CASE WHEN contains(lower(CASE WHEN contains(lower(p_brand), 'brand#1') THEN 'Brand#1x' ELSE p_brand END), 'brand#2')
            THEN 'Brand#2x'
            ELSE CASE WHEN contains(lower(p_brand), 'brand#1') THEN 'Brand#1x' ELSE p_brand END END AS given_product_name
FROM part""",
)
def q_product_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """ordered case-insensitive contains rules → canonical names."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_brand"])
    return edge(part.select("p_partkey", "p_brand", canonical_name("p_brand", _CANON_RULES).alias("given_product_name")))


@query("train_split", fx.with_fixtures(f"SELECT doc_id, {_PROMPT_SQL} AS text FROM instructions", "instructions"))
def q_train_split(spark: SparkSession, sf: str) -> DataFrame:
    """S6 → S7: the prepared training rows are published as the ``train``
    split (JSON lines, in the shared checkpoint folder) and that split is
    loaded back; only its partition directory is read."""
    import uuid

    from custlens.operators.textprep import load_split, publish
    from custlens.session import scratch_path

    path = scratch_path(spark, f"published-{uuid.uuid4().hex}")
    publish(with_prompt_text(fx.instructions(spark, sf)).select("doc_id", "text"), path, split="train")
    return load_split(spark, path, "train", schema="doc_id bigint, text string")


# The search's row cap; it exceeds what one task merges.
ROW_CAP = 20_000


@query(
    "row_cap",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice, l_orderkey, l_linenumber LIMIT {ROW_CAP}""",
)
def q_row_cap(spark: SparkSession, sf: str) -> DataFrame:
    """O3: a large row cap after a total order, without a task that holds all kept rows."""
    from custlens.operators.ranking import first_rows

    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    return first_rows(lines, ["l_extendedprice", "l_orderkey", "l_linenumber"], ROW_CAP)


@query(
    "published_version",
    "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority",
)
def q_published_version(spark: SparkSession, sf: str) -> DataFrame:
    """A table is published, then replaced by its next version; readers get the newest."""
    import uuid

    from custlens.session import scratch_path
    from custlens.sources.versions import publish_version, read_version

    path = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    orders = read_table(spark, sf, "orders", ["o_orderpriority", "o_totalprice"])
    totals = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    publish_version(totals.limit(0), path)
    publish_version(totals, path)
    return read_version(spark, path)


@query("documents_csv", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def q_documents_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts, line breaks and quotes included, written as CSV and read back from split files."""
    import uuid

    from custlens.session import scratch_path
    from custlens.sources.files import read_csv_folder

    path = scratch_path(spark, f"documents-csv-{uuid.uuid4().hex}")
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return read_csv_folder(spark, path, ["doc_id"], "doc_id")
