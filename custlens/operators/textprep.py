"""Text and conversation preparation.

All per-row work is a native expression over the *whole* text; the one
grouping (C17) is per conversation, whose turns are the feature itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.text import prompt_text, strip_suffix_token, word_count
from custlens.operators.ranking import first_rows
from custlens.sources.tables import lower_case_columns

# Fixed value: the default end-of-sequence marker appended to training rows.
DEFAULT_EOS = "</s>"
# Fixed value: what counts as one token for keyword matching (letters,
# digits, '#', '_' and '-', so hashtags such as #two-words stay whole).
TOKEN_PATTERN = r"[\p{L}\p{N}_#-]+"


class EmptyInput(ValueError):
    """P10: the reference prints a warning and fails later; we fail here."""


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; a missing column is NULL."""
    if not frames:
        raise EmptyInput("no input frames")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def instruction_dataset(frames: list[DataFrame], eos: str = DEFAULT_EOS, check_empty: bool = True) -> DataFrame:
    """Lower-case the headers (P2), union the instruction files (U1),
    refuse an empty result (P10), and add the training ``text`` (F19)."""
    df = union_frames([lower_case_columns(f) for f in frames])
    if check_empty and df.isEmpty():
        raise EmptyInput("instruction data is empty")
    return with_prompt_text(df, eos=eos)


def with_prompt_text(
    df: DataFrame, instruction: str = "instruction", input_: str = "input", output: str = "output", eos: str = DEFAULT_EOS
) -> DataFrame:
    """add ``text`` = the filled template + end-of-sequence marker."""
    return df.withColumn("text", prompt_text(instruction, input_, output, eos))


def strip_eos(df: DataFrame, col: str = "text", eos: str = DEFAULT_EOS) -> DataFrame:
    """remove one trailing end-of-sequence marker."""
    return df.withColumn(col, strip_suffix_token(col, eos))


def transcripts(
    turns: DataFrame,
    conv_col: str = "conv_id",
    order_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    drop_trailing_empty: str = "assistant",
) -> DataFrame:
    """C17: one row per conversation with ``messages``: the turns in order as
    an array of {role, content}, in the total order (turn, role, text). If the
    last one is of role ``drop_trailing_empty`` and empty (the reply about to be
    generated) it is removed, with its exact repeats.

    Turns are gathered with ``collect_list`` of (turn, role, text) structs and
    sorted in the array, so the order never depends on shuffle order.
    """
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(role_col).alias("role"), F.col(text_col).alias("content"))))
    df = turns.groupBy(conv_col).agg(ordered.alias("_turns"))
    last = F.element_at("_turns", -1)
    empty = lambda t: F.coalesce(t["content"], F.lit("")) == ""
    drop = (last["role"] == drop_trailing_empty) & empty(last)
    same = lambda t: t["o"].eqNullSafe(last["o"]) & (t["role"] == last["role"]) & empty(t)
    kept = F.when(drop, F.filter("_turns", lambda t: ~same(t))).otherwise(F.col("_turns"))
    msgs = F.transform(kept, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return df.withColumn("messages", msgs).drop("_turns")


def transcript_messages(
    turns: DataFrame,
    conv_col: str = "conv_id",
    order_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    drop_trailing_empty: str = "assistant",
) -> DataFrame:
    """C17 in long form: one row per message (conv_id, turn, role, content),
    the trailing empty reply removed — without gathering a conversation.

    The last row of a conversation by (turn, role, text) is a maximum that
    combines map-side; of the text it carries only whether there is any, so no
    text is shuffled for it. What to drop is removed with an anti-join, which
    AQE splits if one conversation is hot. ``transcripts`` builds the
    per-conversation array a chat template needs from the same rule.
    """
    has_text = F.coalesce(F.col(text_col), F.lit("")) != ""
    last = turns.groupBy(conv_col).agg(
        F.max(F.struct(F.col(order_col).alias("t"), F.col(role_col).alias("r"), has_text.alias("x"))).alias("_m")
    )
    drop = last.filter((F.col("_m.r") == drop_trailing_empty) & ~F.col("_m.x")).select(
        F.col(conv_col).alias("_c"), F.col("_m.t").alias("_t")
    )
    gone = (F.col(conv_col) == F.col("_c")) & (F.col(order_col) == F.col("_t")) & (F.col(role_col) == drop_trailing_empty) & ~has_text
    kept = turns.join(drop, gone, "left_anti")
    return kept.select(conv_col, order_col, F.col(role_col).alias("role"), F.col(text_col).alias("content"))


def render_transcript(messages: Column, sep: str = "\n") -> Column:
    """The message list as one string, ``role: content`` per line."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])), sep)


def flag_overlength(df: DataFrame, col: str = "text", max_words: int = 2048) -> DataFrame:
    """``n_words`` and ``over_length`` (> ``max_words``). Words stand in
    for tokens; a tokenizer would only change the count, not the plan."""
    return df.withColumn("n_words", word_count(col)).withColumn("over_length", F.col("n_words") > max_words)


def keyword_filter(
    df: DataFrame,
    keywords: list[str],
    text_col: str = "text",
    ts_col: str | None = None,
    since: str | None = None,
    until: str | None = None,
    limit: int | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Rows whose text contains any keyword as a whole token
    (case-insensitive), optionally within ``since <= ts < until``, optionally
    capped at ``limit`` rows after a total order (the search's row cap)."""
    tokens = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)
    wanted = F.array(*[F.lit(k.lower()) for k in keywords])
    cond = F.arrays_overlap(tokens, wanted)
    if ts_col and since:
        cond = cond & (F.col(ts_col) >= F.lit(since).cast("timestamp_ntz"))
    if ts_col and until:
        cond = cond & (F.col(ts_col) < F.lit(until).cast("timestamp_ntz"))
    out = df.filter(cond)
    if limit is not None:
        if not order_by:
            raise ValueError("a row cap needs a total order")
        out = first_rows(out, order_by, limit)
    return out


def publish(df: DataFrame, path: str, split: str = "train", fmt: str = "json") -> None:
    """Write the prepared dataset as a named split (JSON lines by default),
    replacing what was there. The upload to a model hub is not built."""
    df.withColumn("split", F.lit(split)).write.mode("overwrite").partitionBy("split").format(fmt).save(path)


def load_split(spark, path: str, split: str = "train", fmt: str = "json", schema: str | None = None) -> DataFrame:
    """Load one named split; the split is a directory partition, so only
    its files are read."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema + ", split string")
    return reader.load(path).filter(F.col("split") == split).drop("split")
