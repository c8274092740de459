"""Scalar Column helpers (F1–F23). Each returns a native Spark Column, so the
expressions stay inside whole-stage codegen — no Python UDF anywhere."""

from custlens.functions.dates import (
    add_days_checked,
    elapsed_days,
    fill_missing_shipment,
    format_ymd,
    hour_label,
    month_index,
    month_start,
    months_before,
    operational_day,
    parse_timestamp_any,
    safe_timestamp,
    ts_literal,
)
from custlens.functions.numeric import clamp_zero, safe_int
from custlens.functions.text import (
    canonical_name,
    clean_region,
    clean_tweet,
    normalise_person_name,
    prompt_text,
    strip_suffix_token,
    word_count,
)

__all__ = [
    "add_days_checked",
    "canonical_name",
    "clamp_zero",
    "clean_region",
    "clean_tweet",
    "elapsed_days",
    "fill_missing_shipment",
    "format_ymd",
    "hour_label",
    "month_index",
    "month_start",
    "months_before",
    "normalise_person_name",
    "operational_day",
    "parse_timestamp_any",
    "prompt_text",
    "safe_int",
    "safe_timestamp",
    "strip_suffix_token",
    "ts_literal",
    "word_count",
]
