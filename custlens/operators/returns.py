"""Return handling: high-return pair exclusion (C1) and the tracking-list
anti-join (J5 / C11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.session import staged


KEYS = ("customer_id", "product_name")
# Beyond so many pairs they are looked up in a filter of fixed size first.
FILTER_ABOVE = 200_000
# 64-bit words of that filter at most: 4 MB of (number, word) pairs go to each executor.
MOST_WORDS = 1 << 18


def high_return_pairs(
    rows: DataFrame,
    keys: tuple[str, ...] = KEYS,
    n: Column | None = None,
    returned: Column | None = None,
    status_col: str = "sale_status",
    return_status: int = 3,
    min_rows: int = 3,
    max_return_pct: int = 50,
) -> DataFrame:
    """The (customer, product) pairs C1 drops: more than ``min_rows`` sales and
    a return share of at least ``max_return_pct`` percent.

    ``rows`` are sales, or counts of sales with ``n`` and ``returned`` (numbers of sales and
    of returned ones per row). ``returns * 100 >= pct * rows`` is the share test in integer
    arithmetic (exactly 50 % is dropped, as in the reference). The aggregate combines
    map-side, so a hot pair costs one partial row per task.
    """
    n = F.lit(1) if n is None else n
    returned = F.when(F.col(status_col) == return_status, 1).otherwise(0) if returned is None else returned
    per_pair = rows.groupBy(*keys).agg(F.sum(n).alias("_rows"), F.sum(returned).alias("_returns"))
    known = [F.col(k).isNotNull() for k in keys]
    share = F.col("_returns") * 100 >= F.lit(max_return_pct) * F.col("_rows")
    return per_pair.filter(reduce(lambda x, y: x & y, known) & (F.col("_rows") > min_rows) & share).select(*keys)


def _word_and_mask(keys: tuple[str, ...], words: int) -> tuple[Column, Column]:
    """The filter's word for a key, and its three bits in it."""
    h = F.xxhash64(*keys, F.lit(17))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(3)]
    return F.pmod(F.xxhash64(*keys), F.lit(words)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def pair_filter(pairs: DataFrame, keys: tuple[str, ...], words: int) -> DataFrame:
    """(word, bits): a Bloom filter of the pairs with three bits of one word per pair."""
    word, mask = _word_and_mask(keys, words)
    return pairs.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))


def without_pairs(rows: DataFrame, pairs: DataFrame, keys: tuple[str, ...] = KEYS, filter_above: int = FILTER_ABOVE) -> DataFrame:
    """``rows`` whose keys are none of ``pairs``; rows with a NULL key stay (Q6).

    The pairs are staged: the planner sends a small table to the rows, which don't move
    then. More than ``filter_above`` pairs go into a Bloom filter of bounded size first.
    Rows that it rules out stay where they are; only the others, those of dropped pairs
    and a few more, are shuffled to the exact anti-join, which can split a hot pair.
    ``rows`` are read twice then, so pass a stored table.
    """
    pairs = staged(pairs, "dropped-pairs")
    n = pairs.count()
    if n <= filter_above:
        return rows.join(pairs, on=list(keys), how="left_anti")
    words = min(MOST_WORDS, 1 << max(6, (n // 4).bit_length()))
    bits = F.broadcast(staged(pair_filter(pairs, keys, words), "pair-filter"))
    word, mask = _word_and_mask(keys, words)
    marked = rows.withColumn("_word", word).withColumn("_mask", mask).join(bits, F.col("_word") == F.col("word"), "left")
    suspect = F.coalesce(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    sure = marked.where(~suspect).select(*rows.columns)
    rest = marked.where(suspect).select(*rows.columns).join(pairs, on=list(keys), how="left_anti")
    return sure.unionByName(rest.select(*rows.columns))


def exclude_high_return(
    sales: DataFrame,
    keys: tuple[str, ...] = KEYS,
    status_col: str = "sale_status",
    return_status: int = 3,
    min_rows: int = 3,
    max_return_pct: int = 50,
    filter_above: int = FILTER_ABOVE,
) -> DataFrame:
    """Drop every row of a high-return pair, then drop the status column.

    A left-anti join against the bad pairs replaces the reference's three merges. Rows whose
    customer or product is NULL always survive: NULL never equals a key (Q6).
    """
    bad = high_return_pairs(
        sales, keys, status_col=status_col, return_status=return_status, min_rows=min_rows, max_return_pct=max_return_pct
    )
    return without_pairs(sales, bad, keys, filter_above).drop(status_col)


def exclude_returned_tracking(
    sales: DataFrame, returns: DataFrame, sales_col: str = "tracking_number", returns_col: str = "AWB"
) -> DataFrame:
    """Drop sales whose tracking number appears in the return list,
    compared as text. NULL tracking numbers are kept (``isin`` semantics); a
    NULL in the return list removes nothing (unlike ``NOT IN``)."""
    codes = returns.select(F.col(returns_col).cast("string").alias("_code")).filter(F.col("_code").isNotNull())
    return sales.join(codes, F.col(sales_col).cast("string") == F.col("_code"), "left_anti")
