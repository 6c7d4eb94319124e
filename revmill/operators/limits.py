"""Row limits: first n, top k, random k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.config import ReviewConfig
from revmill.functions import values as V
from revmill.operators.cleaning import dedupe_reviews


# Rank error of the quantile that narrows the search for the nth position, as a share of all rows.
RANK_ERROR = 100_000


def head_sample(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in an order that is unique per row and never null.

    The rows are filtered where they lie, by the position of the nth. To find it, tasks first count: rows below a
    quantile of a numeric first column (its rank error is known and added), or rows of each block of several columns.
    Only order columns from around the nth position then meet in one task, not n rows of every task.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    keys = df.select(*order)
    if isinstance(df.schema[order[0]].dataType, T.NumericType):
        total = keys.agg(F.count("*")).scalar()
        share = F.least(F.lit(1.0), (F.lit(n) + 2.0 * total / RANK_ERROR + 1) / F.greatest(total, F.lit(1)))
        cut = _quantile(keys, order[0], share)
        near = keys.filter(F.col(order[0]) <= cut)
        last = near.select(at.alias("at")).orderBy("at").limit(n).agg(F.max("at")).scalar()
        return df.filter(at <= last)
    if len(order) == 1:
        last = keys.select(at.alias("at")).orderBy("at").limit(n).agg(F.max("at")).scalar()
        return df.filter(at <= last)
    # Blocks in order, with the rows before each: one row for each block.
    block = F.struct(*order[:-1])
    upto = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = keys.groupBy(block.alias("block")).agg(F.count("*").alias("n")).select(
        "block", "n", F.sum("n").over(upto).alias("upto")
    )
    border = blocks.filter(F.col("upto") >= n).agg(F.min("block")).scalar()
    before = blocks.filter(F.col("upto") < n).agg(F.coalesce(F.max("upto"), F.lit(0))).scalar()
    inside = Window.orderBy(order[-1])
    ranked = keys.filter(block == border).select(order[-1], F.row_number().over(inside).alias("rank"))
    last = ranked.filter(F.col("rank") <= F.lit(n) - before).agg(F.max(order[-1])).scalar()
    return df.filter(border.isNull() | (block < border) | ((block == border) & (F.col(order[-1]) <= last)))


def _quantile(keys: DataFrame, column: str, share: Column) -> Column:
    """A value at or above that of the nth row, if there are n rows; else the largest."""
    # The share must be constant for the quantile, so a ladder of shares is asked for and the right step taken.
    steps = [1.0 / 2**i for i in range(34, -1, -1)]
    found = keys.agg(F.percentile_approx(column, F.array(*map(F.lit, steps)), RANK_ERROR)).scalar()
    at = F.least(F.greatest(F.ceil(F.log2(share) + 34 + 1e-9), F.lit(0)), F.lit(34))
    return F.get(found, at.cast("int"))


def top_k(counts: DataFrame, k: int, by: str = "n", key: str | None = None) -> DataFrame:
    """The k largest counts, ties by key."""
    return counts.orderBy(F.desc(by), key or counts.columns[0]).limit(k)


def random_k(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in an order drawn from key and seed, the same on any partitioning."""
    drawn = {"_draw": V.key_fraction(F.col(key), seed), "_rank": V.key_rank(F.col(key), seed)}
    return head_sample(df.withColumns(drawn), n, ["_draw", "_rank", key]).drop("_draw", "_rank")


def fast_sample(
    df: DataFrame,
    entity: str,
    src: str,
    order: list[str],
    max_rows: int,
    raw_cap: int,
    cfg: ReviewConfig = ReviewConfig(),
) -> DataFrame:
    """At most max_rows clean, unique reviews from the first raw_cap rows."""
    scanned = head_sample(df, raw_cap, order)
    return head_sample(dedupe_reviews(scanned, entity, src, order, cfg), max_rows, order)


def column_scan(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    one = df.select(column)
    return one if limit is None else one.limit(limit)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
