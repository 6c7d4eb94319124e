"""Counts, shares and value distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.functions import text as X


def group_count(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls ignored."""
    return group_count(df.filter(F.col(column).isNotNull()), column)


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Entities per category, nulls ignored."""
    items = df.filter(F.col(column).isNotNull()).select(
        F.explode(X.category_items(F.col(column))).alias("category")
    )
    return items.groupBy("category").agg(F.count("*").alias("n"))


def table_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))


def cleaning_counts(name: str, raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: rows before and after cleaning."""
    return raw.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows_before")).select(
        "*", clean.agg(F.count("*")).scalar().alias("rows_after")
    )


def with_share(counts: DataFrame, by: str = "n") -> DataFrame:
    """Add the percentage of the total, one decimal. The total is a scalar subquery, not a global window."""
    total = counts.agg(F.sum(by)).scalar()
    return counts.withColumn("share_pct", F.round(F.col(by) * 100.0 / total, 1))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """One row from one pass: positives, negatives, total, accuracy of always guessing the larger class."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positive_count"),
        F.count_if(F.col(label) == 0).alias("negative_count"),
        F.count("*").alias("total"),
    )
    larger = F.greatest("positive_count", "negative_count")
    baseline = larger / F.greatest(F.col("total"), F.lit(1))
    return counts.withColumn("baseline_accuracy", baseline)


def eda_summary(
    entities: DataFrame, reviews: DataFrame, sample_rows: int, cleaning_version: str, fast: bool = False
) -> DataFrame:
    """One row: cleaning version and table sizes; the full review count is null in fast mode.

    The sample is the first sample_rows of the reviews, so its size follows from theirs, which are counted once.
    """
    found = reviews.agg(F.count("*").alias("n")).select(
        F.when(F.lit(not fast), F.col("n")).alias("full"), F.least("n", F.lit(sample_rows)).cast("long").alias("small")
    )
    sizes = found.select(F.struct("full", "small").alias("s")).scalar()
    return entities.agg(
        F.lit(cleaning_version).alias("cleaning_version"), F.count("*").alias("n_businesses")
    ).select(
        "*",
        sizes["full"].alias("n_reviews_full"),
        F.lit(fast).alias("fast_mode"),
        sizes["small"].alias("n_reviews_small"),
    )
