"""One row per key: first in order, last written, or any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rank and keep rank 1. Spark limits each group to one row before the shuffle, so a key holding a large
    share of the rows sends at most one row per map task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(c) for c in order])


def upsert(target: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Insert on a primary key: updates replace target rows, and among equals the last in order wins."""
    both = target.withColumn("_from", F.lit(0)).unionByName(updates.withColumn("_from", F.lit(1)))
    latest = [F.desc("_from")] + [F.desc(c) for c in order]
    return _one_per_key(both, [key], latest).drop("_from")
