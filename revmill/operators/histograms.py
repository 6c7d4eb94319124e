"""Equal-width histograms and kernel density, computed from per-value or per-bin sums."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(
    df: DataFrame, column: str, bins: int, upper: float | None = None, weight: str | None = None
) -> DataFrame:
    """(bin, bin_start, bin_end, n) with every bin present and the last one closed.

    One pass finds the range and one counts; only the per-bin sums leave the tasks. A weight column says how many rows
    each row stands for.
    """
    x = F.col(column).cast("double")
    kept = df.filter(x.isNotNull() & ~F.isnan(x))
    if upper is not None:
        kept = kept.filter(x <= upper)
    lo = kept.agg(F.min(x)).scalar()
    width = (kept.agg(F.max(x)).scalar() - lo) / bins
    place = F.when(width > 0, F.least(F.floor((x - lo) / width), F.lit(bins - 1))).otherwise(0)
    amount = F.count("*") if weight is None else F.sum(weight)
    counts = kept.groupBy(place.cast("int").alias("bin")).agg(amount.alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def kde(df: DataFrame, column: str, grid: int = 200, weight: str | None = None) -> DataFrame:
    """Gaussian kernel density at evenly spaced points from minimum to maximum.

    Rows are counted per value first; each value then adds its weight to the grid points, summed per task.
    The bandwidth is the sample deviation times n to the power -1/5. A weight column says how many rows each row
    stands for.
    """
    x = F.col(column).cast("double")
    kept = df.filter(x.isNotNull() & ~F.isnan(x))
    amount = F.count("*") if weight is None else F.sum(weight)
    per_value = kept.groupBy(x.alias("v")).agg(amount.alias("n"))
    if weight is None:
        deviation = F.stddev_samp(x)
    else:
        w = F.col(weight)
        # The sum of squares about the mean of all rows, from the values' own sums.
        mean = kept.agg(F.sum(x * w) / F.sum(w)).scalar()
        deviation = F.sqrt(F.sum(w * (x - mean) * (x - mean)) / F.nullif(F.sum(w) - 1, F.lit(0)))
    stats = kept.agg(
        F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), amount.alias("n"), deviation.alias("sd"))
    ).scalar()
    total = stats["n"]
    width = stats["sd"] * F.pow(total.cast("double"), F.lit(-0.2))
    points = per_value.select(
        "v", "n", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point")
    )
    at = stats["lo"] + F.col("point") * ((stats["hi"] - stats["lo"]) / (grid - 1))
    u = (at - F.col("v")) / width
    sums = points.groupBy("point").agg(F.sum(F.col("n") * F.exp(-0.5 * u * u)).alias("s"))
    return sums.select(
        "point",
        at.alias("x"),
        (F.col("s") / (total * width * math.sqrt(2 * math.pi))).alias("density"),
    )
