"""Projections, filters and coercions over whole rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.functions import values as V

_FLOATS = (T.DoubleType, T.FloatType)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def drop_any_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns; every column when none is named.

    Written as a conjunction of null tests, which the file scan takes over.
    """
    names = cols or df.columns
    tests = [F.col(n).isNotNull() for n in names]
    tests += [~F.isnan(n) for n in names if isinstance(df.schema[n].dataType, _FLOATS)]
    return df.filter(reduce(and_, tests))


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(V.has_key(F.col(key)))


def filter_entities(df: DataFrame, min_stars: float = 4.0, min_reviews: int = 50) -> DataFrame:
    """Strictly above both bounds."""
    return df.filter((F.col("stars") > min_stars) & (F.col("review_count") > min_reviews))


def coerce_defaults(df: DataFrame, spec: dict[str, tuple[str, object]]) -> DataFrame:
    """Cast each column to its type and replace null or unreadable values by its default."""
    return df.withColumns({n: V.or_default(F.col(n), t, d) for n, (t, d) in spec.items()})


def unreadable(spec: dict[str, tuple[str, object]]) -> Column:
    """True where some column holds a value its type cannot read."""
    tests = [F.col(n).isNotNull() & F.col(n).try_cast(t).isNull() for n, (t, _) in spec.items()]
    return reduce(or_, tests)


def coerce_or_reject(
    df: DataFrame, spec: dict[str, tuple[str, object]]
) -> tuple[DataFrame, DataFrame]:
    """(rows coerced with defaults for nulls, rows with an unreadable value as they came)."""
    bad = unreadable(spec)
    return coerce_defaults(df.filter(~bad), spec), df.filter(bad)


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters must not recompute.

    Catalyst moves a filter on a projected column below the projection by repeating its expression. It does
    not move filters on the output of a generator, so the value travels through a one-element array.
    """
    return df.select(
        *[c for c in df.columns if c != name], F.explode_outer(F.array(value)).alias(name)
    )
