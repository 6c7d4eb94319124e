"""Number formats and the verdicts drawn from metric values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def _to_decimals(c: Column, decimals: int) -> Column:
    """Round the exact binary value, ties to even, as C and Python formatting do.

    The JVM formatter rounds the shortest decimal form instead, so 40.595 (stored slightly below) would
    come out as 40.60. x * scale is split into its double p and the exact remainder err; the remainder
    decides where p alone looks like a tie. Scales up to 10^7 and products below 2^52 are exact.
    """
    scale = 10.0**decimals
    x = F.abs(c.cast("double"))
    p = x * scale
    high = x * 134217729.0 - (x * 134217729.0 - x)
    err = (high * scale - p) + (x - high) * scale
    whole = F.floor(p).cast("double")
    over = (p - whole - 0.5) + err
    up = (over > 0) | ((over == 0) & (whole % 2 == 1))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    return F.when(p >= float(1 << 52), c).when(c < 0, -rounded).otherwise(rounded)


def fmt_number(c: Column, decimals: int = 4) -> Column:
    return F.format_string(f"%.{decimals}f", _to_decimals(c, decimals))


def fmt_signed(c: Column, decimals: int = 4) -> Column:
    return F.format_string(f"%+.{decimals}f", _to_decimals(c, decimals))


def fmt_percent(c: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", _to_decimals(c * 100, decimals))


def rating_band(auc: Column) -> Column:
    return (
        F.when(auc >= 0.95, "excellent")
        .when(auc >= 0.90, "very good")
        .when(auc >= 0.80, "good")
        .when(auc >= 0.70, "fair")
        .otherwise("poor")
    )


def overfit_status_a(auc_diff: Column, acc_diff: Column) -> Column:
    """Report rule: either gap alone raises the status."""
    worst = F.greatest(F.abs(auc_diff), F.abs(acc_diff))
    return F.when(worst > 0.15, "warning").when(worst > 0.08, "monitor").otherwise("good")


def overfit_status_b(auc_diff: Column, acc_diff: Column) -> Column:
    """Dashboard rule: both gaps must be small, but one below 0.15 is enough for moderate."""
    worst = F.greatest(F.abs(auc_diff), F.abs(acc_diff))
    best = F.least(F.abs(auc_diff), F.abs(acc_diff))
    return (
        F.when(worst < 0.05, "minimal")
        .when(worst < 0.10, "good")
        .when(best < 0.15, "moderate")
        .otherwise("high")
    )


def gap_flag(gap: Column, limit: float = 0.1) -> Column:
    return F.when(F.abs(gap) < limit, "ok").otherwise("warning")
