"""Review cleaning and the reasons for which rows are rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.functions import text as X
from revmill.functions import values as V
from revmill.operators.dedupe import keep_first
from revmill.operators.joins import spread_join
from revmill.operators.rows import compute_once

DUPLICATE_ID = "dropped_duplicate_id"
INVALID = "dropped_invalid"


def clean_text(
    df: DataFrame, src: str, dst: str, cfg: ReviewConfig = ReviewConfig()
) -> DataFrame:
    """Add the cleaned text, null where the row is to be rejected. The scan over the text runs once per row."""
    pinned = compute_once(df, "_normal", X.normalise_text(F.col(src)))
    bounded = X.bound_text(F.col("_normal"), cfg.min_chars, cfg.max_chars)
    return pinned.withColumn(dst, bounded).drop("_normal")


def dedupe_reviews(
    df: DataFrame,
    entity: str,
    src: str,
    order: list[str],
    cfg: ReviewConfig = ReviewConfig(),
) -> DataFrame:
    """Clean the text, drop rejects and keep the first row per entity and cleaned text.

    The digest stands in for the text in the shuffle and sort key, and spreads a busy entity over all tasks.
    """
    return kept_reviews(review_states(df, entity, src, cfg=cfg), entity, order)


def valid_entity(key: str, stars: str, categories: str, cfg: ReviewConfig = ReviewConfig()) -> Column:
    """Key present, stars on the scale, at least one category."""
    return (
        V.has_key(F.col(key))
        & V.valid_range(F.col(stars), cfg.star_min, cfg.star_max)
        & X.has_category(F.col(categories))
    )


def prepare_entities(
    df: DataFrame,
    key: str,
    order: list[str],
    stars: str = "stars",
    categories: str = "categories",
    cfg: ReviewConfig = ReviewConfig(),
) -> DataFrame:
    """Valid entities with normalised categories, first valid row per key."""
    ok = df.filter(valid_entity(key, stars, categories, cfg))
    return keep_first(ok, [key], order).withColumn(
        categories, X.normalise_categories(F.col(categories))
    )


def entity_reasons(
    df: DataFrame,
    key: str,
    order: list[str],
    stars: str = "stars",
    categories: str = "categories",
    cfg: ReviewConfig = ReviewConfig(),
) -> DataFrame:
    """Narrow table (order columns, key, reason); reason is null for rows that are kept.

    A row after the first valid row of its key is a duplicate even if it is itself invalid; before it, or in
    a key with no valid row, it is invalid. Only the key and the order columns are shuffled, and the first
    position per key is pre-aggregated per task.
    """
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    rows = df.select(
        *order, F.col(key), valid_entity(key, stars, categories, cfg).alias("_ok")
    )
    first = rows.groupBy(key).agg(
        F.min(F.when(F.col("_ok"), at)).alias("_first"), F.count("*").alias("_n")
    )
    reason = F.when(at == F.col("_first"), None).when(at > F.col("_first"), DUPLICATE_ID)
    return spread_join(rows, first, key, "_n", order, "left").select(
        *order, key, reason.otherwise(INVALID).alias("reason")
    )


def entity_counters(reasons: DataFrame) -> DataFrame:
    """One row: records written and dropped by reason."""
    return reasons.agg(
        F.count_if(F.col("reason").isNull()).alias("records_written"),
        F.count_if(F.col("reason") == DUPLICATE_ID).alias(DUPLICATE_ID),
        F.count_if(F.col("reason") == INVALID).alias(INVALID),
    )


def review_states(
    df: DataFrame,
    entity: str,
    src: str,
    malformed: Column | None = None,
    cfg: ReviewConfig = ReviewConfig(),
) -> DataFrame:
    """Replace the text by its cleaned form and add state (clean, malformed, empty_short) and digest."""
    bad_line = F.lit(False) if malformed is None else malformed
    rows = clean_text(df.withColumn("_bad", bad_line), src, src, cfg)
    good = V.has_key(F.col(entity)) & F.col(src).isNotNull()
    state = F.when(F.col("_bad"), "malformed").when(good, "clean").otherwise("empty_short")
    return rows.withColumns({"state": state, "digest": F.sha2(src, 256)}).drop("_bad")


def kept_reviews(states: DataFrame, entity: str, order: list[str]) -> DataFrame:
    """The first clean row per entity and text."""
    return keep_first(states.filter("state = 'clean'"), [entity, "digest"], order).drop(
        "state", "digest"
    )


def review_counters(states: DataFrame, entity: str) -> DataFrame:
    """One row: reviews written, malformed, empty or short, duplicate.

    Rejected rows collapse to one group each and copies to one group per text, both within the map tasks.
    """
    clean = F.col("state") == "clean"
    groups = states.groupBy(
        "state", F.when(clean, F.col(entity)).alias("e"), F.when(clean, F.col("digest")).alias("d")
    ).agg(F.count("*").alias("n"))

    def total(name: str, amount: Column):
        return F.coalesce(F.sum(F.when(F.col("state") == name, amount)), F.lit(0)).cast("long")

    return groups.agg(
        total("clean", F.lit(1)).alias("records_written"),
        total("malformed", F.col("n")).alias("dropped_malformed_json"),
        total("empty_short", F.col("n")).alias("dropped_empty_short"),
        total("clean", F.col("n") - 1).alias("dropped_duplicate"),
    )


def observe_states(states: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and the counts of their states, which whatever writes the rows gathers in passing."""
    seen, state = Observation(), F.col("state")
    return states.observe(
        seen, F.count_if(state == "clean").alias("clean"), F.count_if(state == "malformed").alias("malformed"),
        F.count_if(state == "empty_short").alias("short"),
    ), seen


def observe_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def observed_counters(states: Observation, written: Observation) -> dict[str, int]:
    """The counters of review_counters from what was observed while states and kept reviews were written."""
    found, kept = states.get, written.get["n"]
    return {
        "records_written": kept, "dropped_malformed_json": found["malformed"], "dropped_empty_short": found["short"],
        "dropped_duplicate": found["clean"] - kept,
    }
