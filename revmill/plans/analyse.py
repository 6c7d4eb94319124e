"""Analysis and exploration jobs over clean tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.config import ReviewConfig
from revmill.functions import text as X
from revmill.functions import values as V
from revmill.operators import counts, histograms, limits, models, rows
from revmill.operators import evaluation as EV
from revmill.operators.dedupe import keep_first
from revmill.schemas import BUSINESS_STORE_NO_GEO, REVIEW_STORE
from revmill.session import cut_lineage
from revmill.sources import sinks


def clean_tables(
    entities: DataFrame, reviews: DataFrame, entity_order: list[str], review_order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows without nulls, first per key. A null in any column removes the row, nested columns included."""
    return (
        keep_first(rows.drop_any_null(entities), ["business_id"], entity_order),
        keep_first(rows.drop_any_null(reviews), ["review_id"], review_order),
    )


def analyse(
    entities: DataFrame,
    reviews: DataFrame,
    entity_order: list[str],
    review_order: list[str],
    cfg: ReviewConfig = ReviewConfig(),
    min_reviews: int = 50,
) -> dict[str, DataFrame]:
    """Cleaning counts, busiest businesses, top-rated businesses, tier distribution, tier tree accuracy."""
    clean, clean_reviews = clean_tables(entities, reviews, entity_order, review_order)
    # Several tables are drawn from each; the cleaning runs once and only the columns needed are kept.
    clean, clean_reviews = cut_lineage(clean), cut_lineage(clean_reviews.select("business_id"))
    # The columns the tier tree learns from.
    features = ["review_count", "is_open", "latitude", "longitude"]
    tiers = clean.select(V.tier_label(F.col("stars"), cfg.high_star, cfg.mid_star).alias("label"))
    out = {
        "cleaning_counts": counts.cleaning_counts("businesses", entities, clean).unionByName(
            counts.cleaning_counts("reviews", reviews, clean_reviews)
        ),
        "top_businesses": limits.top_k(counts.group_count(clean_reviews, "business_id"), 5),
        "top_rated": rows.select_existing(
            rows.filter_entities(clean, 4.0, min_reviews),
            ["business_id", "name", "stars", "review_count", "city"],
        ),
        "tier_distribution": counts.group_count(tiers, "label").orderBy("label"),
    }
    predicted = models.tier_tree(clean, "business_id", features, cfg=cfg)
    if predicted is not None:
        out["tier_predictions"] = predicted
        out["tier_accuracy"] = predicted.agg(
            F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")
        )
    return out


def load_store(
    entities: DataFrame,
    reviews: DataFrame,
    entity_table: str,
    review_table: str,
    fmt: str = "parquet",
    options: dict[str, dict[str, str]] | None = None,
) -> None:
    """Append both tables to the store, each cut to the columns it has there: entities without their place on the map."""
    opts = options or {}
    kept = {t: s.fieldNames() for t, s in ((entity_table, BUSINESS_STORE_NO_GEO), (review_table, REVIEW_STORE))}
    entities = rows.select_existing(entities, kept[entity_table])
    reviews = rows.select_existing(reviews, kept[review_table])
    sinks.append_table(entities, entity_table, fmt, opts.get(entity_table))
    sinks.append_table(reviews, review_table, fmt, opts.get(review_table))


def _keys(table: str, column: str) -> Column:
    return F.array(F.struct(F.lit(table).alias("table_name"), F.col(column).cast("string").alias("key")))


def eda_long(entities: DataFrame, reviews: DataFrame) -> DataFrame:
    """(table_name, key, n): how often each city, category, star value, review count, reviewer and text length occurs.

    Each input is read once: a row is expanded to its keys, and one aggregation, combined within the tasks, counts
    the keys of all tables. Null values are not counted.
    """
    items = F.transform(
        X.category_items(F.col("categories")), lambda c: F.struct(F.lit("category").alias("table_name"), c.alias("key"))
    )
    of_entity = [_keys(c, c) for c in ("city", "stars", "review_count")]
    none = F.array().cast("array<struct<table_name: string, key: string>>")
    pairs = entities.select(F.concat(*of_entity, F.coalesce(items, none)).alias("pairs"))
    lengths = reviews.select("user_id", F.length("text").alias("chars"))
    more = lengths.select(F.concat(_keys("user_id", "user_id"), _keys("chars", "chars")).alias("pairs"))
    found = pairs.unionAll(more).select(F.inline("pairs")).filter("key IS NOT NULL")
    return found.groupBy("table_name", "key").agg(F.count("*").alias("n"))


def eda(entities: DataFrame, reviews: DataFrame) -> dict[str, DataFrame]:
    """Every exploration table: top lists, distributions, shares, histograms, density, all from the staged eda_long."""
    long = cut_lineage(eda_long(entities, reviews))

    def table(name: str, kind: T.DataType) -> DataFrame:
        return long.filter(F.col("table_name") == name).select(F.col("key").cast(kind).alias(name), "n")

    categories = table("category", T.StringType())
    stars, sizes = (table(c, entities.schema[c].dataType) for c in ("stars", "review_count"))
    return {
        "top_cities": limits.top_k(table("city", entities.schema["city"].dataType), 10),
        "top_categories": limits.top_k(categories, 10),
        "category_share": counts.with_share(limits.top_k(categories, 5)),
        "star_distribution": stars.orderBy("stars"),
        "star_share": counts.with_share(stars),
        "star_histogram": histograms.histogram(stars, "stars", 9, weight="n"),
        "star_density": histograms.kde(stars, "stars", weight="n"),
        "review_count_histogram": histograms.histogram(sizes, "review_count", 50, upper=500, weight="n"),
        "length_histogram": histograms.histogram(table("chars", T.IntegerType()), "chars", 50, weight="n"),
        "top_reviewers": limits.top_k(table("user_id", reviews.schema["user_id"].dataType), 5),
    }


def report_tables(document: DataFrame) -> dict[str, DataFrame]:
    """The tables of the report, all from the metric document (one row)."""
    matrix = document.select(*(F.col(f"confusion_{c}").cast("long").alias(c) for c in ("tn", "fp", "fn", "tp")))
    balance = ["positive_count", "negative_count", "raw_dataset_size", "baseline_accuracy"]
    scores = document.select("model_type", F.explode(models.auc_entries(document)).alias("e"))
    return {
        "metrics_long": EV.metrics_long(document),
        "metric_breakdown": EV.metric_breakdown(document),
        "verdicts": EV.verdicts(document),
        "model_comparison": scores.select(
            F.col("e.name").alias("model"), F.col("e.score").alias("validation_auc"),
            (F.col("e.name") == F.col("model_type")).alias("is_best"),
        ),
        "tuned_parameters": document.select(F.explode(models.tuned_entries(document)).alias("e")).select(
            F.col("e.name").alias("parameter"), F.col("e.value").alias("value")
        ).filter(F.col("value").isNotNull()),
        "confusion": matrix,
        "confusion_rates": EV.confusion_stats(matrix),
        "class_balance": document.select(*(c for c in balance if c in document.columns)),
    }


def write_tables(tables: dict[str, DataFrame], out: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
