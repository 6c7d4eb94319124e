"""Preparation job: raw JSON lines to clean tables with quality documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.config import ReviewConfig
from revmill.functions import values as V
from revmill.operators import cleaning
from revmill.operators.limits import head_sample
from revmill.schemas import BUSINESS, BUSINESS_RAW, CORRUPT, REVIEW_RAW, REVIEW_STORE
from revmill.session import staged
from revmill.sources import files, sinks


@dataclass(frozen=True)
class Prepared:
    """Where the job wrote its tables and documents; a table that was not written is None."""

    entities: str | None
    reviews: str | None
    sample: str | None
    quality: str
    summary: str


def typed_entities(df: DataFrame) -> DataFrame:
    """Each column in its own type; a value that does not fit becomes null."""

    def typed(field: T.StructField):
        if isinstance(field.dataType, T.MapType):
            return F.from_json(field.name, field.dataType)
        return F.col(field.name).try_cast(field.dataType)

    return df.select(*[typed(f).alias(f.name) for f in BUSINESS.fields])


def typed_reviews(df: DataFrame) -> DataFrame:
    """Numbers cast where they are readable; the raw text of useful stays beside its integer."""
    raw = df.withColumn("useful_raw", F.when(V.soft_int(F.col("useful")).isNull(), F.col("useful")))
    types = {f.name: f.dataType for f in REVIEW_STORE.fields if f.dataType.typeName() != "string"}
    return raw.withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})


def prepare_entities(spark: SparkSession, src: str, dst: str, cfg: ReviewConfig) -> DataFrame:
    """Write the clean entities; return the counters (one row). The lines are parsed once and staged."""
    lines = files.read_jsonl_lines(spark, src, BUSINESS_RAW).drop(files.NULL_NUMBER)
    keyless = F.when(F.col(CORRUPT).isNull(), F.col("business_id"))
    with staged(lines.withColumn("business_id", keyless).drop(CORRUPT)) as rows:
        kept = cleaning.prepare_entities(rows, "business_id", files.LINE_ORDER, cfg=cfg)
        sinks.write_jsonl(typed_entities(kept.drop(*files.LINE_ORDER)), dst)
        reasons = cleaning.entity_reasons(rows, "business_id", files.LINE_ORDER, cfg=cfg)
        counters = cleaning.entity_counters(reasons).first()
    return spark.createDataFrame([counters])


def _states(lines: DataFrame, cfg: ReviewConfig) -> DataFrame:
    broken = F.col(CORRUPT).isNotNull()
    return cleaning.review_states(lines, "business_id", "text", broken, cfg).drop(CORRUPT, files.NULL_NUMBER)


def prepare_reviews(spark: SparkSession, src: str, dst: str, small: str, cfg: ReviewConfig) -> DataFrame:
    """Write all clean reviews, and the first of them in input order as the small sample; return the counters (one row).

    The cleaned rows are staged once, so that the tables do not each clean the text. The counters are observed while the staged
    rows and the clean reviews are written; no table is read again for them.
    """
    states, seen = cleaning.observe_states(_states(files.read_jsonl_lines(spark, src, REVIEW_RAW), cfg))
    with staged(states) as states:
        kept = cleaning.kept_reviews(states, "business_id", files.LINE_ORDER)
        reviews, written = cleaning.observe_rows(typed_reviews(kept.drop(*files.LINE_ORDER)))
        sinks.write_jsonl(reviews, dst)
        sample = head_sample(kept, cfg.sample_rows, files.LINE_ORDER)
        sinks.write_jsonl(typed_reviews(sample.drop(*files.LINE_ORDER)), small)
    counters = cleaning.observed_counters(seen, written)
    schema = ", ".join(f"{name} long" for name in counters)
    return spark.createDataFrame([tuple(counters.values())], schema)


def prepare_fast(spark: SparkSession, src: str, dst: str, cfg: ReviewConfig) -> DataFrame:
    """Write a clean sample from the first raw rows and stop there; return the counters (one row).

    Counters cover the lines up to the one that filled the sample.
    """
    lines = files.head_lines(spark, src, REVIEW_RAW, cfg.raw_cap)
    with staged(_states(lines, cfg)) as states:
        kept = cleaning.kept_reviews(states, "business_id", files.LINE_ORDER)
        sample = head_sample(kept, cfg.sample_rows, files.LINE_ORDER)
        at = F.struct(*files.LINE_ORDER)
        stop = sample.agg(F.when(F.count("*") == cfg.sample_rows, F.max(at))).scalar()
        scanned = states.filter(stop.isNull() | (at <= stop))
        sinks.write_jsonl(typed_reviews(sample.drop(*files.LINE_ORDER)), dst)
        counters = (
            cleaning.review_counters(scanned, "business_id")
            .withColumn("raw_lines_scanned", scanned.agg(F.count("*")).scalar())
            .first()
        )
    return spark.createDataFrame([counters])


def prepare(
    spark: SparkSession,
    business: str,
    review: str,
    out: str,
    cfg: ReviewConfig = ReviewConfig(),
    fast: bool = False,
) -> Prepared:
    """Clean both tables, build the small sample anew, write the quality and summary documents."""
    paths = Prepared(
        f"{out}/business" if files.path_exists(spark, business) else None,
        f"{out}/review" if files.path_exists(spark, review) and not fast else None,
        f"{out}/review_small" if files.path_exists(spark, review) else None,
        f"{out}/data_quality",
        f"{out}/eda_summary",
    )
    entity_counts = prepare_entities(spark, business, paths.entities, cfg) if paths.entities else None
    review_counts, sample_rows = None, 0
    if paths.sample and fast:
        review_counts = prepare_fast(spark, review, paths.sample, cfg)
    elif paths.sample:
        review_counts = prepare_reviews(spark, review, paths.reviews, paths.sample, cfg)
    if paths.sample:
        sample_rows = files.read_jsonl(spark, paths.sample, REVIEW_STORE).count()
    write_documents(spark, paths, entity_counts, review_counts, sample_rows, fast, cfg)
    return paths


def _as_struct(counters: DataFrame | None, name: str):
    """The counter row as literals of one struct, or an error entry when the table was missing."""
    if counters is None:
        return F.struct(F.lit(f"missing_{name}").alias("error"))
    return F.struct(*[F.lit(v).alias(k) for k, v in counters.first().asDict().items()])


def write_documents(
    spark: SparkSession,
    paths: Prepared,
    entity_counts: DataFrame | None,
    review_counts: DataFrame | None,
    sample_rows: int,
    fast: bool,
    cfg: ReviewConfig,
) -> None:
    """The quality document (limits, counters, files) and the summary document, one row each."""
    entity, review = _as_struct(entity_counts, "business"), _as_struct(review_counts, "review")
    one = spark.range(1)
    quality = one.select(
        F.lit(cfg.cleaning_version).alias("cleaning_version"),
        F.lit(cfg.min_chars).alias("min_review_chars"),
        F.lit(cfg.max_chars).cast("int").alias("max_review_chars"),
        F.lit(cfg.sample_rows).alias("review_sample_cap"),
        F.lit(cfg.sample_rows).alias("fast_sample_max_lines"),
        F.lit(cfg.raw_cap).alias("fast_sample_raw_cap"),
        entity.alias("business"),
        review.alias("review_full"),
        F.struct(F.lit(sample_rows).alias("lines")).alias("review_small"),
        F.struct(
            F.lit(paths.entities).alias("business"),
            F.lit(paths.reviews).alias("review"),
            F.lit(paths.sample).alias("review_small"),
        ).alias("files"),
    )
    none = F.lit(None).cast("long")
    summary = one.select(
        F.lit(cfg.cleaning_version).alias("cleaning_version"),
        (none if entity_counts is None else entity["records_written"]).alias("n_businesses"),
        (none if fast or review_counts is None else review["records_written"]).alias("n_reviews_full"),
        F.lit(fast).alias("fast_mode"),
        F.lit(sample_rows).alias("n_reviews_small"),
    )
    sinks.save_metrics(quality, paths.quality)
    sinks.save_metrics(summary, paths.summary)
