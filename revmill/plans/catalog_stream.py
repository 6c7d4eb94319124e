"""Queries over arriving review files: the stream's clean reviews and counters against those of the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from revmill.plans.catalog_rows import SQL_UNIQUE
from revmill.plans.registry import query
from revmill.plans.views import Views
from revmill.session import new_folder
from revmill.streaming import reviews as S

WAVES = 3


def streamed(v: Views) -> tuple[str, str]:
    """Write all reviews as JSON files in waves of rising ids, and run the stream anew after each.

    Every run goes on from the checkpoint of the one before. Returns the folders of the clean reviews and of the counters.
    """
    base = new_folder(v.spark, "arriving")
    source, out, counters, checkpoint = (f"{base}/{n}" for n in ("in", "clean", "counters", "checkpoint"))
    rows = v.reviews().select(F.col("review_id").cast("string"), F.col("entity_id").cast("string").alias("business_id"), "text")
    id_ = F.col("review_id").cast("long")
    span = rows.agg(F.min(id_).alias("low"), F.max(id_).alias("high")).first()
    if span["low"] is None:
        rows.write.mode("append").json(source)
    low, width = span["low"] or 0, ((span["high"] or 0) - (span["low"] or 0)) // WAVES + 1
    for wave in range(WAVES):
        rows.filter(F.floor((id_ - low) / width) == wave).write.mode("append").json(source)
        # Ids as numbers: copies within a wave go to the smallest of them.
        arriving = S.read_stream(v.spark, source).withColumn("id", id_)
        S.stream_reviews(arriving, out, counters, checkpoint, ["id"]).awaitTermination()
    return out, counters


@query("q_stream_clean", f"WITH {SQL_UNIQUE} SELECT * FROM unique_reviews", "reviews")
def stream_clean(v):
    out, _ = streamed(v)
    found = v.spark.read.schema("id long, business_id string, text string").parquet(out)
    return found.select(F.col("id").alias("review_id"), F.col("business_id").cast("long").alias("entity_id"), "text")


@query(
    "q_stream_counters",
    f"""WITH {SQL_UNIQUE}
SELECT (SELECT count(*) FROM unique_reviews) AS records_written, 0::BIGINT AS dropped_malformed_json,
       (SELECT count(*) FROM cleaned WHERE text IS NULL) AS dropped_empty_short,
       (SELECT count(*) FROM ranked WHERE rn > 1) AS dropped_duplicate""",
    "reviews",
)
def stream_counters(v):
    _, counters = streamed(v)
    batches = v.spark.read.schema(S.COUNTERS).parquet(counters)
    names = [f.split()[0] for f in S.COUNTERS.split(", ")]
    return batches.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))

