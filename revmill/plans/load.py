"""Load job: clean JSON lines into keyed store tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revmill import schemas
from revmill.functions import text as X
from revmill.functions import values as V
from revmill.operators.dedupe import upsert
from revmill.operators.rows import coerce_defaults, unreadable
from revmill.session import staged
from revmill.sources import files, sinks

# What a missing or null field becomes, by type.
DEFAULTS = {"string": "", "double": 0.0, "integer": 0}


@dataclass(frozen=True)
class Loaded:
    """Rows loaded; lines skipped as malformed or for a number that can't be read; lines without a key."""

    rows: int
    skipped: int
    keyless: int = 0


def store_rows(lines: DataFrame, schema: StructType, key: str, null_skips: bool = True) -> DataFrame:
    """One row for each line in the types of the store, with the line order, and its fate: loaded, skipped or keyless.

    A line is skipped if it is malformed or holds an unreadable number, and with null_skips also if it gives a number as
    null (left out, the number has its default). Long review texts are cut with a mark.
    """
    names = [f.name for f in schema.fields]
    spec = {
        f.name: (f.dataType.simpleString(), DEFAULTS[f.dataType.typeName()]) for f in schema.fields
    }
    bad = F.col(schemas.CORRUPT).isNotNull() | unreadable(spec)
    if null_skips:
        bad = bad | F.col(files.NULL_NUMBER)
    whole = F.col(schemas.CORRUPT).isNull()
    fate = F.when(whole & ~V.has_key(F.col(key)), "keyless").when(bad, "skipped").otherwise("loaded")
    marked = lines.select(*names, *files.LINE_ORDER, fate.alias("fate"))
    rows = coerce_defaults(marked, spec)
    return rows.withColumn("text", X.truncate_suffix(F.col("text"))) if "text" in names else rows


def load_counters(rows: DataFrame) -> DataFrame:
    """One row: lines loaded, skipped and without a key."""
    return rows.agg(*(F.count_if(F.col("fate") == f).alias(f) for f in ("loaded", "skipped", "keyless")))


def load_table(
    spark: SparkSession,
    src: str,
    table: str,
    schema: StructType,
    key: str,
    recreate: bool = True,
    limit: int | None = None,
    null_skips: bool = True,
) -> Loaded:
    """Write the rows by key, the last line of a key winning; merge with the table unless it is recreated.

    Every field is read as text, so that a quoted number loads and only an unreadable one skips its row.
    Rows are staged once for counting and writing, and merged rows before they replace the table they read.
    """
    raw = StructType([StructField(f.name, StringType()) for f in schema.fields])
    if limit is None:
        lines = files.read_jsonl_lines(spark, src, raw)
    else:
        lines = files.head_lines(spark, src, raw, limit)
    with staged(store_rows(lines, schema, key, null_skips)) as rows:
        counts = load_counters(rows).first()
        good = rows.filter("fate = 'loaded'").drop("fate")
        if recreate:
            last = upsert(good.limit(0), good, key, files.LINE_ORDER)
            sinks.overwrite_table(last.drop(*files.LINE_ORDER), table)
        else:
            sinks.ensure_table(spark, table, schema)
            unknown = [F.lit(None).cast(good.schema[c].dataType).alias(c) for c in files.LINE_ORDER]
            before = spark.table(table).select("*", *unknown)
            merged = upsert(before, good, key, files.LINE_ORDER)
            with staged(merged.drop(*files.LINE_ORDER)) as result:
                sinks.overwrite_table(result, table)
    return Loaded(*counts)


def load(
    spark: SparkSession,
    business: str,
    review: str,
    business_table: str = "businesses",
    review_table: str = "reviews",
    recreate: bool = True,
    review_limit: int | None = None,
    narrow: bool = False,
) -> DataFrame:
    """Load both tables where their file exists; return the row counts of the tables."""
    entity_schema = schemas.BUSINESS_STORE_NARROW if narrow else schemas.BUSINESS_STORE
    review_schema = schemas.REVIEW_STORE_NARROW if narrow else schemas.REVIEW_STORE
    if files.path_exists(spark, business):
        load_table(spark, business, business_table, entity_schema, "business_id", recreate, None, not narrow)
    if files.path_exists(spark, review):
        load_table(spark, review, review_table, review_schema, "review_id", recreate, review_limit, not narrow)
    return sinks.verify_counts(spark, [business_table, review_table])
