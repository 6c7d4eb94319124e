"""Writing tables, keyed merges and metric documents."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.operators.counts import table_count
from revmill.operators.dedupe import upsert
from revmill.sources.files import path_exists


def write_jsonl(df: DataFrame, path: str) -> None:
    """Replace the folder; the committer publishes it only when every task has finished."""
    df.write.mode("overwrite").json(path)


def append_table(
    df: DataFrame, table: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> None:
    """Append to a store table. fmt is any data source name, with its options."""
    writer = df.write.format(fmt).mode("append").options(**(options or {}))
    if fmt == "parquet":
        writer.saveAsTable(table)
    else:
        writer.save()


def append_batch(df: DataFrame, store: str, batch: str) -> bool:
    """Append rows to a Parquet store under a batch id; False, and nothing written, if the store has the batch already.

    The rows lie in a folder of the batch, and a manifest entry, written last, makes them part of the store. An append that
    stopped halfway has no entry, so its rows are not read, and a repeat replaces them. One writer a batch.
    """
    spark, name = df.sparkSession, quote(batch, safe="")
    entry = f"{store}/manifest/batch={name}"
    if path_exists(spark, f"{entry}/_SUCCESS"):
        return False
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{store}/rows/{name}")
    line = [(batch, f"rows/{name}", seen.get["n"])]
    spark.createDataFrame(line, MANIFEST).coalesce(1).write.mode("overwrite").json(entry)
    return True


MANIFEST = "batch string, folder string, n long"


def read_manifest(spark: SparkSession, store: str) -> DataFrame:
    """(batch, folder, n) of the batches of a store; empty for a store that has none."""
    if not path_exists(spark, f"{store}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{store}/manifest")


def read_batches(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches that were appended whole. The driver holds the names of the batches only."""
    folders = [f"{store}/{r.folder}" for r in read_manifest(spark, store).select("folder").collect()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").saveAsTable(table)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Create the table if it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def upsert_files(spark: SparkSession, path: str, updates: DataFrame, key: str, order: list[str], out: str) -> None:
    """Merge updates into the Parquet table at path and write the result to out."""
    target = spark.read.parquet(path) if path_exists(spark, path) else updates.limit(0)
    upsert(target, updates, key, order).write.mode("overwrite").parquet(out)


def verify_counts(spark: SparkSession, tables: list[str]) -> DataFrame:
    """(table_name, n); a table that cannot be read counts 0."""

    def one(name: str) -> DataFrame:
        try:
            return table_count(spark.table(name), name)
        except AnalysisException:
            return spark.range(1).select(F.lit(name).alias("table_name"), F.lit(0).cast("long").alias("n"))

    return reduce(DataFrame.unionByName, [one(t) for t in tables])


def save_metrics(doc: DataFrame, path: str) -> None:
    """Write a one-row document as JSON."""
    doc.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
