"""Written tables in the shared folder, and small helpers the operators have in common."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    """A new folder name below spark.checkpoint.dir; what is written there goes when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    target, files = _hadoop(spark, path)
    files.deleteOnExit(target)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: a lost executor costs a read, not a recomputation."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def remove(staged: DataFrame) -> None:
    """Delete a table that stage() returned and nothing reads any more."""
    remove_path(staged.sparkSession, staged.staged_at)


def remove_path(spark: SparkSession, path: str) -> None:
    target, files = _hadoop(spark, path)
    files.delete(target, True)


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession, limit: int):
    """Actions inside hand Arrow batches of about `limit` bytes to Python, where Spark counts rows only by default."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def short_lived_shuffles(spark: SparkSession):
    """Shuffle files of an action inside go when it ends, and not when the driver happens to collect garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def record_batches(rows, schema, limit: int = 16 << 20):
    """Tuples as Arrow batches that hold about `limit` bytes of text, binary and arrays at most."""
    import numpy as np
    import pyarrow as pa

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 16 + sum(x.nbytes if isinstance(x, np.ndarray) else len(x) for x in row if isinstance(x, (bytes, str, np.ndarray)))
        if size > limit or len(held) >= 20_000:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def portions(batch, limit: int, step: int = 100) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of the rows of a batch (doc_id, text), which become Python's a few at a time: as many rows as have over
    `limit` characters, or more by `step` rows at most."""
    ids, texts, size = [], [], 0
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        ids += part.column("doc_id").to_pylist()
        texts += part.column("text").to_pylist()
        size += sum(map(len, texts[-part.num_rows :]))
        if size > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def give_back() -> None:
    """The room of Arrow batches that are gone returns to the system: Python workers outlive their tasks, and keep it else."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


def keep_rows(docs: DataFrame, make_decider) -> DataFrame:
    """The rows, with all their columns, whose text a decider accepts.

    make_decider is called once in each task and gives a function from a list of texts (null as empty) to a list of
    booleans. Rows stay where they are: nothing is exchanged.
    """

    def run(batches):
        import pyarrow as pa

        decide = make_decider()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(decide(texts), pa.bool_()))
        whole = batch = None
        give_back()

    return docs.mapInArrow(run, docs.schema)
