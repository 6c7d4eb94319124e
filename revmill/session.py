"""Session helpers: a builder for local runs and the reliable folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "revmill", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "20MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A local session without one gets a temporary folder."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.master.startswith("local") and configured.startswith("file:"):
            raise ValueError("spark.checkpoint.dir names a folder of one machine; executors cannot share it")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="revmill-checkpoint-")
    remove_at_exit(spark, own)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the folder deleted when the driver ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once, so later passes neither recompute nor depend on executors.

    The table goes when the driver ends; where its end of use is known, staged() removes it earlier.
    """
    spark = df.sparkSession
    path = new_folder(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The rows as a Parquet table in the shared folder, removed when the block ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
