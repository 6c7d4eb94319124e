"""Reading JSON lines and metric documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill.functions import values as V
from revmill.operators.limits import head_sample
from revmill.schemas import CORRUPT, with_corrupt

# The numeric fields of the JSON tables.
WHOLE_NUMBERS = ("useful", "funny", "cool", "review_count", "is_open")
NUMBERS = ("stars", "latitude", "longitude")
NULL_NUMBER = "null_number"

# File, block and running number: the order of the lines in the input, unique per line.
LINE_ORDER = ["line_file", "line_block", "line_no"]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_jsonl_tolerant(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed lines). Blank lines are skipped."""
    rows = read_jsonl_lines(spark, path, schema)
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, NULL_NUMBER, *LINE_ORDER)
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, *LINE_ORDER)
    return good, bad


def read_jsonl_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """All non-blank lines with the corrupt-record column and the line order.

    Lines are read as text and parsed against the whole schema: the JSON source parses only the columns a
    query uses, so whether a line counts as malformed would change from query to query. A block is read by
    one task from front to back, so the running number rises with the position in it.
    """
    lines = _filled_lines(spark, path).select(
        "value",
        F.col("_metadata.file_path").alias("line_file"),
        F.col("_metadata.file_block_start").alias("line_block"),
        F.monotonically_increasing_id().alias("line_no"),
    )
    return parse_lines(lines, schema)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines in the column value as columns of the schema and the corrupt-record column, beside the others.

    Fields that are read as text but are whole numbers in the tables take number and truth tokens as such.
    null_number tells lines that give a numeric field as null.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rest = [c for c in lines.columns if c != "value"]
    row = lines.select("value", *rest, F.from_json("value", with_corrupt(schema), options).alias("row"))

    def column(field: T.StructField):
        value = F.col("row").getField(field.name)
        if field.name in WHOLE_NUMBERS and isinstance(field.dataType, T.StringType):
            value = V.json_integer(F.col("value"), field.name, value)
        return value.alias(field.name)

    numbers = [f.name for f in schema.fields if f.name in WHOLE_NUMBERS or f.name in NUMBERS]
    null = V.json_null(F.col("value"), numbers) if numbers else F.lit(False)
    return row.select(*(column(f) for f in with_corrupt(schema).fields), null.alias(NULL_NUMBER), *rest)


def _filled_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0)


def head_lines(spark: SparkSession, path: str, schema: T.StructType, n: int) -> DataFrame:
    """The first n non-blank lines. Only as many files are read as hold them, in path order."""
    paths = sorted(spark.read.text(path).inputFiles())
    take = 1
    while take < len(paths):
        found = _filled_lines(spark, paths[:take]).count()
        if found >= n:
            break
        take = min(len(paths), max(2 * take, 1 + take * n // max(found, 1)))
    return head_sample(read_jsonl_lines(spark, paths[:take], schema), n, LINE_ORDER)


# Scans up to this size may be one row group; larger ones have many and are never shuffled for balance.
SPREAD_BYTES = 256 << 20


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Shuffle a small file scan by a unique key, so that costly per-row work is not left to a single task.

    A scan over SPREAD_BYTES, on any cluster, is left as it is. The size is the planner's, from the files alone.
    """
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return scan.repartition(key) if int(str(size)) <= SPREAD_BYTES else scan


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one of the same schema when the path is missing."""
    if path_exists(spark, path):
        return read_jsonl(spark, path, schema)
    return spark.createDataFrame([], schema)


def require_inputs(spark: SparkSession, paths: list[str]) -> None:
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing input: {', '.join(missing)}")


def load_metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """A saved metric document as one row, or None when it is missing."""
    if not path_exists(spark, path):
        return None
    return spark.read.option("multiLine", True).json(path)


def describe_table(df: DataFrame) -> DataFrame:
    """(column, type, nullable)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")


def build_sample(
    spark: SparkSession, src: str, dst: str, schema: T.StructType, n: int, mode: str = "skip"
) -> DataFrame:
    """Write the first n lines of src to dst. skip leaves an existing sample alone, force rebuilds it."""
    if mode not in ("skip", "force"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "force" or not path_exists(spark, dst):
        kept = head_lines(spark, src, schema, n).filter(F.col(CORRUPT).isNull()).drop(CORRUPT, NULL_NUMBER, *LINE_ORDER)
        kept.write.mode("overwrite").json(dst)
    return read_jsonl(spark, dst, schema)
