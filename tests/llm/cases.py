"""Awkward documents that every operator must take."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        *(T.StructField(c, T.StringType()) for c in ("hash", "mark", "keep_id", "node", "score", "slot", "file", "row", "n")),
    ]
)

LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
EXTRA = (None, "x", None, "1", "?", "y", "z", "w", "0")


def rows():
    texts = [
        (1, "a plain text with some words in it"),
        (2, "a plain text with some words in it"),
        (2, "a plain text with some words in it"),
        (3, ""),
        (4, None),
        (5, LONG),
        (6, LONG),
        (7, "  \n\t "),
        (None, "no id here"),
        (None, None),
        (8, "ünïcødé – 漢字 😀 " * 3),
        (9, "one"),
        (10, "x" * 100_000),
    ]
    return [(i, t, None, "s", None if t is None else len(t), *EXTRA) for i, t in texts]


def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
