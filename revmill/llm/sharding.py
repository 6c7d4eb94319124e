"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmill.llm.shelf import stage, table, text_or_empty

MAX_FILES = 65_536  # rows of the matrix: at 24 shards it stays below 13 MB
BLOCK_ROWS = 50_000  # rows that one task permutes at a time


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n rows drawn without replacement are good ones; for any population size.

    Inverts the cumulative probabilities in a window of 14 standard deviations around the mode, which holds
    all but 1e-40 of the mass.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    spread = (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    reach = int(14 * spread) + 20
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    a = k[:-1]
    steps = np.log(good - a) + np.log(n - a) - np.log(a + 1) - np.log(bad - n + a + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    cumulative = np.cumsum(np.exp(logs - logs.max()))
    at = np.searchsorted(cumulative, rng.random() * cumulative[-1], side="right")
    return int(k[min(at, len(k) - 1)])


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard; row sums are counts, column sums are sizes.

    Drawn as a uniform permutation of all rows would give it: each partition in turn takes a multivariate
    hypergeometric sample of the places still free.
    """
    rng = np.random.default_rng([seed, 1])
    free = list(sizes)
    out = np.zeros((len(counts), len(sizes)), dtype=np.int64)
    for p, n in enumerate(counts):
        rest, left = sum(free), n
        for s, room in enumerate(free):
            rest -= room
            got = hypergeometric(rng, room, rest, left) if left else 0
            out[p, s], left = got, left - got
            free[s] -= got
    return out


def uniform_shards(df: DataFrame, n_shards: int, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add shard (0 to n_shards - 1) and slot (gapless from 0 in each shard): a uniform random order of all rows.

    Shard sizes are exact and differ by one row at most. The rows are written to the shared folder once, and a
    row's address is its file and place there, so a task that runs again gives the same answer. The driver holds
    a count for each file and the matrix, at most MAX_FILES by n_shards. Each file's rows are permuted
    and dealt by its matrix row; after the exchange the rows of a shard are permuted again, in blocks of about
    block_rows rows by a random key. Rows that repeat, ties and nulls are rows like any other: no value decides
    the place, so no hot value makes a large task. An empty table gives an empty result. Input columns named
    shard or slot are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    df = df.drop("shard", "slot")
    names = df.columns
    data = stage(df.coalesce(MAX_FILES), "shard-input").select(
        *[F.col(f"`{c}`") for c in names],
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    found = sorted((r["__file"], r["n"]) for r in data.groupBy("__file").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in found)
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    place = {f: i for i, (f, _) in enumerate(found)}
    matrix = communication_matrix([n for _, n in found], sizes, seed)

    @F.pandas_udf("int")
    def shard_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        current, dealt = None, None
        for file, row in batches:
            out = np.empty(len(file), dtype=np.int32)
            files, rows = file.to_numpy(), row.to_numpy()
            for f in np.unique(files):
                if f != current:
                    current, dealt = f, np.repeat(np.arange(n_shards, dtype=np.int32), matrix[place[f]])
                    np.random.default_rng([seed, 2, f]).shuffle(dealt)
                out[files == f] = dealt[rows[files == f]]
            yield pd.Series(out)

    blocks = max(1, -(-total // (n_shards * block_rows)))
    mixed = data.withColumn("shard", shard_of("__file", "__row")).withColumn(
        "__key", F.xxhash64(F.lit(seed), F.lit("second"), "__file", "__row")
    )
    mixed = mixed.withColumn("__block", F.shiftright(F.shiftrightunsigned("__key", 32) * F.lit(blocks), 32))
    first = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        mixed.groupBy("shard", "__block")
        .agg(F.count("*").alias("__n"))
        .select("shard", "__block", F.coalesce(F.sum("__n").over(first), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy("shard", "__block").orderBy("__key", "__file", "__row")
    return mixed.join(starts, ["shard", "__block"]).select(
        *[F.col(f"`{c}`") for c in names],
        "shard",
        (F.col("__start") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
    )


def op6_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law of equal row counts.

    Equal texts are not kept together: a group larger than a shard could not be, under this law. They are spread
    like any other rows. A null text has no bytes: size 8 and checksum 0.
    """
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text_or_empty()) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return uniform_shards(rows, 24).withColumn("grown_shard", F.lit(None).cast("int"))
