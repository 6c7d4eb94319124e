"""Exact deduplication with an extendible-hash index on shared files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import new_path, record_batches, remove, small_batches, stage, table, text_or_empty

MAX_DEPTH = 16  # the directory has at most 65,536 entries
BUCKET_KEYS = 20_000  # a bucket with more distinct hashes is split
COMBINE_BYTES = 16 << 20  # text that a task holds while it folds copies before the exchange
BATCH_BYTES = 4 << 20  # of texts that a task is handed, and hands on, at once


@dataclass(frozen=True)
class Directory:
    """Buckets by hash prefix: entry i names the bucket of all hashes whose first `depth` bits are i."""

    depth: int
    entries: tuple[int, ...]
    local_depth: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return len(self.local_depth)

    def bucket(self, key: Column) -> Column:
        if self.depth == 0:
            return F.lit(0)
        at = F.shiftrightunsigned(key, 64 - self.depth).cast("int")
        return F.get(F.split(F.lit(",".join(map(str, self.entries))), ","), at).cast("int")


def build_directory(counts: dict[int, int], capacity: int) -> Directory:
    """Split overfull buckets, doubling the directory when a bucket is already as deep as it is.

    counts has the number of distinct hashes for each prefix of MAX_DEPTH bits. A bucket that is overfull at
    that depth stays and is read as a stream.
    """
    total = [counts.get(i, 0) for i in range(1 << MAX_DEPTH)]
    sums = [0]
    for n in total:
        sums.append(sums[-1] + n)
    depth, prefixes, todo = 0, [], [(0, 0)]
    while todo:
        bits, prefix = todo.pop()
        low, high = prefix << (MAX_DEPTH - bits), (prefix + 1) << (MAX_DEPTH - bits)
        if sums[high] - sums[low] > capacity and bits < MAX_DEPTH:
            depth = max(depth, bits + 1)
            todo += [(bits + 1, 2 * prefix + 1), (bits + 1, 2 * prefix)]
        else:
            prefixes.append((bits, prefix))
    entries = [b for b, (bits, _) in enumerate(prefixes) for _ in range(1 << (depth - bits))]
    return Directory(depth, tuple(entries), tuple(bits for bits, _ in prefixes))


def _largest(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


PARTIAL = "hash long, text binary, max_id long, n long"
ENTRY = "bucket int, hash long, chain int, sha256 string, keep_id long, group_size long, text binary"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a task become one row, in a buffer of bounded size."""
    schema = pa.schema([("hash", pa.int64()), ("text", pa.binary()), ("max_id", pa.int64()), ("n", pa.int64())])
    held: dict[tuple[int, bytes], list] = {}
    size = 0

    def out():
        return record_batches(((h, t, m, n) for (h, t), (m, n) in held.items()), schema, BATCH_BYTES)

    for batch in batches:
        for doc_id, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "hash", "text"))):
            row = held.get((h, text))
            if row is None:
                held[h, text] = [doc_id, 1]
                size += len(text) + 100
                if size > COMBINE_BYTES:
                    yield from out()
                    held, size = {}, 0
            else:
                row[0], row[1] = _largest(row[0], doc_id), row[1] + 1
    yield from out()


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and hash become index entries; texts under one hash are chained and compared."""
    schema = pa.schema(
        [("bucket", pa.int32()), ("hash", pa.int64()), ("chain", pa.int32()), ("sha256", pa.string())]
        + [("keep_id", pa.int64()), ("group_size", pa.int64()), ("text", pa.binary())]
    )
    key, chain = None, []

    def close():
        seen = set()
        for i, (text, keep, n) in enumerate(chain):
            digest = hashlib.sha256(text).hexdigest()
            if digest in seen:
                raise ValueError("different texts with one SHA-256")
            seen.add(digest)
            yield key[0], key[1], i, digest, keep, n, text

    def entries():
        nonlocal key, chain
        for batch in batches:
            for bucket, h, text, top, n in zip(
                *(batch.column(c).to_pylist() for c in ("bucket", "hash", "text", "max_id", "n"))
            ):
                if (bucket, h) != key:
                    yield from close()
                    key, chain = (bucket, h), []
                for entry in chain:
                    if entry[0] == text:
                        entry[1], entry[2] = _largest(entry[1], top), entry[2] + n
                        break
                else:
                    chain.append([text, top, n])
        yield from close()

    yield from record_batches(entries(), schema, BATCH_BYTES)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index entries, one for each distinct text, from bucket files in the shared folder.

    The driver holds the directory, at most 65,536 entries. Each owner task takes one range
    of the hash, sorted; it holds only the chain of one hash. Copies are folded inside each scan task before
    the exchange, so a text that fills a third of the table reaches its owner once for each buffer, not row by row.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty(text_col)).alias("hash"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    per_prefix = (
        rows.groupBy("hash").agg(F.lit(1).alias("one"))
        .groupBy(F.shiftrightunsigned("hash", 64 - MAX_DEPTH).alias("prefix")).agg(F.count("*").alias("n"))
    )
    directory = build_directory({r["prefix"]: r["n"] for r in per_prefix.collect()}, BUCKET_KEYS)
    owners = max(directory.buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    owner = F.shiftright(F.shiftrightunsigned("hash", 32) * F.lit(owners), 32).cast("int")
    owned = (
        rows.mapInArrow(_fold, PARTIAL)
        .withColumn("bucket", directory.bucket(F.col("hash")))
        .repartitionById(owners, owner)
        .sortWithinPartitions("bucket", "hash")
    )
    path = new_path(spark, "hash-index")
    with small_batches(spark, BATCH_BYTES):
        owned.mapInArrow(_own, ENTRY).write.partitionBy("bucket").parquet(path)
    index = spark.read.schema(ENTRY).parquet(path)
    index.staged_at = path
    return index


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. The row with the largest id of a group stays. A null id
    is smaller than any other; in a group with null ids only, keep_id is null and its rows count as kept. Rows
    that repeat with the same id are all members and, with the largest id, all marked as kept. Texts
    of any length, empty texts and empty tables are fine; other columns are not read.
    """
    entries = build_index(docs, id_col, text_col).select("hash", "sha256", "keep_id", "group_size")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty(text_col)).alias("hash"),
        F.sha2(text_or_empty(text_col), 256).alias("sha256"),
    )
    return rows.join(entries, ["hash", "sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row, with all its columns, for each distinct text: the one with the largest doc_id."""
    index = build_index(docs)
    entries = stage(
        index.select(F.col("hash").alias("__hash"), F.col("sha256").alias("__sha"), F.col("keep_id").alias("__keep")),
        "hash-entries",
    )
    remove(index)  # its texts take as much room as the documents, and nothing compares them any more
    rows = docs.withColumns({"__hash": F.xxhash64(text_or_empty()), "__sha": F.sha2(text_or_empty(), 256)})
    kept = rows.join(entries, ["__hash", "__sha"]).where(F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")))
    # Rows that repeat with the same id are still together; one of them is enough.
    return kept.dropDuplicates(["__hash", "__sha"]).select(*(f"`{c}`" for c in docs.columns))


def op7_extendible_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL_OP7 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
