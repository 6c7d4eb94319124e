"""Substring deduplication by level-wise doubling.

Level one takes windows of a quarter of the length. Only those that repeat are extended to windows of half the length, only
those of them that repeat to the whole length, and so on, until no candidates survive. The levels below the whole length look
at anchors only: a shorter window whose hash is least among those in a whole window. Every whole window holds one, chosen by
its words alone, so equal windows hold equal anchors and none is lost.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import record_batches, remove, stage, table, text_or_empty

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that powers can be undone modulo 2 ** 64
NO_ID = (1 << 63) - 1  # a null id comes after all others


class WordHashes(dict):
    def __init__(self, digest):
        super().__init__()
        self.digest = digest

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = self.digest(word)
        return h


class Words:
    """Two 64-bit hashes of words, remembered up to a bound, and hashes of windows of them."""

    def __init__(self):
        self.known = [WordHashes(f) for f in (xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest)]
        self.powers = [np.ones(1, dtype=np.uint64) for _ in BASES]
        self.inverse = [np.ones(1, dtype=np.uint64) for _ in BASES]

    def hashes(self, words: list[bytes], which: int) -> np.ndarray:
        return np.fromiter(map(self.known[which].__getitem__, words), np.uint64, len(words))

    def windows(self, h: np.ndarray, length: int, which: int) -> np.ndarray:
        """A hash of each run of `length` words, by differences of prefix sums."""
        n = len(h)
        if len(self.powers[which]) < n:
            for table_, base in ((self.powers, BASES[which]), (self.inverse, pow(BASES[which], -1, 1 << 64))):
                steps = np.full(2 * n, base, dtype=np.uint64)
                steps[0] = 1
                table_[which] = np.multiply.accumulate(steps)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.powers[which][:n], dtype=np.uint64)])
        out = (sums[length:] - sums[:-length]) * self.inverse[which][: n - length + 1]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(29))


def _sliding(x: np.ndarray, size: int, least) -> np.ndarray:
    """The least (or greatest) of every run of `size` values."""
    done = 1
    while 2 * done <= size:
        x = least(x[:-done], x[done:])
        done *= 2
    if done < size:
        x = least(x[: -(size - done)], x[size - done :])
    return x


def anchors(h: np.ndarray, grams: int) -> np.ndarray:
    """Places whose value is the least of some run of `grams` values, ties included."""
    least = _sliding(h, grams, np.minimum)
    edge = np.zeros(grams - 1, dtype=h.dtype)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), grams, np.maximum) == h)


def _list(values: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, values[0].dtype if values else np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc: the id, nulls last; mark: with it, tells apart rows that share an id."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text_or_empty(text_col)).alias("mark"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )


def _first_level(rows: DataFrame, length: int, size: int) -> DataFrame:
    """Per row the number of words, the digest of all words, and its anchors among the windows of `size` words."""
    ddl = "doc long, mark long, n_words long, words_sha256 string, place array<int>, hash array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                counts, digests, places, values = [], [], [], []
                for text in batch.column("text"):
                    words = WORD.findall(text.as_py())
                    counts.append(len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if len(words) < length:
                        at, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
                    else:
                        h = known.windows(known.hashes(words, 0), size, 0)
                        at = anchors(h, length - size + 1)
                        h = h[at]
                    places.append(at.astype(np.int32))
                    values.append(h.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc"), batch.column("mark"), pa.array(counts, pa.int64()), pa.array(digests)]
                    + [_list(places, pa.int32()), _list(values, pa.int64())],
                    names=["doc", "mark", "n_words", "words_sha256", "place", "hash"],
                )

    return rows.mapInArrow(run, ddl)


def _alive(hashes: np.ndarray, place: np.ndarray, length: int, size: int) -> np.ndarray:
    """For each whole window, whether its least window of `size` words is one of those at the places."""
    alive = hashes[place]
    return np.isin(_sliding(hashes, length - size + 1, np.minimum), alive)


def _next_level(candidates: DataFrame, length: int, size: int, following: int) -> DataFrame:
    """Anchors of `following` words in the whole windows whose least window of `size` words repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            places, values = [], []
            for i in range(batch.num_rows):
                words = known.hashes(WORD.findall(batch.column("text")[i].as_py()), 0)
                place = batch.column("place")[i].values.to_numpy()
                alive = _alive(known.windows(words, size, 0), place, length, size)
                h = known.windows(words, following, 0)
                least = np.unique(_sliding(h, length - following + 1, np.minimum)[alive])
                at = np.flatnonzero(np.isin(h, least))
                places.append(at.astype(np.int32))
                values.append(h[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("mark"), _list(places, pa.int32()), _list(values, pa.int64())],
                names=["doc", "mark", "place", "hash"],
            )

    return candidates.mapInArrow(run, "doc long, mark long, place array<int>, hash array<long>")


def _repeated_anchors(level: DataFrame) -> DataFrame:
    """(doc, mark, places of the anchors that more than one document holds)."""
    found = level.select("doc", "mark", F.explode(F.arrays_zip("place", "hash")).alias("w")).select("doc", "mark", "w.*")
    ends = found.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    ends = stage(ends.select("hash"), "anchors-first")
    return found.join(ends, "hash").groupBy("doc", "mark").agg(F.collect_set("place").alias("place"))


def _whole_windows(candidates: DataFrame, length: int, size: int) -> DataFrame:
    """Windows of the whole length whose least window of `size` words repeats: (doc, mark, place, a, b).

    Equal windows have equal least ones, and those are anchors wherever they stand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for i in range(batch.num_rows):
                words = WORD.findall(batch.column("text")[i].as_py())
                hashes = [known.hashes(words, w) for w in (0, 1)]
                shorter = known.windows(hashes[0], size, 0)
                place = np.flatnonzero(_alive(shorter, batch.column("place")[i].values.to_numpy(), length, size))
                a, b = (known.windows(hashes[w], length, w)[place].view(np.int64) for w in (0, 1))
                own = [batch.column(c)[i].as_py() for c in ("doc", "mark")]
                for start in range(0, len(place), 100_000):
                    part = slice(start, start + 100_000)
                    same = [pa.array(np.full(len(place[part]), v, np.int64)) for v in own]
                    yield pa.RecordBatch.from_arrays(
                        [*same, pa.array(place[part].astype(np.int32)), pa.array(a[part]), pa.array(b[part])],
                        names=["doc", "mark", "place", "a", "b"],
                    )

    return candidates.mapInArrow(run, "doc long, mark long, place int, a long, b long")


def _repeated(windows: DataFrame) -> DataFrame:
    """Windows that start in more than one document; later: also in one with a smaller id."""
    ends = windows.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    # Written, the few that repeat meet the windows in a join whose large partitions Spark can split.
    ends = stage(ends.where("first < last").drop("last"), "windows-first")
    return windows.join(ends, ["a", "b"]).select(
        "doc", "mark", "place", "a", "b", (F.col("doc") > F.col("first")).alias("later")
    )


def remove_repeats(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", longest: bool = True
) -> DataFrame:
    """Remove the words of every window that also starts in a document with a smaller id.

    One row for each input row: doc_id, n_words, n_removed, kept_text (the kept words with one blank between, null where
    nothing goes), words_sha256 (of all words, joined likewise) and longest (the longest level, length times a power of
    two, at which a window of the document repeats in an earlier one; 0 if none; without `longest` the doubling ends at
    the length, and there is no such column). Windows are judged on the input.
    Null and empty texts have no words, texts shorter than a window keep all. A null id is larger than any other, and
    rows with the same id are not earlier than each other. Other columns are not read.

    Documents with equal words need no windows but the first's: all later ones go whole, if they hold a window. Minima are
    aggregates that combine before the exchange; a window that very many documents share meets its minimum in a
    join whose large partitions Spark splits. Texts move once, and afterwards only those of candidates.
    """
    rows = _rows(docs, id_col, text_col)
    sizes = [n for n in (length // 4, length // 2) if n]
    base = stage(_first_level(rows, length, sizes[0]), "windows-short")
    equal = base.where(F.col("n_words") >= length).groupBy("words_sha256").agg(F.min("doc").alias("first_doc"))
    # Written, the many copies of one text meet their first in a join whose large partitions Spark can split.
    equal = stage(equal, "equal-first")
    marked = base.select("doc", "mark", "n_words", "words_sha256").join(equal, "words_sha256", "left")
    marked = stage(marked.withColumn("copy", F.coalesce(F.col("doc") > F.col("first_doc"), F.lit(False))), "copies")

    alive = _repeated_anchors(base).join(marked.where("copy").select("doc", "mark").distinct(), ["doc", "mark"], "left_anti")
    candidates = stage(rows.join(alive, ["doc", "mark"]), "candidates")
    remove(base)
    for size, following in zip(sizes, sizes[1:]):
        level = stage(_next_level(candidates, length, size, following), "windows-half")
        fewer = stage(candidates.drop("place").join(_repeated_anchors(level), ["doc", "mark"]), "candidates")
        remove(candidates)
        remove(level)
        candidates = fewer

    windows = stage(_whole_windows(candidates, length, sizes[-1]), "windows-whole")
    if longest:
        level, size = stage(_repeated(windows), "windows-1"), length
        whole, reached = level.where("later"), None
        while True:
            now = level.where("later").select("doc", "mark").distinct().withColumn("size", F.lit(size).cast("long"))
            reached = now if reached is None else reached.unionByName(now)
            second = level.select("doc", "mark", (F.col("place") - size).alias("place"), F.col("a").alias("a2"), F.col("b").alias("b2"))
            twice = level.drop("later").join(second, ["doc", "mark", "place"]).select(
                "doc", "mark", "place", F.xxhash64("a", "a2").alias("a"), F.xxhash64("b2", "b").alias("b")
            ).distinct()
            level, size = stage(_repeated(twice), "windows-2"), 2 * size
            if level.isEmpty():
                break
        reached = reached.groupBy("doc", "mark").agg(F.max("size").alias("longest"))
    else:
        whole = _repeated(windows).where("later")

    gone = whole.groupBy("doc", "mark").agg(F.collect_set("place").alias("place"))
    once = candidates.select("doc", "mark", "text").dropDuplicates(["doc", "mark"])
    cut = once.join(gone, ["doc", "mark"]).mapInArrow(
        _cutter(length), "doc long, mark long, removed long, cut_text string"
    )
    every = marked.join(cut, ["doc", "mark"], "left")
    if longest:
        every = every.join(reached, ["doc", "mark"], "left")
    by_copy = F.col("copy")
    doublings = F.expr(f"{length} * shiftleft(1L, length(bin(n_words div {length})) - 1)")
    out = [
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        F.col("n_words"),
        F.when(by_copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(by_copy, F.lit("")).otherwise(F.col("cut_text")).alias("kept_text"),
        F.col("words_sha256"),
    ]
    if longest:
        out.append(F.when(by_copy, doublings).otherwise(F.coalesce("longest", F.lit(0))).cast("long").alias("longest"))
    return every.select(*out)


def _cutter(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("removed", pa.int64()), ("cut_text", pa.string())])

        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    words = WORD.findall(batch.column("text")[i].as_py())
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    at = batch.column("place")[i].values.to_numpy()
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + length, -1)
                    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    text = b" ".join([words[k] for k in kept]).decode("utf-8", "replace")
                    yield batch.column("doc")[i].as_py(), batch.column("mark")[i].as_py(), len(words) - len(kept), text

        yield from record_batches(rows(), schema)

    return run


def op8_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), longest=False)
    digest = F.when(F.col("kept_text").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept_text", 256))
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


SQL_OP8 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
v AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
m AS (SELECT h, min(doc_id) AS first FROM v GROUP BY h),
g AS (SELECT DISTINCT v.doc_id, unnest(range(v.i, v.i + 50)) AS p FROM v JOIN m ON v.h = m.h AND m.first < v.doc_id),
a AS (SELECT doc_id, list(p) AS gone FROM g GROUP BY doc_id),
k AS (
  SELECT d.doc_id, len(w) AS n_words, len(coalesce(gone, [])) AS n_removed,
    array_to_string(CASE WHEN gone IS NULL THEN w
      ELSE list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(gone, p))),
                          lambda p: w[p]) END, ' ') AS kept
  FROM d LEFT JOIN a ON d.doc_id = a.doc_id)
SELECT doc_id, n_words, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k
"""
