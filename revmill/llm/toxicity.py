"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import keep_rows, remove, small_batches, stage, table, text_or_empty

WORD = re.compile(r"[^\W_]+")
STEMS = (4, 6)  # letters; inflected and compound words share them
BIAS = 0  # the coordinate that every text has
KNOWN_WORDS = 100_000  # whose hashes a task remembers before it takes the next text; its words come on top
BATCH_BYTES = 4 << 20  # of texts or coordinates that the fit hands to a task at once; Spark's 10,000 rows may be 100 MB


@dataclass(frozen=True)
class FtrlSettings:
    """Hash width, FTRL-proximal rates and penalties, and the bounds of the fit."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.1
    rounds: int = 4
    shards: int = 4
    max_fit_rows: int = 50_000  # the fit takes at most so many labels, drawn by a hash of the id
    seed: int = 7


class Hasher:
    """Words to 64-bit hashes, of the word and of its stems, remembered up to a bound; n-grams to coordinates."""

    def __init__(self, bits: int):
        self.bits, self.known, self.rows = bits, {}, np.zeros((1024, 1 + len(STEMS)), np.uint64)

    def words(self, text: str) -> np.ndarray:
        """A row for each word: the hash of the word, then those of its first STEMS letters (0 if it has no more)."""
        found = WORD.findall(text.lower())
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, out = self.known, []
        for word in found:
            at = known.get(word)
            if at is None:
                at = known[word] = len(known)
                if at == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                parts = [word, *(f"{word[:n]}-" if len(word) > n else "" for n in STEMS)]
                self.rows[at] = [xxhash.xxh64_intdigest(p.encode("utf-8", "replace"), 1) if p else 0 for p in parts]
            out.append(at)
        return self.rows[np.array(out, dtype=np.int64)]

    def _coordinate(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.where(at == BIAS, 1, at)

    def features(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row, coordinate) of every word, stem, word pair and pair with one word skipped, repeats included."""
        per_text = [self.words(t) for t in texts]
        rows = np.repeat(np.arange(len(per_text)), [len(w) for w in per_text])
        every = np.concatenate([np.zeros((0, 1 + len(STEMS)), np.uint64), *per_text])
        h = np.ascontiguousarray(every[:, 0])
        found = [(rows, self._coordinate(h))]
        for stem in every[:, 1:].T:
            has = stem != 0
            found.append((rows[has], self._coordinate(stem[has])))
        for gap, odd in ((1, 0xD6E8FEB86659FD93), (2, 0xA0761D6478BD642F)):
            same = rows[gap:] == rows[:-gap]
            pair = h[:-gap] * np.uint64(odd) + (h[gap:] ^ (h[gap:] >> np.uint64(29)))
            found.append((rows[gap:][same], self._coordinate(pair[same])))
        return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


def ftrl_weights(z: np.ndarray, n: np.ndarray, at: np.ndarray, s: FtrlSettings) -> np.ndarray:
    """The weights that the state (z, n) stands for; the bias has no L1 penalty."""
    l1 = np.where(at == BIAS, 0.0, s.l1)
    w = -(z - np.sign(z) * l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def ftrl_pass(rows: Iterable[tuple[np.ndarray, float]], z: np.ndarray, n: np.ndarray, s: FtrlSettings) -> None:
    """One pass over rows of (distinct coordinates, label), changing the state in place."""
    for at, label in rows:
        zi, ni = z[at], n[at]
        w = ftrl_weights(zi, ni, at, s)
        g = sigmoid(w.sum()) - label
        grown = ni + g * g
        z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / s.alpha * w
        n[at] = grown


@dataclass(frozen=True)
class Weights:
    """Sparse weights: coordinates in order and their values, at most 2 ** bits of them."""

    bits: int
    at: np.ndarray
    value: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=np.float32)
        out[self.at] = self.value
        return out


def fit(labelled: DataFrame, settings: FtrlSettings | None = None) -> Weights:
    """Fit on labelled rows (id, text, label 0 or 1).

    The rows are dealt over `shards` files by a hash of the id. In every round each task continues from the common
    state, and the states are averaged by coordinate. A state is 2 ** bits numbers twice, whatever the input: 8 MB at 20
    bits, of which the driver holds one for each shard and itself.
    Rows without a label are left out. Without any rows nothing is known and nothing is toxic.
    """
    s = settings or FtrlSettings()
    spark = labelled.sparkSession
    rows = labelled.where("label IS NOT NULL").select(
        F.xxhash64(F.lit(s.seed), F.col("id").cast("string")).alias("draw"),
        text_or_empty().alias("text"), (F.col("label") > 0).cast("double").alias("label"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(s.bits)
        schema = pa.schema([("draw", pa.int64()), ("label", pa.float64()), ("at", pa.list_(pa.int32()))])
        for whole in batches:
            # Coordinates take several times the room of their texts, so few rows are held at once.
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                out = [
                    np.unique(np.append(hasher.features([text.as_py()])[1], BIAS)).astype(np.int32)
                    for text in batch.column("text")
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("draw"), batch.column("label"), pa.array(out, pa.list_(pa.int32()))], schema=schema
                )

    size = 1 << s.bits
    z, n = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
    with small_batches(spark, BATCH_BYTES):
        data = stage(
            rows.mapInArrow(encode, "draw long, label double, at array<int>")
            .repartitionById(s.shards, F.pmod("draw", F.lit(s.shards)).cast("int"))
            .sortWithinPartitions("draw")
            .drop("draw"),
            "ftrl-rows",
        )
    block = min(size, 1 << 16)
    for turn in range(s.rounds):
        start = spark.sparkContext.broadcast((z, n))

        def train(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            own_z, own_n = (x.astype(np.float64) for x in start.value)
            any_rows = False
            for batch in batches:
                any_rows = any_rows or batch.num_rows > 0
                labels, lists = batch.column("label").to_numpy(), batch.column("at")
                order = np.random.default_rng([s.seed, turn]).permutation(batch.num_rows)
                ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
                ftrl_pass(((flat[ends[i] : ends[i + 1]], labels[i]) for i in order), own_z, own_n, s)
            for first in range(0, size if any_rows else 0, block):
                part = [x[first : first + block].astype(np.float32).tobytes() for x in (own_z, own_n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first], pa.int32()), *(pa.array([p], pa.binary()) for p in part)], names=["first", "z", "n"]
                )

        # A staged file is one shard and one row group, so one task reads it; tasks without rows say nothing.
        with small_batches(spark, BATCH_BYTES):
            states = data.mapInArrow(train, "first int, z binary, n binary").toArrow()
        if states.num_rows:
            tasks = states.num_rows * block // size
            z, n = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
            for first, *parts in zip(*(states.column(c) for c in ("first", "z", "n"))):
                at = slice(first.as_py(), first.as_py() + block)
                for total, part in zip((z, n), parts):
                    total[at] += np.frombuffer(part.as_buffer(), dtype=np.float32) / tasks
        start.destroy()
    remove(data)
    at = np.arange(size)
    w = ftrl_weights(z.astype(np.float64), n.astype(np.float64), at, s)
    if not n.any():
        w[BIAS] = -5.0  # nothing is known: nothing is toxic
    keep = np.flatnonzero(w)
    return Weights(s.bits, keep.astype(np.int32), w[keep].astype(np.float32))


def scores(hasher: Hasher, dense: np.ndarray, texts: list[str]) -> list[float]:
    """A feature counts once in a text, however often it occurs."""
    out: list[float] = []
    for start in range(0, len(texts), 64):
        part = texts[start : start + 64]
        row, at = hasher.features(part)
        used = dense[at] != 0
        keys = np.unique(row[used] << np.int64(32) | at[used])
        sums = np.bincount(keys >> 32, dense[keys & 0xFFFFFFFF], minlength=len(part)) + dense[BIAS]
        out += sigmoid(sums).tolist()
    return out


def score(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, over the whole text.

    Null and empty texts have the bias only. Rows that repeat are scored alike, row by row. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast((weights.bits, weights.at, weights.value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        hasher, dense = Hasher(model.value[0]), Weights(*model.value).dense()
        for batch in batches:
            found = scores(hasher, dense, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast((weights.bits, weights.at, weights.value))

    def decider():
        hasher, dense = Hasher(model.value[0]), Weights(*model.value).dense()
        return lambda texts: [s < threshold for s in scores(hasher, dense, texts)]

    return keep_rows(docs, decider)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the rows whose labels are never learned. A null id is not held out."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, settings: FtrlSettings | None = None) -> Weights:
    """Weights from the labels of rows that are not held out. A document labelled more than once is toxic if any says so.

    At most max_fit_rows labels are used, drawn by a hash of the id: a documented bound, and the only sample of this
    operator. It also bounds the table of ids that is broadcast to pick the texts, so no text is exchanged for it.
    """
    s = settings or FtrlSettings()
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("label"))
    )
    share = s.max_fit_rows / max(1, known.count())
    if share < 1:  # cut by the hash, two percent below the bound, so that no sort is needed
        draw = F.pmod(F.xxhash64(F.lit(s.seed), F.lit("fit"), "doc_id"), F.lit(1_000_003))
        known = known.where(draw < int(1_000_003 * share * 0.98))
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return fit(texts.select(F.col("doc_id").alias("id"), "text", "label"), s)


THRESHOLD = 0.3


def op1_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, weights).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
