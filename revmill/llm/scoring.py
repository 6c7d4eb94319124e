"""Language-model scoring by cross-entropy difference.

A target and a background bigram model share one vocabulary and one smoothing, and differ only in the documents they are
counted over. A document's score is the mean, over its tokens, of its loss under the target model minus its loss under
the background model: the lower, the more it is like the target.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmill.llm.shelf import give_back, remove, short_lived_shuffles, small_batches, stage, table, text_or_empty

SIGN = re.compile(r"([^\w\s])")  # a token of its own
BROADCAST_IDS = 2_000_000  # target ids up to this many, 16 MB, go to the tasks; more are joined with the texts
SAMPLE = 20_000  # documents in which frequent words and bigrams are looked for; counts are over all documents
HEAD = 400_000  # bigrams frequent in the sample, which every task counts and scores; the others are exchanged
HEAD_WORDS = 400_000  # words frequent in the sample, which every task numbers and counts; the others are joined
BATCH_BYTES = 2 << 20  # of texts that a task is handed at once
START_ID, END_ID, UNKNOWN_ID, FIRST_ID = 0, 1, 2, 3  # numbers of words go on from there
START, END = np.array([START_ID]), np.array([END_ID])


@dataclass(frozen=True)
class LmSettings:
    """vocabulary None keeps every word; a number keeps the most frequent words and takes the others as one."""

    vocabulary: int | None = None
    bigram_weight: float = 0.7
    add: float = 0.5
    flush: int = 400_000  # distinct words a task counts before it hands them on
    chunk: int = 1_000_000  # tokens, or bigrams, that a task works on at once


def tokens(text: str) -> list[str]:
    return " ".join(SIGN.split(text.lower())).split()


def word_counts(docs: DataFrame, settings: LmSettings) -> DataFrame:
    """(word, every, target): counts over every word of every text, and of those with target; tasks add up first."""
    names = ["word", "every", "target"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter = Counter()
        good: Counter = Counter()

        def out():
            words = list(every)
            columns = [pa.array(words, pa.string())]
            columns += [pa.array([held[w] for w in words], pa.int64()) for held in (every, good)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for text, target in zip(batch.column("text"), batch.column("target").to_pylist()):
                found = tokens(text.as_py())
                every.update(found)
                if target:
                    good.update(found)
                if len(every) > settings.flush:
                    yield out()
                    every.clear()
                    good.clear()
        if every:
            yield out()

    rows = docs.select(text_or_empty().alias("text"), "target").mapInArrow(run, "word string, every long, target long")
    return rows.groupBy("word").agg(F.sum("every").alias("every"), F.sum("target").alias("target"))


def vocabulary(docs: DataFrame, settings: LmSettings) -> list[str]:
    """The most frequent words of all documents, ties in order of the word; counts cover every word of every text."""
    counts = word_counts(docs.withColumn("target", F.lit(False)), settings)
    return [r["word"] for r in counts.orderBy(F.desc("every"), "word").limit(settings.vocabulary).collect()]


class Numbers(dict):
    """The number of each frequent word; others have UNKNOWN_ID in a closed vocabulary, else a negative 64-bit hash."""

    def __init__(self, words: list[str], closed: bool):
        super().__init__(zip(words, range(FIRST_ID, FIRST_ID + len(words))))
        self.closed, self.most = closed, len(words) + 200_000

    def __missing__(self, word: str) -> int:
        number = UNKNOWN_ID if self.closed else (xxhash.xxh64_intdigest(word.encode(), 42) | 1 << 63) - (1 << 64)
        if len(self) < self.most:
            self[word] = number
        return number


def rare_number(word: str) -> Column:
    return F.xxhash64(word).bitwiseOR(F.lit(-(1 << 63)))


@dataclass(frozen=True)
class Words:
    """One vocabulary with its counts. every[i] and target[i] belong to number i of the frequent words and the marks: as
    every token but the end is a context once, a count is that of the word and of the context alike."""

    names: list[str]
    closed: bool
    every: np.ndarray
    target: np.ndarray
    rare: DataFrame | None  # (number, every, target) of all other words
    totals: dict[str, int]
    size: int


# Rows of documents, and beside them the counts a task makes: of a number, of a frequent bigram's place, of a rare word.
ENCODED = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("own", pa.bool_()),
        ("ids", pa.binary()),  # numbers of the words, 32 bits each, rare ones -1
        ("hits", pa.binary()),  # a bit for each bigram, set for the frequent ones
        ("rare", pa.binary()),  # both numbers of each bigram with a rare word, 64 bits each
        ("number", pa.int64()), ("head", pa.int64()), ("word", pa.string()), ("every", pa.int64()), ("target", pa.int64()),
    ]
)
ENCODED_DDL = (
    "row long, doc_id long, own boolean, ids binary, hits binary, rare binary, number long, head long, word string, "
    "every long, target long"
)


def encoded_rows(**columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in ENCODED], schema=ENCODED
    )


def sampled_words(sample: DataFrame, settings: LmSettings) -> list[str]:
    """The most frequent of the words that occur twice or more in the sample."""
    counts = word_counts(sample, settings).where("every > 1").orderBy(F.desc("every"), "word").limit(HEAD_WORDS)
    return counts.select("word").toArrow().column("word").to_pylist()


def sampled_bigrams(sample: DataFrame, names: list[str], closed: bool, settings: LmSettings) -> np.ndarray:
    """Keys, in order, of up to HEAD bigrams of frequent words, the most frequent of the sample."""
    shared = sample.sparkSession.sparkContext.broadcast((names, closed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(*shared.value)
        for _, _, _, a, b in numbered(batches, numbers, settings.chunk):
            keys, n = np.unique((a << 32 | b)[(a >= 0) & (b >= 0)], return_counts=True)
            yield from pa.table({"key": keys, "every": n.astype(np.int64)}).to_batches(50_000)

    sums = sample.select("text").mapInArrow(run, "key long, every long").groupBy("key").agg(F.sum("every").alias("every"))
    found = stage(sums.where("every > 1"), "lm-sampled")
    keys = most_frequent(found, HEAD).select("key").toArrow().column("key").to_numpy()
    remove(found)
    return np.sort(keys)


def numbered(batches: Iterator[pa.RecordBatch], numbers: Numbers, chunk: int) -> Iterator[tuple]:
    """Rows of about `chunk` tokens at a time: (batch of rows, rare words of each row, number of its bigrams, first, second
    number of each)."""
    for whole in batches:
        start = 0
        while start < whole.num_rows:
            a, b, rare, sizes, held = [], [], [], [], 0
            end = start
            while end < whole.num_rows and held < chunk:
                words = tokens(whole.column("text")[end].as_py())
                own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                a += [START, own]
                b += [own, END]
                rare.append([words[i] for i in np.flatnonzero(own < 0)])
                sizes.append(len(words) + 1)
                held += len(words) + 1
                end += 1
            yield whole.slice(start, end - start), rare, sizes, np.concatenate(a), np.concatenate(b)
            start = end


def places(keys: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each key among the frequent ones, whether it is one of them)"""
    if not len(heads):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    order = np.argsort(keys)  # in order, they are found several times faster
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(heads, keys[order]), len(heads) - 1)
    return at, heads[at] == keys


def encoded(rows: DataFrame, names: list[str], closed: bool, heads: np.ndarray, settings: LmSettings) -> DataFrame:
    """The rows (doc_id, text, target) as numbers, each with a row number of its own, and what the tasks counted."""
    shared = rows.sparkSession.sparkContext.broadcast((names, closed, heads))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, closed, heads = shared.value
        numbers, row = Numbers(names, closed), TaskContext.get().partitionId() << 33
        sums = {"number": np.zeros((2, FIRST_ID + len(names)), np.int64), "head": np.zeros((2, len(heads)), np.int64)}
        rare: tuple[Counter, Counter] = Counter(), Counter()

        def hand_on():
            words = list(rare[0] | rare[1])
            every, target = ([sum(c[w] for c in held) for w in words] for held in (rare, rare[1:]))
            for held in rare:
                held.clear()
            return encoded_rows(word=words, every=every, target=target)

        for batch, words, sizes, a, b in numbered(batches, numbers, settings.chunk):
            place = np.repeat(np.arange(batch.num_rows), sizes)
            own = batch.column("target").to_numpy(zero_copy_only=False)
            common = (a >= 0) & (b >= 0)
            at, hit = places(a << 32 | b, heads)
            hit &= common
            for kind, values, of in (("number", a[a >= 0], place[a >= 0]), ("head", at[hit], place[hit])):
                for held, chosen in zip(sums[kind], (values, values[own[of]])):
                    held += np.bincount(chosen, minlength=len(held))
            short = np.maximum(b, -1).astype(np.int32)
            ids, hits, pairs = [], [], []
            for end, size, found, target in zip(np.cumsum(sizes), sizes, words, own):
                part = slice(end - size, end)
                ids.append(short[end - size : end - 1].tobytes())
                hits.append(np.packbits(hit[part]).tobytes())
                few = np.flatnonzero(~common[part])
                pairs.append(np.column_stack([a[part][few], b[part][few]]).tobytes())
                rare[int(target)].update(found)
            numbers_of_rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield from pa.Table.from_batches(
                [encoded_rows(row=numbers_of_rows, doc_id=batch.column("doc_id"), own=own, ids=ids, hits=hits, rare=pairs)]
            ).to_batches(2_000)
            if len(rare[0]) + len(rare[1]) > settings.flush:
                yield hand_on()
        if rare[0] or rare[1]:
            yield hand_on()
        for kind, (every, target) in sums.items():
            at = np.flatnonzero(every)
            if len(at):
                counted = encoded_rows(**{kind: at, "every": every[at], "target": target[at]})
                yield from pa.Table.from_batches([counted]).to_batches(50_000)
        give_back()

    return stage(rows.select("doc_id", "text", "target").mapInArrow(run, ENCODED_DDL), "lm-encoded")


def summed(table: DataFrame, kind: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """What all tasks counted of the numbers, or of the places, 0 to size - 1: (every, target)."""
    sums = table.where(F.col(kind).isNotNull()).groupBy(kind).agg(F.sum("every").alias("every"), F.sum("target").alias("target"))
    found = sums.toArrow()
    out = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for held, c in zip(out, ("every", "target")):
        held[found.column(kind).to_numpy()] = found.column(c).to_numpy()
    return out


def count_words(table: DataFrame, names: list[str], closed: bool) -> tuple[Words, list[str]]:
    """The vocabulary of an encoded table, and the rare words whose hash meets that of another word."""
    every, target = summed(table, "number", FIRST_ID + len(names))
    every[END_ID], target[END_ID] = every[START_ID], target[START_ID]
    totals = {"every": every.sum() - every[START_ID], "target": target.sum() - target[START_ID]}
    found = table.where("word IS NOT NULL").groupBy("word").agg(F.sum("every").alias("every"), F.sum("target").alias("target"))
    rare = stage(found.withColumn("number", rare_number("word")), "lm-words")
    whole = rare.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals), F.count("*").alias("n")).first()
    met = rare.groupBy("number").agg(F.count("*").alias("n"), F.collect_list("word").alias("w")).where("n > 1")
    met = [w for r in met.collect() for w in r["w"]]  # about V ** 2 / 2 ** 64 of V words: none below 10 ** 9
    totals = {c: int(n + whole[c]) for c, n in totals.items()}
    size = len(names) + FIRST_ID + whole["n"]
    return Words(names, closed, every, target, rare.drop("word") if whole["n"] else None, totals, size), met


def whole_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows that are sorted by the first, about `most` rows at a time, but no key in two of them."""
    held, size, bound = [], 0, most
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size >= bound:
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = np.searchsorted(columns[0], columns[0][-1])
            if cut:
                yield [c[:cut] for c in columns]
            held, size = [[c[cut:] for c in columns]], size - cut
            bound = max(most, 2 * size)
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def numbers_in(ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and second number of each bigram of a row."""
    own = np.frombuffer(ids, np.int32).astype(np.int64)
    return np.concatenate([START, own]), np.concatenate([own, END])


def bigrams_between(table: DataFrame) -> DataFrame:
    """(key, row, own, n) of the bigrams of each row that have no rare word and are not among the frequent ones."""
    names = ["key", "row", "own", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for ids, hits in zip(batch.column("ids").to_pylist(), batch.column("hits").to_pylist()):
                a, b = numbers_in(ids)
                left = np.unpackbits(np.frombuffer(hits, np.uint8), count=len(a)) == 0
                found.append(np.unique((a << 32 | b)[left & (a >= 0) & (b >= 0)], return_counts=True))
                sizes.append(len(found[-1][0]))
            if sum(sizes):
                at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
                keys, n = (np.concatenate(c) for c in zip(*found))
                columns = [pa.array(keys), batch.column("row").take(at), batch.column("own").take(at), pa.array(n.astype(np.int32))]
                yield from pa.Table.from_arrays(columns, names=names).to_batches(50_000)

    rows = table.where("row IS NOT NULL").select("row", "own", "ids", "hits")
    return rows.mapInArrow(run, "key long, row long, own boolean, n int")


def rare_bigrams(table: DataFrame, both: bool) -> DataFrame:
    """(a, b, row, own, n) of the bigrams of each row that have one rare word, or two."""
    names = ["a", "b", "row", "own", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = []
            for held in batch.column("rare").to_pylist():
                pairs = np.frombuffer(held, np.int64).reshape(-1, 2)
                counted.append(Counter(map(tuple, pairs[(pairs < 0).all(axis=1) == both].tolist())))
            at = pa.array(np.repeat(np.arange(batch.num_rows), [len(c) for c in counted]))
            a, b = np.array([p for c in counted for p in c], np.int64).reshape(-1, 2).T
            n = pa.array([k for c in counted for k in c.values()], pa.int32())
            columns = [pa.array(a), pa.array(b), batch.column("row").take(at), batch.column("own").take(at), n]
            yield from pa.Table.from_arrays(columns, names=names).to_batches(50_000)

    rows = table.where("row IS NOT NULL AND length(rare) > 0").select("row", "own", "rare")
    return rows.mapInArrow(run, "a long, b long, row long, own boolean, n int")


def loss(n, seen, following, total: int, size: int, s: LmSettings, log: Callable, choose: Callable):
    """Nats of a bigram counted n times: interpolated with its second word; by that alone if the context was never seen.

    The same formula for columns and for arrays, which differ in log and choose(condition, then, otherwise).
    """
    chance = (following + s.add) * (1.0 / (total + s.add * size))
    return -log(choose(seen > 0, s.bigram_weight * n / choose(seen > 0, seen, 1) + (1 - s.bigram_weight) * chance, chance))


def with_counts(pairs: DataFrame, words: Words, keys: tuple[str, str] | None = None) -> DataFrame:
    """The rows (a, b, ...) with c_every, c_target of the first and n_every, n_target of the second word.

    Frequent words, or those of the closed vocabulary, are looked up by their number in the tasks; the others are joined.
    `keys` names columns that hold a, or b, wherever it is rare; what they hold elsewhere is not read.
    """
    shared = pairs.sparkSession.sparkContext.broadcast((words.every, words.target))
    names = [f"{c}_{model}" for c in ("c", "n") for model in ("every", "target")]
    given, kept = pairs.columns, [f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema]
    if words.rare is not None:
        if keys is None:
            # Frequent words meet nothing here; a key of their own for each row keeps them from one task.
            keys = ("_a", "_b")
            for key in keys:
                own = F.col(key[1:])
                pairs = pairs.withColumn(key, F.when(own < 0, own).otherwise(F.abs(F.xxhash64(*given) % (1 << 62))))
        for key in dict.fromkeys(keys):
            pairs = pairs.join(
                words.rare.select(F.col("number").alias(key), *(F.col(c).alias(f"{key}_{c}") for c in ("every", "target"))), key, "left"
            )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in given]
            for own, key in zip(("a", "b"), keys or (None, None)):
                number = batch.column(own).to_numpy()
                for held, model in zip(shared.value, ("every", "target")):
                    found = held[np.maximum(number, 0)]
                    if key is not None:
                        found = np.where(number < 0, batch.column(f"{key}_{model}").fill_null(0).to_numpy(), found)
                    columns.append(pa.array(found))
            yield pa.RecordBatch.from_arrays(columns, names=[*given, *names])

    if words.rare is None:
        keys = None
    return pairs.mapInArrow(look_up, ", ".join([*kept, *(f"{n} long" for n in names)]))


def most_frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows whose count reaches a bound that at most `most` rows reach; none is left out by order."""
    step = F.floor(F.log2("every") * 16).alias("step")
    found = sorted(table.groupBy(step).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"])
    least, total = None, 0
    for r in found:
        total += r["n"]
        if total > most:
            break
        least = r["step"]
    return table.where(F.lit(False) if least is None else F.floor(F.log2("every") * 16) >= least)


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, settings: LmSettings | None = None) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every document, over its whole text.

    The target is what target_ids (doc_id) names; the background is all documents. Both models are counted over all
    of their documents and share the vocabulary and the smoothing. A null or empty text has one token, its end. Rows that
    repeat are counted and scored row by row; a null id is never in the target; without a target the target model is
    uniform. Other columns are not read. The counts are exact and grow with the input.

    Texts are read once into numbers. Which words and bigrams are taken as frequent comes from a sample and changes no
    result: tasks count those where they stand. Each row's other bigrams are exchanged once, counted where all of one kind
    meet, and come back as sums of the row. Those with a rare word are few; the counts of their words are joined.
    """
    spark = docs.sparkSession
    with small_batches(spark, BATCH_BYTES), short_lived_shuffles(spark):
        return _differences(docs, target_ids, settings or LmSettings())


def _differences(docs: DataFrame, target_ids: DataFrame, s: LmSettings) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    named = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    few = named.count() <= BROADCAST_IDS
    named = named.withColumn("target", F.lit(True))
    rows = rows.join(F.broadcast(named) if few else named, "doc_id", "left")
    rows = rows.select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    rows = rows if few else stage(rows, "lm-rows")
    closed = s.vocabulary is not None
    sample = stage(rows.sample(min(1.0, SAMPLE / max(rows.count(), 1)), seed=1), "lm-sample")
    names = vocabulary(docs, s) if closed else sampled_words(sample, s)
    heads = sampled_bigrams(sample, names, closed, s)
    remove(sample)
    table = encoded(rows, names, closed, heads, s)
    words, met = count_words(table, names, closed)
    if met:  # rare words that share a number are numbered like frequent ones
        remove(table)
        table = encoded(rows, names + met, closed, heads, s)
        words, _ = count_words(table, names + met, closed)
    shared = spark.sparkContext.broadcast((words.every, words.target, words.totals, words.size))
    counted = spark.sparkContext.broadcast((heads, *summed(table, "head", len(heads))))

    def losses(keys, every, target):
        c_every, c_target, totals, size = shared.value
        a, b = keys >> 32, keys & 0xFFFFFFFF
        return [
            loss(n, c[a], c[b], totals[model], size, s, np.log, np.where)
            for n, c, model in ((target, c_target, "target"), (every, c_every, "every"))
        ]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, row, own, n in whole_groups(batches, 200_000):
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(first, append=len(key))
            every, target = (np.add.reduceat(x, first, dtype=np.int64) for x in (n, n * own))
            sums = [pa.array(np.repeat(x, sizes) * n) for x in losses(key[first], every, target)]
            yield from pa.Table.from_arrays([pa.array(row), *sums], names=["row", "t", "e"]).to_batches(50_000)
        give_back()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, every, target = counted.value
        best = losses(heads, every, target)
        for batch in batches:
            keys, sizes, found = [], [], []
            for ids, hits in zip(batch.column("ids").to_pylist(), batch.column("hits").to_pylist()):
                a, b = numbers_in(ids)
                hit = np.flatnonzero(np.unpackbits(np.frombuffer(hits, np.uint8), count=len(a)))
                keys.append(a[hit] << 32 | b[hit])
                sizes.append(len(a))
                found.append(len(hit))
            at, _ = places(np.concatenate([*keys, np.empty(0, np.int64)]), heads)
            place = np.repeat(np.arange(batch.num_rows), found)
            sums = [np.bincount(place, x[at] if len(at) else None, batch.num_rows).astype(float) for x in best]
            columns = [batch.column("row"), batch.column("doc_id"), *map(pa.array, (sizes, *sums))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_tokens", "t", "e"])
        give_back()

    parts = bigrams_between(table).repartition("key").sortWithinPartitions("key").mapInArrow(add_up, "row long, t double, e double")
    if words.rare is not None:

        def column_loss(model):
            return loss(
                F.col(model), F.col(f"c_{model}"), F.col(f"n_{model}"), words.totals[model], words.size, s, F.log,
                lambda test, then, other: F.when(test, then).otherwise(other),
            ) * F.col("n")

        def rare_losses(both: bool) -> DataFrame:
            group = Window.partitionBy("word", "a", "b")  # one exchange by a rare word serves its counts too
            pairs = rare_bigrams(table, both).withColumn("word", F.when(F.col("a") < 0, F.col("a")).otherwise(F.col("b")))
            pairs = pairs.repartition("word").select(
                "word", "a", "b", "row", "n", F.sum("n").over(group).alias("every"),
                F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)).over(group).alias("target"),
            )
            pairs = with_counts(pairs, words, ("word", "b") if both else ("word", "word"))
            return pairs.select("row", column_loss("target").alias("t"), column_loss("every").alias("e"))

        pairs = rare_losses(False).unionByName(rare_losses(True))
        # Written by itself, so that its exchanges are gone when the larger one is made.
        parts = parts.unionByName(stage(pairs.groupBy("row").agg(F.sum("t").alias("t"), F.sum("e").alias("e")), "lm-rare"))
    base = table.where("row IS NOT NULL").select("row", "doc_id", "ids", "hits")
    base = base.mapInArrow(score, "row long, doc_id long, n_tokens long, t double, e double")
    sums = base.unionByName(parts, allowMissingColumns=True).groupBy("row")
    sums = sums.agg(*(F.max(c).alias(c) for c in ("doc_id", "n_tokens")), *(F.sum(c).alias(c) for c in ("t", "e")))
    sums = stage(sums, "lm-sums")
    remove(table)
    return sums.select(
        "doc_id", "n_tokens", (F.col("t") / F.col("n_tokens")).alias("target_loss"),
        (F.col("e") / F.col("n_tokens")).alias("background_loss"),
    ).withColumn("score", F.col("target_loss") - F.col("background_loss"))


def op10_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored against the documents labelled as good."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)
