import random

import pytest
from conftest import executed
from pyspark.sql import functions as F
from test_models import corpus

from revmill.operators import cleaning, counts, histograms, limits
from revmill.operators import features as FE
from revmill.plans import analyse
from revmill.plans.views import Views
from revmill.sources import sinks


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def direct(entities, reviews):
    """The tables of eda(), each from the rows themselves."""
    categories = counts.category_counts(entities, "categories")
    stars = counts.value_counts(entities, "stars")
    lengths = reviews.select(F.length("text").alias("chars"))
    return {
        "top_cities": limits.top_k(counts.value_counts(entities, "city"), 10),
        "top_categories": limits.top_k(categories, 10),
        "category_share": counts.with_share(limits.top_k(categories, 5)),
        "star_distribution": stars,
        "star_share": counts.with_share(stars),
        "star_histogram": histograms.histogram(entities, "stars", 9),
        "star_density": histograms.kde(entities, "stars"),
        "review_count_histogram": histograms.histogram(entities, "review_count", 50, upper=500),
        "length_histogram": histograms.histogram(lengths, "chars", 50),
        "top_reviewers": limits.top_k(counts.value_counts(reviews, "user_id"), 5),
    }


def test_tables_from_one_scan_are_those_of_the_rows(spark):
    entities, reviews = corpus(spark)
    null = F.lit(None)
    odd = entities.limit(2).select(
        *(null.cast(f.dataType).alias(f.name) if f.name in ("city", "stars", "categories", "review_count") else f.name
          for f in entities.schema.fields)
    )
    entities = entities.unionByName(odd).unionByName(entities.withColumn("review_count", F.lit(900)))
    reviews = reviews.unionByName(reviews.limit(3).withColumn("text", null.cast("string")).withColumn("user_id", null.cast("string")))
    got, want = analyse.eda(entities, reviews), direct(entities, reviews)
    assert got.keys() == want.keys()
    for name in want:
        assert got[name].dtypes == want[name].dtypes, name
        assert rows_of(got[name]) == rows_of(want[name]), name


def test_empty_tables(spark):
    entities, reviews = corpus(spark)
    got = analyse.eda(entities.limit(0), reviews.limit(0))
    assert got["top_cities"].count() == got["star_density"].count() == 0
    assert {r.n for r in got["star_histogram"].collect()} == {0}


def test_each_input_is_read_once(spark, folder):
    v = Views(spark, folder)
    df = analyse.eda_long(v.counted_entities(), v.reviews().withColumn("user_id", F.col("review_id")))
    plan = executed(df)
    assert plan.count("FileScan parquet") == 3  # part and lineitem for the entities, documents for the reviews
    assert plan.count("Scan ExistingRDD") == 0


def test_observed_counters_are_those_of_the_states(spark):
    rows = [("b", "a fine long review"), ("b", "A fine, long review!"), ("c", "a fine long review"), ("b", "short"), (None, "a fine long review")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, e string, text string")
    for part in (df, df.limit(0)):
        states, seen = cleaning.observe_states(cleaning.review_states(part, "e", "text"))
        staged = spark.createDataFrame(states.collect(), states.schema)
        kept, written = cleaning.observe_rows(cleaning.kept_reviews(staged, "e", ["i"]))
        kept.collect()
        want = cleaning.review_counters(cleaning.review_states(part, "e", "text"), "e").first().asDict()
        assert cleaning.observed_counters(seen, written) == want


def test_an_append_that_stopped_halfway_is_repeated_whole(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    df = spark.range(10)
    assert sinks.read_batches(spark, store, df.schema).count() == 0
    assert sinks.append_batch(df, store, "day 1/2") and not sinks.append_batch(df, store, "day 1/2")
    # Rows without an entry in the manifest are not part of the store.
    spark.range(100, 105).write.parquet(f"{store}/rows/b")
    assert sinks.read_batches(spark, store, df.schema).count() == 10
    assert sinks.append_batch(spark.range(100, 103), store, "b")
    got = sorted(r.id for r in sinks.read_batches(spark, store, df.schema).collect())
    assert got == [*range(10), 100, 101, 102]
    assert {(r.batch, r.n) for r in sinks.read_manifest(spark, store).collect()} == {("day 1/2", 10), ("b", 3)}
    assert sinks.append_batch(spark.range(0), store, "none")
    assert sinks.read_batches(spark, store, df.schema).count() == 13


def test_embedding_by_join(spark):
    rows = [(1, ["a", "b", "a"]), (2, ["x"]), (3, []), (4, ["b", "x"])]
    words = spark.createDataFrame(rows, "k int, words array<string>")
    from pyspark.ml.linalg import Vectors

    vectors = spark.createDataFrame([("a", Vectors.dense([1.0, 0.0])), ("b", Vectors.dense([4.0, 2.0]))], ["word", "vector"])
    got = {r.k: r.embedding for r in FE.embed(words, "k", "words", vectors).collect()}
    assert got[1] == pytest.approx([2.0, 2 / 3]) and got[4] == pytest.approx([2.0, 1.0])
    assert got[2] == got[3] == []


def test_embedding_by_broadcast_and_by_join_agree(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    rows = [(i, [f"w{(i * j) % 17}" for j in range(i % 9)]) for i in range(300)]
    words = spark.createDataFrame(rows, "k int, words array<string>")
    vectors = spark.createDataFrame([(f"w{i}", Vectors.dense([float(i), 1.0 / (i + 1)])) for i in range(15)], ["word", "vector"])
    small = FE.embed(words, "k", "words", vectors)
    assert "ObjectHashAggregate" not in executed(small) and "BroadcastHashJoin [term" in executed(small)
    monkeypatch.setattr(FE, "MAX_BROADCAST_NUMBERS", 0)
    large = {r.k: r.embedding for r in FE.embed(words, "k", "words", vectors).collect()}
    got = {r.k: r.embedding for r in small.collect()}
    assert len(got) == 300 and all(got[k] == pytest.approx(large[k], abs=1e-12) for k in got)


def test_embedding_is_fitted_in_parts(spark, monkeypatch):
    """Large tables are fitted by several tasks, small ones by one, and words of one subject still lie together."""
    subjects = [[f"{s}{i}" for i in range(6)] for s in "xy"]
    rng = random.Random(3)
    rows = [(i, [rng.choice(subjects[i % 2]) for _ in range(11)]) for i in range(1200)]
    words = spark.createDataFrame(rows, "k int, words array<string>")
    assert FE.fit_parts(words, "words") == 1 and FE.fit_parts(words.limit(0), "words") == 1
    monkeypatch.setattr(FE, "WORDS_PER_PART", 5_000)
    assert FE.fit_parts(words, "words") == 2
    monkeypatch.setattr(FE, "WORDS_PER_PART", 100)
    assert FE.fit_parts(words, "words") == spark.sparkContext.defaultParallelism
    stage = FE.embedding_stages(8, parts=FE.fit_parts(words, "words"))[-1]
    assert stage.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    v = {r.word: r.vector.toArray() for r in stage.setMaxIter(20).fit(words).getVectors().collect()}
    assert set(v) == {w for s in subjects for w in s}

    def near(a, b):
        return float(a @ b / ((a @ a) * (b @ b)) ** 0.5)

    same = [near(v[a], v[b]) for s in subjects for a in s for b in s if a < b]
    other = [near(v[a], v[b]) for a in subjects[0] for b in subjects[1]]
    assert min(same) > max(other)
