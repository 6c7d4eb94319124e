import json

import pytest

from revmill import schemas
from revmill.config import ReviewConfig
from revmill.plans.load import load, load_table
from revmill.plans.prepare import prepare
from revmill.plans.run import run_all, run_stages
from revmill.sources import files
from test_models import candidates

CFG = ReviewConfig(word_buckets=64, bigram_buckets=32)


def raw_files(tmp_path):
    good = ["lovely", "great", "tasty", "friendly", "warm"]
    bad = ["awful", "cold", "rude", "slow", "stale"]
    business, review = [], []
    for i in range(8):
        business.append({"business_id": f"b{i}", "name": f"n{i}", "address": "a", "city": f"c{i % 3}", "state": "s",
                         "postal_code": "p", "latitude": 30.0 + i, "longitude": -80.0, "stars": 4.5 if i % 2 else 2.0,
                         "review_count": 60 + i, "is_open": 1, "categories": "Food, Bars,food",
                         "attributes": {"x": "y"}, "hours": {"Monday": "9-5"}})
    business += [{"business_id": "b1", "stars": 3.0, "categories": "Food"},
                 {"business_id": "b9", "stars": "4.5", "categories": "Food"},
                 {"business_id": "b10", "stars": 4, "categories": "Food", "latitude": "unknown"}]
    for i in range(200):
        words = good if i % 2 else bad
        review.append({"review_id": f"r{i}", "user_id": f"u{i % 7}", "business_id": f"b{i % 8}", "stars": 4.0,
                       "useful": "many" if i == 3 else i % 5, "funny": 0, "cool": 0, "date": "2024-01-01 00:00:00",
                       "text": f"{words[i % 5].upper()} place, with {words[(i * 3) % 5]} food number {i}!"})
    review.insert(50, dict(review[2], review_id="copy"))
    review.insert(60, dict(review[0], review_id="brief", text="no"))
    lines = [json.dumps(r) for r in review]
    lines.insert(20, "{broken")
    lines.insert(30, "")
    b, r = tmp_path / "business.json", tmp_path / "review.json"
    b.write_text("\n".join(map(json.dumps, business)) + "\nnot json\n")
    r.write_text("\n".join(lines) + "\n")
    return str(b), str(r)


def document(spark, path):
    return json.loads(next(iter(spark.read.text(path).collect())).value)


def test_prepare(spark, tmp_path):
    business, review = raw_files(tmp_path)
    out = str(tmp_path / "out")
    paths = prepare(spark, business, review, out, ReviewConfig(sample_rows=50))
    quality, summary = document(spark, paths.quality), document(spark, paths.summary)
    assert quality["business"] == {"records_written": 9, "dropped_duplicate_id": 1, "dropped_invalid": 2}
    assert quality["review_full"] == {"records_written": 200, "dropped_malformed_json": 1,
                                      "dropped_empty_short": 1, "dropped_duplicate": 1}
    assert summary == {"cleaning_version": "2.1", "n_businesses": 9, "n_reviews_full": 200, "fast_mode": False,
                       "n_reviews_small": 50}
    kept = {r.business_id: r for r in spark.read.json(paths.entities).collect()}
    assert kept["b1"].categories == "food, bars" and kept["b1"].attributes.x == "y"
    assert kept["b10"].latitude is None
    rows = {r.review_id: r for r in spark.read.json(paths.reviews).collect()}
    assert "copy" not in rows and rows["r1"].text == "great place with friendly food number 1"
    assert rows["r3"].useful is None and rows["r3"].useful_raw == "many" and rows["r4"].useful == 4


def test_prepare_fast_stops_at_the_full_sample(spark, tmp_path):
    business, review = raw_files(tmp_path)
    cfg = ReviewConfig(sample_rows=100, raw_cap=150)
    paths = prepare(spark, business, review, str(tmp_path / "out"), cfg, fast=True)
    assert paths.reviews is None
    quality, summary = document(spark, paths.quality), document(spark, paths.summary)
    assert quality["review_full"] == {"records_written": 100, "dropped_malformed_json": 1, "dropped_empty_short": 1,
                                      "dropped_duplicate": 1, "raw_lines_scanned": 103}
    assert summary["n_reviews_full"] is None and summary["fast_mode"] is True
    short = prepare(spark, business, review, str(tmp_path / "o2"), ReviewConfig(raw_cap=40), fast=True)
    assert document(spark, short.quality)["review_full"]["records_written"] == 39
    assert document(spark, short.quality)["review_full"]["raw_lines_scanned"] == 40


def test_prepare_without_reviews(spark, tmp_path):
    business, _ = raw_files(tmp_path)
    paths = prepare(spark, business, str(tmp_path / "none"), str(tmp_path / "out"))
    assert paths.reviews is None and paths.sample is None
    assert document(spark, paths.summary)["n_reviews_full"] is None


def test_whole_run(spark, tmp_path):
    business, review = raw_files(tmp_path)
    out = str(tmp_path / "out")
    assert run_all(spark, business, review, out, CFG, candidates()) == []
    assert files.load_metrics(spark, f"{out}/model_metrics").first().dataset_size > 100
    assert spark.read.parquet(f"{out}/report/metrics_long").count() == 5
    assert spark.read.parquet(f"{out}/eda/star_histogram").count() == 9
    verdict = spark.read.parquet(f"{out}/report/verdicts").first()
    assert verdict.accuracy.endswith("%") and verdict.status_a in ("good", "monitor", "warning")
    assert files.path_exists(spark, f"{out}/best_model/metadata")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_sample_is_the_first_clean_rows(spark, tmp_path, parts):
    """Whatever the shuffle, the sample holds the first rows of the input that are kept."""
    business, review = raw_files(tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        paths = prepare(spark, business, review, str(tmp_path / "out"), ReviewConfig(sample_rows=50))
        assert {r.review_id for r in spark.read.json(paths.sample).collect()} == {f"r{i}" for i in range(50)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_analysis_covers_all_reviews(spark, tmp_path):
    business, review = raw_files(tmp_path)
    out = str(tmp_path / "out")
    cfg = ReviewConfig(sample_rows=10, word_buckets=64, bigram_buckets=32)
    try:
        assert run_all(spark, business, review, out, cfg, candidates(), store=("t_store_b", "t_store_r")) == []
        assert spark.table("t_store_r").count() == 199  # r3 has no readable count
        assert "latitude" not in spark.table("t_store_b").columns
    finally:
        spark.sql("DROP TABLE IF EXISTS t_store_b")
        spark.sql("DROP TABLE IF EXISTS t_store_r")
    assert spark.read.json(f"{out}/review_small").count() == 10
    lengths = spark.read.parquet(f"{out}/eda/length_histogram")
    assert lengths.agg({"n": "sum"}).first()[0] == 200
    balance = spark.read.parquet(f"{out}/report/class_balance").first()
    assert balance.raw_dataset_size == 200
    best = [r for r in spark.read.parquet(f"{out}/report/model_comparison").collect() if r.is_best]
    assert len(best) == 1
    rates = spark.read.parquet(f"{out}/report/confusion_rates").first()
    assert rates.total == files.load_metrics(spark, f"{out}/model_metrics").first().test_size
    assert spark.read.parquet(f"{out}/report/tuned_parameters").count() >= 1


def test_load_counts_every_line(spark, tmp_path):
    """Broken and unreadable lines are skipped, lines without a key are a count of their own, 4.0 is an integer."""
    lines = ['{"review_id": "a", "useful": 4.0}', '{"review_id": "b", "useful": "4.0"}', "{broken", '{"review_id": ""}',
             '{"review_id": "c", "useful": null}', '{"review_id": "d", "useful": true, "stars": "2.5"}', '{"useful": 1}']
    path = tmp_path / "r.json"
    path.write_text("\n".join(lines) + "\n")
    try:
        done = load_table(spark, str(path), "t_lines", schemas.REVIEW_STORE, "review_id")
        assert (done.rows, done.skipped, done.keyless) == (2, 3, 2)
        assert {r.review_id: (r.useful, r.stars) for r in spark.table("t_lines").collect()} == {"a": (4, 0.0), "d": (1, 2.5)}
        narrow = load_table(spark, str(path), "t_lines", schemas.REVIEW_STORE, "review_id", null_skips=False)
        assert (narrow.rows, narrow.skipped, narrow.keyless) == (3, 2, 2)
    finally:
        spark.sql("DROP TABLE IF EXISTS t_lines")


def test_a_failed_stage_does_not_stop_the_run(spark, tmp_path):
    seen = []
    failed = run_stages([("a", lambda: 1 / 0), ("b", lambda: seen.append("b"))])
    assert failed == ["a"] and seen == ["b"]
    missing = str(tmp_path / "none")
    assert "prepare" in run_all(spark, missing, missing, str(tmp_path / "out"), CFG, candidates())


def test_load(spark, tmp_path):
    business, review = raw_files(tmp_path)
    try:
        counts = {r.table_name: r.n for r in load(spark, business, review, "t_b", "t_r").collect()}
        # b1 comes twice and b9 quotes its stars; b10 has an unreadable latitude and r3 an unreadable count.
        assert counts == {"t_b": 9, "t_r": 201}
        b1 = spark.table("t_b").filter("business_id = 'b1'").first()
        assert (b1.stars, b1.city, b1.review_count) == (3.0, "", 0)
        assert spark.table("t_r").filter("review_id = 'r3'").count() == 0

        extra = tmp_path / "more.json"
        extra.write_text(json.dumps({"review_id": "r1", "business_id": "b2", "text": "z" * 6000}) + "\n")
        more = load_table(spark, str(extra), "t_r", schemas.REVIEW_STORE, "review_id", recreate=False)
        assert (more.rows, more.skipped) == (1, 0)
        r1 = spark.table("t_r").filter("review_id = 'r1'").first()
        assert (r1.business_id, r1.stars, len(r1.text)) == ("b2", 0.0, 5015)
        assert r1.text.endswith("... [truncated]") and spark.table("t_r").count() == 201

        small = load(spark, business, review, "t_nb", "t_nr", narrow=True, review_limit=10)
        assert {r.table_name: r.n for r in small.collect()} == {"t_nb": 10, "t_nr": 10}
        assert spark.table("t_nr").columns == ["review_id", "business_id", "user_id", "stars", "text"]
    finally:
        for t in ("t_b", "t_r", "t_nb", "t_nr"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def _category_idf(spark, entities):
    from types import SimpleNamespace

    from revmill.plans.catalog_jobs import category_idf

    return {r.term: r.idf for r in category_idf(SimpleNamespace(spark=spark, entities=lambda: entities)).collect()}


def test_category_idf_has_every_term(spark):
    """More terms than the vocabulary of 262,144 that a fitted stage was given."""
    from pyspark.sql import functions as F

    terms = F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.concat(F.lit("t"), F.col("id") * 1000 + k))
    entities = spark.range(270).select(F.array_join(terms, ", ").alias("categories"))
    assert len(_category_idf(spark, entities)) == 270_000


def test_category_idf_is_what_the_stages_fit(spark, folder):
    from pyspark.ml.feature import IDF, CountVectorizer
    from pyspark.sql import functions as F

    from revmill.plans.catalog_jobs import X
    from revmill.plans.views import Views

    entities = Views(spark, folder).entities()
    items = entities.select(X.category_array(F.col("categories")).alias("items"))
    counter = CountVectorizer(inputCol="items", outputCol="counts", vocabSize=1 << 30).fit(items)
    idf = IDF(inputCol="counts", outputCol="tfidf").fit(counter.transform(items)).idf.toArray()
    got = _category_idf(spark, entities)
    assert got.keys() == set(counter.vocabulary)
    assert all(abs(got[t] - x) < 1e-6 for t, x in zip(counter.vocabulary, idf))
