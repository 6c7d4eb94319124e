import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from revmill.functions import ratings as R
from revmill.operators import counts, evaluation as EV, features, histograms


def scored(spark, n=400, distinct=1000, seed=3):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        y = float(rng.random() < 0.4)
        s = rng.randrange(distinct) / distinct * (0.7 + 0.3 * y)
        data.append((y, float(s >= 0.5), s))
    return spark.createDataFrame(data, "label double, prediction double, score double").repartition(5)


def brute_roc(rows):
    out = []
    for t in sorted({r.score for r in rows}, reverse=True):
        out.append((t, sum(r.label == 1 and r.score >= t for r in rows),
                    sum(r.label == 0 and r.score >= t for r in rows)))
    return out


@pytest.mark.parametrize("per_task", [100_000, 17, 1])
def test_roc_over_any_number_of_ranges(spark, monkeypatch, per_task):
    monkeypatch.setattr(EV, "SCORES_PER_TASK", per_task)
    df = scored(spark)
    want = brute_roc(df.collect())
    got = EV.roc_curve(df).orderBy(F.desc("threshold")).collect()
    assert [(r.threshold, r.tp, r.fp) for r in got] == want
    assert got[-1].tpr == got[-1].fpr == 1.0

    corners = [
        want[i]
        for i in range(len(want))
        if i == len(want) - 1
        or _step(want, i) != _step(want, i + 1)
    ]
    kept = EV.roc_curve(df, drop_collinear=True).orderBy(F.desc("threshold")).collect()
    assert [(r.threshold, r.tp, r.fp) for r in kept] == corners
    assert len(kept) < len(got)


def _step(points, i):
    before = points[i - 1][1:] if i else (0, 0)
    return points[i][1] - before[0], points[i][2] - before[1]


@pytest.mark.parametrize("per_task", [100_000, 40])
def test_auc_equals_the_evaluator(spark, monkeypatch, per_task):
    monkeypatch.setattr(EV, "SCORES_PER_TASK", per_task)
    df = scored(spark, distinct=150)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert EV.auc(df).first().auc == pytest.approx(want, abs=1e-12)


def test_auc_with_one_hot_score(spark):
    """A third of the rows share one score."""
    df = scored(spark, n=600)
    hot = df.limit(300).withColumn("score", F.lit(0.25))
    both = df.unionByName(hot)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(both)
    assert EV.auc(both).first().auc == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert EV.auc(scored(spark).filter("label = 1")).first().auc is None


def test_multiclass_equals_the_evaluator(spark):
    df = scored(spark).withColumn("label", F.col("label") + (F.col("score") > 0.8).cast("double"))
    got = EV.multiclass_metrics(df).first()
    for ours, theirs in [("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")]:
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert got[ours] == pytest.approx(want, abs=1e-10)


def test_confusion_rates_without_hits(spark):
    m = spark.createDataFrame([(5, 2, 3, 0)], "tn long, fp long, fn long, tp long")
    got = EV.confusion_stats(m).first()
    assert (got.f1, got.ppv, got.sensitivity, got.total) == (0.0, 0.0, 0.0, 10)
    empty = spark.createDataFrame([(0, 0, 0, 0)], "tn long, fp long, fn long, tp long")
    assert set(EV.confusion_stats(empty).first()) == {0.0, 0}


GAPS = [
    (0.03, 0.03, "good", "minimal"),
    (0.06, 0.03, "good", "good"),
    (0.09, 0.03, "monitor", "good"),
    (0.12, 0.03, "monitor", "moderate"),
    (0.16, 0.03, "warning", "moderate"),
    (0.16, 0.16, "warning", "high"),
    (-0.20, 0.00, "warning", "moderate"),
]


def test_overfit_rules(spark):
    df = spark.createDataFrame(GAPS, "a double, b double, x string, y string")
    got = df.select(R.overfit_status_a(F.col("a"), F.col("b")), R.overfit_status_b(F.col("a"), F.col("b")))
    assert [tuple(r) for r in got.collect()] == [g[2:] for g in GAPS]


def test_bands(spark):
    data = [(0.95,), (0.90,), (0.80,), (0.70,), (0.6999,)]
    got = spark.createDataFrame(data, "a double").select(R.rating_band(F.col("a"))).collect()
    assert [r[0] for r in got] == ["excellent", "very good", "good", "fair", "poor"]


def test_formats_equal_python(spark):
    rng = random.Random(5)
    xs = [0.0, 0.5, 0.125, 0.375, 40.595, 0.40595, 1.00005, 0.03125, -0.03125, -0.00001, 2.675, 1e9 + 0.00005]
    xs += [rng.uniform(-2, 2) for _ in range(300)] + [round(rng.uniform(-9, 9), 5) for _ in range(700)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    x = F.col("x")
    rows = df.select(x, R.fmt_number(x), R.fmt_signed(x), R.fmt_percent(x), R.fmt_number(x, 2)).collect()
    wrong = [r for r in rows if tuple(r)[1:] != (f"{r.x:.4f}", f"{r.x:+.4f}", f"{r.x * 100:.2f}%", f"{r.x:.2f}")]
    assert wrong == []
    assert spark.range(1).select(R.fmt_thousands(F.lit(1234567))).first()[0] == "1,234,567"


def test_metrics_long(spark):
    doc = spark.createDataFrame(
        [(0.8, 0.95, 0.7, 0.72, 0.6, 0.5, 0.4)],
        "auc double, train_auc double, accuracy double, train_accuracy double, f1 double, precision double, "
        "recall double",
    )
    got = {r.metric: (r.test, r.flag) for r in EV.metrics_long(doc).collect()}
    assert got["AUC-ROC"] == (0.8, "warning") and got["Accuracy"] == (0.7, "ok") and got["Recall"] == (0.4, None)
    assert [r.metric for r in EV.metric_breakdown(doc).collect()] == [
        "Recall", "Precision", "F1 Score", "Accuracy", "AUC-ROC"]


def test_best_by_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "m string, s double")
    assert EV.best_by(df, "m", "s").first().m == "a"


def test_histogram_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (5.0,), (None,), (float("nan"),), (2.9,)], "x double")
    got = histograms.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 1, 0, 1]
    assert (got[0].bin_start, got[-1].bin_end) == (1.0, 5.0)
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.n for r in histograms.histogram(same, "x", 3).orderBy("bin").collect()] == [2, 0, 0]
    assert [r.n for r in histograms.histogram(df, "x", 2, upper=3).orderBy("bin").collect()] == [2, 1]


def test_density_integrates_to_most_of_one(spark):
    df = spark.range(1000).select((F.col("id") % 101).cast("double").alias("x"))
    rows = histograms.kde(df, "x").orderBy("point").collect()
    step = rows[1].x - rows[0].x
    assert len(rows) == 200 and 0.9 < sum(r.density for r in rows) * step < 1.0


def test_shares_and_balance(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    got = {r.c: (r.n, r.share_pct) for r in counts.with_share(counts.value_counts(df, "c")).collect()}
    assert got == {"a": (2, 66.7), "b": (1, 33.3)}
    empty = spark.createDataFrame([], "label double")
    assert counts.class_balance(empty).first().baseline_accuracy == 0.0


def test_tfidf_with_a_term_in_every_row(spark):
    import math

    rows = [(i, ["the"] * 3 + [f"w{i % 10}"]) for i in range(50)] + [(99, [])]
    df = spark.createDataFrame(rows, "id int, words array<string>").repartition(3)
    got = {(r.id, r.term): (r.tf, r.df, r.tfidf) for r in features.tfidf(df, "id", "words", 6).collect()}
    assert got[(7, "the")] == (3, 50, pytest.approx(3 * math.log(52 / 51)))
    assert got[(7, "w7")] == (1, 5, 0.0)
    assert len(got) == 100


def test_category_counts(spark):
    df = spark.createDataFrame([("a, b",), ("b,c",), (None,)], "categories string")
    assert {r.category: r.n for r in counts.category_counts(df, "categories").collect()} == {"a": 1, "b": 2, "c": 1}


@pytest.mark.parametrize("per_task", [100_000, 20])
def test_rows_without_a_score_are_in_no_curve(spark, monkeypatch, per_task):
    """NaN and null alike, with one range of scores and with several."""
    monkeypatch.setattr(EV, "SCORES_PER_TASK", per_task)
    rows = [(float(i % 2), i / 200) for i in range(200)]
    odd = [(1.0, float("nan")), (0.0, float("nan")), (1.0, None)]
    schema = "label double, score double"
    whole = EV.auc(spark.createDataFrame(rows + odd, schema)).first().auc
    assert whole == EV.auc(spark.createDataFrame(rows, schema)).first().auc
