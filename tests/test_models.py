import pytest
from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.operators import models as M
from revmill.operators.features import embedding_stages, feature_stages
from revmill.plans.analyse import analyse, eda
from revmill.plans.train import OneClassError, train

CFG = ReviewConfig(word_buckets=64, bigram_buckets=32)


def corpus(spark, n=240):
    """Good businesses are praised, bad ones are not, with some noise."""
    good = ["lovely", "great", "tasty", "friendly", "warm"]
    bad = ["awful", "cold", "rude", "slow", "stale"]
    rows = []
    for i in range(n):
        words = good if (i % 2) ^ (i % 11 == 0) else bad
        rows.append((f"r{i}", f"u{i % 9}", f"b{i % 8}", f"{words[i % 5]} place with {words[(i * 3) % 5]} food {i}"))
    entities = [
        (f"b{i}", f"name {i}", f"c{i % 3}", 4.5 if i % 2 else 2.0, 10 + i, i % 2, 30.0 + i, -80.0 - i, "food, bars")
        for i in range(8)
    ]
    return (
        spark.createDataFrame(
            entities,
            "business_id string, name string, city string, stars double, review_count int, is_open int, "
            "latitude double, longitude double, categories string",
        ),
        spark.createDataFrame(rows, "review_id string, user_id string, business_id string, text string"),
    )


def candidates():
    return [
        M.lr_candidate(max_iter=15, reg=(0.01, 0.1), elastic=(0.0,)),
        M.rf_candidate(trees=(5,), depth=(4,)),
        M.gbt_candidate(iterations=(4,), depth=(3,)),
    ]


def test_default_grids():
    grids = {c.name: c for c in M.default_candidates()}
    assert {n: len(c.grid) for n, c in grids.items()} == {M.LOGISTIC: 6, M.FOREST: 6, M.BOOSTED: 6}
    lr = grids[M.LOGISTIC].estimator
    assert lr.getMaxIter() == 100 and lr.getStandardization()
    rf = grids[M.FOREST].estimator
    assert (rf.getMinInstancesPerNode(), rf.getSubsamplingRate(), rf.getFeatureSubsetStrategy()) == (5, 0.8, "sqrt")
    gbt = grids[M.BOOSTED].estimator
    assert (gbt.getStepSize(), gbt.getSubsamplingRate(), gbt.getMinInstancesPerNode()) == (0.1, 0.8, 5)


def test_feature_widths():
    stages = {type(s).__name__ + s.getOutputCol(): s for s in feature_stages()}
    assert stages["HashingTFword_tf"].getNumFeatures() == 3072
    assert stages["HashingTFbigram_tf"].getNumFeatures() == 2048
    assert stages["CountVectorizercat_counts"].getVocabSize() == 150
    assert stages["IDFword_tfidf"].getMinDocFreq() == 2
    assert stages["IDFbigram_tfidf"].getMinDocFreq() == 3
    w2v = embedding_stages()[-1]
    assert (w2v.getVectorSize(), w2v.getMinCount()) == (50, 5)


def test_training_job(spark, tmp_path):
    entities, reviews = corpus(spark)
    trained = train(entities, reviews, CFG, candidates())
    doc = trained.metrics.first()
    assert doc.auc > 0.7 and doc.train_size + doc.test_size == doc.dataset_size
    assert doc.raw_dataset_size == doc.positive_count + doc.negative_count == 240
    assert doc.confusion_tn + doc.confusion_fp + doc.confusion_fn + doc.confusion_tp == doc.test_size
    assert doc.auc_diff == pytest.approx(doc.train_auc - doc.auc)
    assert doc.roc_fpr[0] == doc.roc_tpr[0] == 0.0 and doc.roc_fpr[-1] == doc.roc_tpr[-1] == 1.0
    assert doc.roc_fpr == sorted(doc.roc_fpr) and doc.roc_tpr == sorted(doc.roc_tpr)
    assert set(doc.all_validation_aucs) == {M.LOGISTIC, M.FOREST, M.BOOSTED}
    assert doc.validation_auc == max(doc.all_validation_aucs.values())
    assert doc.model_type == trained.name

    M.save_model(trained.model, str(tmp_path / "m"))
    rows = reviews.join(entities, "business_id").withColumn("cat_array", F.split("categories", ", "))
    a = M.score_table(trained.model, rows, ["review_id"]).orderBy("review_id").collect()
    b = M.score_table(M.load_model(str(tmp_path / "m")), rows, ["review_id"]).orderBy("review_id").collect()
    assert a == b


def test_one_class_is_refused(spark):
    entities, reviews = corpus(spark)
    with pytest.raises(OneClassError):
        train(entities.filter("stars > 4"), reviews, CFG, candidates())


def prepared(spark):
    entities, reviews = corpus(spark)
    rows = reviews.join(entities, "business_id").withColumn("cat_array", F.split("categories", ", "))
    return rows.withColumn("label", (F.col("stars") >= 4).cast("double")).persist()


def test_features_fitted_once_score_like_the_whole_pipeline(spark):
    """A grid over prepared features scores as a grid over the whole pipeline on the same split."""
    from pyspark.ml import Pipeline

    rows = prepared(spark)
    stages, lr = feature_stages(CFG), candidates()[0]
    chosen = M.select_model(rows, "review_id", stages, [lr], CFG)
    inner, held = M.hash_split(rows, "review_id", CFG.validation_fraction, CFG.seed + 1)

    def whole(part, params):
        return Pipeline(stages=stages + [lr.estimator.copy(params)]).fit(part)

    want = [M.auc_evaluator().evaluate(whole(inner, p).transform(held)) for p in lr.grid]
    assert chosen.winner.scores == pytest.approx(want, abs=1e-9)
    assert chosen.winner.best_score == max(want)

    refitted = whole(rows, lr.grid[chosen.winner.best])
    ours = M.score_table(chosen.model, rows, ["review_id"]).orderBy("review_id").collect()
    theirs = M.score_table(refitted, rows, ["review_id"]).orderBy("review_id").collect()
    assert [r.score for r in ours] == pytest.approx([r.score for r in theirs], abs=1e-9)


def test_built_in_searches(spark):
    rows = prepared(spark)
    tvs = M.train_validation_search(candidates()[0], feature_stages(CFG), rows, CFG)
    assert 0.5 < M.best_score(tvs) <= 1.0
    assert M.best_params(tvs.bestModel).keys() == {"max_iter", "reg_param", "elastic_net"}
    cv = M.cross_validate(M.lr_candidate(5, (0.1,), (0.0,)), feature_stages(CFG), rows, 3, CFG)
    assert M.best_score(cv) == max(cv.avgMetrics)


def test_best_params_of_trees(spark):
    rows = prepared(spark)
    from pyspark.ml import Pipeline

    for c, keys in [(candidates()[1], {"num_trees": 5, "max_depth": 4, "min_instances_per_node": 5}),
                    (candidates()[2], {"max_iter": 4, "max_depth": 3, "step_size": 0.1})]:
        model = Pipeline(stages=feature_stages(CFG) + [c.estimator.copy(c.grid[0])]).fit(rows)
        assert M.best_params(model) == keys
        assert {r.parameter: r.value for r in M.params_table(spark, model).collect()} == keys


def test_embedding(spark):
    from pyspark.ml import Pipeline

    rows = prepared(spark).select("text")
    out = Pipeline(stages=embedding_stages(size=8, min_count=2)).fit(rows).transform(rows)
    assert out.first().embedding.size == 8


def test_tier_tree_needs_both_splits(spark):
    entities, _ = corpus(spark)
    assert M.tier_tree(entities.limit(0), "business_id", ["review_count"]) is None


def test_analysis_and_exploration(spark):
    entities, reviews = corpus(spark)
    out = analyse(entities, reviews, ["business_id"], ["review_id"], min_reviews=12)
    counts = {r.table_name: (r.rows_before, r.rows_after) for r in out["cleaning_counts"].collect()}
    assert counts == {"businesses": (8, 8), "reviews": (240, 240)}
    assert [r.n for r in out["top_businesses"].collect()] == [30] * 5
    assert {r.business_id for r in out["top_rated"].collect()} == {"b3", "b5", "b7"}
    assert {r.label: r.n for r in out["tier_distribution"].collect()} == {0.0: 4, 2.0: 4}
    tables = eda(entities, reviews)
    assert {r.category: r.n for r in tables["top_categories"].collect()} == {"food": 8, "bars": 8}
    assert sum(r.n for r in tables["length_histogram"].collect()) == 240
    assert len(tables["top_reviewers"].collect()) == 5


def test_best_model_searches_the_default_grids(spark, folder, monkeypatch):
    from revmill.plans import catalog_metrics
    from revmill.plans.views import Views

    class Seen(Exception):
        pass

    def search(train, key, stages, candidates, cfg):
        raise Seen([(c.name, [{p.name: x for p, x in point.items()} for point in c.grid]) for c in candidates])

    monkeypatch.setattr(catalog_metrics.M, "select_model", search)
    with pytest.raises(Seen) as seen:
        catalog_metrics.best_model(Views(spark, folder))
    want = catalog_metrics.M.default_candidates(catalog_metrics.CFG)
    assert seen.value.args[0] == [(c.name, [{p.name: x for p, x in point.items()} for point in c.grid]) for c in want]
    assert sum(len(grid) for _, grid in seen.value.args[0]) == 18


def test_models_score_after_an_observed_write(spark, tmp_path):
    """A session that has observed a write cannot be sent to tasks, so no model may hold it."""
    from pyspark.ml.linalg import Vectors
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(10).observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "w"))
    assert seen.get["n"] == 10
    rows = spark.createDataFrame([(float(i % 2), Vectors.dense(i % 2 + 0.1 * i)) for i in range(40)], ["label", "features"])
    for c in (M.lr_candidate(5, (0.1,), (0.0,)), M.rf_candidate((3,), (2,)), M.gbt_candidate((2,), (2,))):
        assert M.grid_search(c, rows, rows).best_score > 0.5
        assert M.score_table(c.estimator.fit(rows), rows, ["label"]).count() == 40


def test_linear_models_are_fitted_once_a_fold_and_point(spark, monkeypatch):
    """The held-out rows are scored by models of the search, which are those of one more fit."""
    rows = prepared(spark)
    linear = M.lr_candidate(max_iter=15, reg=(0.01, 0.1), elastic=(0.0,))
    fits, fit = [], M.LeanLogisticRegression.fit

    def counted(self, *args):
        fits.append(1)
        return fit(self, *args)

    monkeypatch.setattr(M.LeanLogisticRegression, "fit", counted)
    found = M.keyed_cross_validation(rows, "review_id", feature_stages(CFG), linear, 3, CFG)
    scores = {r.review_id: r.score for r in found.held_out.collect()}
    assert len(fits) == 6 and len(scores) == 240
    search = M.grid_search
    monkeypatch.setattr(M, "grid_search", lambda c, a, b, n, keep: search(c, a, b, n))
    again = M.keyed_cross_validation(rows, "review_id", feature_stages(CFG), linear, 3, CFG)
    assert len(fits) == 15 and again.result.scores == pytest.approx(found.result.scores, abs=1e-9)
    assert {r.review_id: r.score for r in again.held_out.collect()} == pytest.approx(scores, abs=1e-9)


def test_metrics_read_scores_that_were_made_once(spark, folder, monkeypatch):
    from revmill.plans import catalog_metrics
    from revmill.plans.views import Views

    seen, small = [], M.lr_candidate(5, (0.1,), (0.0,))
    monkeypatch.setattr(catalog_metrics.M, "lr_candidate", lambda: small)
    monkeypatch.setattr(catalog_metrics.EV, "evaluate", lambda df: seen.append(df) or df)
    monkeypatch.setattr(catalog_metrics.EV, "gap_report", lambda train, test: train)
    catalog_metrics.gap_report(Views(spark, folder))
    assert len(seen) == 2
    for df in seen:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "UDF" not in plan and "Project" not in plan and "Relation" in plan
