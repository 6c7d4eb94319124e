"""Queries over classifier metrics, and the models themselves."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.operators import ensembles as EN
from revmill.operators import evaluation as EV
from revmill.operators import models as M
from revmill.operators.features import feature_stages, split_stages
from revmill.operators.sampling import hash_split
from revmill.plans.catalog_rows import SQL_TRAINING, SQL_U, training_set
from revmill.plans.catalog_text import SQL_CLEAN
from revmill.plans.registry import query
from revmill.plans.views import Views
from revmill.session import cut_lineage

CFG = ReviewConfig()

SQL_CONFUSION = """matrix AS (
  SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM scored)"""


def rounded(df: DataFrame, *skip: str) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double" and f.name not in skip]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


@query("q_confusion", f"WITH {SQL_CONFUSION} SELECT * FROM matrix", "scored")
def confusion(v):
    return EV.confusion(v.scored())


@query(
    "q_confusion_stats",
    f"""WITH {SQL_CONFUSION},
  rates AS (SELECT *, tp / (tp + fn)::DOUBLE AS sens, tp / (tp + fp)::DOUBLE AS prec FROM matrix)
SELECT round(sens, 6) AS sensitivity, round(tn / (tn + fp)::DOUBLE, 6) AS specificity, round(prec, 6) AS ppv,
       round(tn / (tn + fn)::DOUBLE, 6) AS npv, round((tp + tn) / (tn + fp + fn + tp)::DOUBLE, 6) AS accuracy,
       round(2 * (prec * sens) / (prec + sens), 6) AS f1, tn + fp + fn + tp AS total FROM rates""",
    "scored",
)
def confusion_stats(v):
    return rounded(EV.confusion_stats(EV.confusion(v.scored())))


def sql_multiclass(source: str, tag: str) -> str:
    """Per-class counts of a scored table and their weighted means, as views named with a tag."""
    return f"""{tag}_classes AS (
  SELECT label AS c, count(*)::DOUBLE AS support, count(*) FILTER (label = prediction)::DOUBLE AS hits,
         (SELECT count(*) FROM {source} o WHERE o.prediction = s.label)::DOUBLE AS guessed
  FROM {source} s GROUP BY label),
  {tag}_rates AS (
  SELECT support, hits, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS p, hits / support AS r
  FROM {tag}_classes),
  {tag}_weighted AS (
  SELECT sum(hits) / sum(support) AS accuracy, sum(support * p) / sum(support) AS precision,
         sum(support * r) / sum(support) AS recall,
         sum(support * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(support) AS f1
  FROM {tag}_rates)"""


@query(
    "q_multiclass_metrics",
    f"""WITH {sql_multiclass('scored', 'm')}
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM m_weighted""",
    "scored",
)
def multiclass_metrics(v):
    return rounded(EV.multiclass_metrics(v.scored()))


def sql_roc(source: str, tag: str) -> str:
    return f"""{tag}_groups AS (
  SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {source} GROUP BY score),
  {tag}_points AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC)::BIGINT AS tp, sum(neg) OVER (ORDER BY score DESC)::BIGINT AS fp,
         sum(pos) OVER ()::BIGINT AS total_pos, sum(neg) OVER ()::BIGINT AS total_neg FROM {tag}_groups),
  {tag}_area AS (
  SELECT sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(total_pos)::DOUBLE * max(total_neg)) AS auc FROM {tag}_points)"""


@query(
    "q_roc_curve",
    f"""WITH {sql_roc('scored', 'r')}
SELECT round(score, 6) AS threshold, tp, fp, round(tp / total_pos::DOUBLE, 6) AS tpr,
       round(fp / total_neg::DOUBLE, 6) AS fpr FROM r_points""",
    "scored",
)
def roc_curve(v):
    return rounded(EV.roc_curve(v.scored()))


@query("q_auc", f"WITH {sql_roc('scored', 'r')} SELECT round(auc, 6) AS auc FROM r_area", "scored")
def auc(v):
    return rounded(EV.auc(v.scored()))


SQL_DOC = f"""marked AS (SELECT *, {SQL_U} < 0.8::DOUBLE AS inside FROM scored),
  train AS (SELECT * FROM marked WHERE inside), test AS (SELECT * FROM marked WHERE NOT inside),
  {sql_multiclass('train', 'tr')}, {sql_roc('train', 'tr')}, {sql_multiclass('test', 'te')}, {sql_roc('test', 'te')},
  doc AS (SELECT w.*, a.auc, tw.accuracy AS train_accuracy, ta.auc AS train_auc
          FROM te_weighted w, te_area a, tr_weighted tw, tr_area ta)"""


def metric_document(v: Views) -> DataFrame:
    """Metrics of the given predictions, train rows against test rows."""
    train, test = hash_split(v.scored(), "doc_id")
    return EV.gap_report(EV.evaluate(train), EV.evaluate(test))


@query(
    "q_metrics_long",
    f"""WITH {SQL_DOC},
  long AS (SELECT 'AUC-ROC' AS metric, train_auc AS train, auc AS test FROM doc
    UNION ALL SELECT 'Accuracy', train_accuracy, accuracy FROM doc UNION ALL SELECT 'F1 Score', NULL, f1 FROM doc
    UNION ALL SELECT 'Precision', NULL, precision FROM doc UNION ALL SELECT 'Recall', NULL, recall FROM doc)
SELECT metric, round(train, 6) AS train, round(test, 6) AS test, round(train - test, 6) AS gap,
       CASE WHEN train IS NULL THEN NULL WHEN abs(train - test) < 0.1::DOUBLE THEN 'ok' ELSE 'warning' END AS flag
FROM long""",
    "scored",
)
def metrics_long(v):
    return rounded(EV.metrics_long(metric_document(v)))


@query(
    "q_metric_breakdown",
    f"""WITH {SQL_DOC}
SELECT 'AUC-ROC' AS metric, round(auc, 6) AS score FROM doc UNION ALL SELECT 'Accuracy', round(accuracy, 6) FROM doc
UNION ALL SELECT 'F1 Score', round(f1, 6) FROM doc UNION ALL SELECT 'Precision', round(precision, 6) FROM doc
UNION ALL SELECT 'Recall', round(recall, 6) FROM doc""",
    "scored",
)
def metric_breakdown(v):
    return rounded(EV.metric_breakdown(metric_document(v)))


# --- models: rows-only checks ----------------------------------------------------------------------------


def keyed_training_set(v: Views) -> DataFrame:
    """The training rows with a key for hash splits; entity and text are unique together."""
    key = F.sha2(F.concat_ws("|", "entity_id", "text"), 256)
    return training_set(v).withColumn("sample_key", key)


def hashed_training_set(v: Views) -> tuple[DataFrame, list]:
    """The keyed training rows after the stages that need no fitting, staged in place of their texts, and the other stages."""
    fixed, rest, columns = split_stages(feature_stages(CFG))
    rows = PipelineModel(fixed).transform(keyed_training_set(v))
    return cut_lineage(rows.select("entity_id", "sample_key", "label", *columns)), rest


@query("q_tier_tree")
def tier_tree(v):
    columns = ["review_count", "is_open", "num1", "num2"]
    scored = M.tier_tree(v.counted_entities(), "entity_id", columns)
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def _lr_scores(v: Views) -> tuple[DataFrame, DataFrame]:
    hashed, rest = hashed_training_set(v)
    train, test = hash_split(hashed, "sample_key", CFG.train_fraction, CFG.seed)
    model = M.select_model(train, "sample_key", rest, [M.lr_candidate()], CFG).model
    keep = ["entity_id", "sample_key", "label"]
    return M.score_table(model, train, keep), M.score_table(model, test, keep)


@query("q_lr")
def lr(v):
    return _lr_scores(v)[1]


@query("q_gap_report")
def gap_report(v):
    """Each part is scored once; its metrics read the scores."""
    train, test = (cut_lineage(scored) for scored in _lr_scores(v))
    return EV.gap_report(EV.evaluate(train), EV.evaluate(test))


@query("q_best_model")
def best_model(v):
    """The best validation score of each kind of model over the default grids, and the kind with the highest of them."""
    hashed, rest = hashed_training_set(v)
    train, _ = hash_split(hashed, "sample_key", CFG.train_fraction, CFG.seed)
    busy = replace(CFG, parallel_fits=6)
    chosen = M.select_model(train, "sample_key", rest, M.default_candidates(CFG), busy)
    table = M.compare_models(v.spark, chosen.results)
    best = EV.best_by(table, "model", "validation_auc").select("model").scalar()
    return table.withColumn("is_best", F.col("model") == best)


# --- models against their tables: test rows, labels, and whether the tables give the model's own scores -----

SQL_KEYED = f"""WITH {SQL_CLEAN}, {SQL_TRAINING},
  keyed AS (SELECT entity_id, sha256(concat_ws('|', entity_id, text)) AS sample_key, label FROM training)"""
SQL_TEST = f"""{SQL_KEYED}
SELECT entity_id, sample_key, label::DOUBLE AS label, true AS same FROM keyed
WHERE {SQL_U.replace("doc_id", "sample_key")} >= 0.8::DOUBLE"""


def checked_test_rows(v: Views, estimator) -> DataFrame:
    """Fit on the training rows; (entity_id, sample_key, label, same) of the test rows."""
    hashed, rest = hashed_training_set(v)
    train, test = hash_split(hashed, "sample_key", CFG.train_fraction, CFG.seed)
    features = Pipeline(stages=rest).fit(train)
    columns = ["entity_id", "sample_key", F.col("label").cast("double").alias("label"), "features"]
    fit_on, score_on = (cut_lineage(features.transform(part).select(*columns)) for part in (train, test))
    checked = EN.checked_scores(score_on, "sample_key", estimator.fit(M.packed(fit_on)))
    return score_on.select("entity_id", "sample_key").join(checked, "sample_key").select(
        "entity_id", "sample_key", "label", "same"
    )


@query("q_forest_rows", SQL_TEST, "reviews entities")
def forest_rows(v):
    """The first forest of the grid, scored by its node table."""
    forest = M.rf_candidate(seed=CFG.seed)
    return checked_test_rows(v, forest.estimator.copy(forest.grid[0]))


@query("q_boosted_rows", SQL_TEST, "reviews entities")
def boosted_rows(v):
    """The first boosted model of the grid, scored by its node table."""
    boosted = M.gbt_candidate(seed=CFG.seed)
    return checked_test_rows(v, boosted.estimator.copy(boosted.grid[0]))


@query("q_lr_rows", SQL_TEST, "reviews entities")
def lr_rows(v):
    """The first linear model of the grid, scored by its coefficient table."""
    linear = M.lr_candidate()
    return checked_test_rows(v, linear.estimator.copy(linear.grid[0]))


@query(
    "q_tree_rows",
    f"""SELECT entity_id, CASE WHEN stars >= 4.0 THEN 0.0 WHEN stars >= 3.0 THEN 1.0 ELSE 2.0 END::DOUBLE AS label,
              true AS same FROM counted_entities WHERE {SQL_U.replace("doc_id", "entity_id")} >= 0.8::DOUBLE""",
    "counted_entities",
)
def tree_rows(v):
    """The tier tree, scored by its node table."""
    fitted = M.fit_tier_tree(v.counted_entities(), "entity_id", ["review_count", "is_open", "num1", "num2"])
    return EN.checked_scores(fitted.test, "entity_id", fitted.tree).select("entity_id", "label", "same")


@query(
    "q_cv_rows",
    f"""{SQL_KEYED}
SELECT entity_id, sample_key, label::DOUBLE AS label, floor({SQL_U.replace("doc_id", "sample_key")} * 3)::INTEGER AS fold,
       true AS scored FROM keyed""",
    "reviews entities",
)
def cv_rows(v):
    """Every training row with the fold that held it out, and whether that fold's best model gave it a probability."""
    data, rest = hashed_training_set(v)
    linear = M.lr_candidate(reg=(0.01, 0.1), elastic=(0.0,))
    found = M.keyed_cross_validation(data, "sample_key", rest, linear, 3, CFG)
    rows = found.held_out.join(data.select("sample_key", "entity_id"), "sample_key")
    scored = F.col("score").between(0, 1) & F.col("prediction").isin(0.0, 1.0)
    return rows.select("entity_id", "sample_key", F.col("label").cast("double").alias("label"), "fold", scored.alias("scored"))
