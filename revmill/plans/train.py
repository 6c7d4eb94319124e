"""Training job: labelled training set to a selected, evaluated and saved model."""

from __future__ import annotations

import dataclasses

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.functions import values as V
from revmill.operators import evaluation as EV
from revmill.operators import models as M
from revmill.operators.counts import class_balance
from revmill.operators.features import feature_stages
from revmill.operators.joins import training_reviews
from revmill.operators.sampling import hash_split, undersample
from revmill.session import staged
from revmill.sources import sinks

KEY = "sample_key"


@dataclasses.dataclass(frozen=True)
class Trained:
    model: PipelineModel
    name: str
    metrics: DataFrame


class OneClassError(ValueError):
    """The training set holds a single class."""


def roc_arrays(predictions: DataFrame, cfg: ReviewConfig) -> DataFrame:
    """One row (roc_fpr, roc_tpr): the curve of all rows from the origin, thinned to at most roc_points points.

    Of the corners that fall into one of roc_points equal steps along the curve the last is kept, so both ends stay.
    """
    points = EV.roc_curve(predictions, drop_collinear=True)
    step = F.ceil((F.coalesce("fpr", F.lit(0.0)) + F.coalesce("tpr", F.lit(0.0))) * (cfg.roc_points / 2.0))
    last = F.max_by(F.struct("fp", "tp", "fpr", "tpr"), F.col("fp") + F.col("tp"))
    points = points.groupBy(step.alias("step")).agg(last.alias("p")).select("p.*")
    path = F.sort_array(F.collect_list(F.struct("fp", "tp", "fpr", "tpr")))
    origin = F.array(F.lit(0.0))
    return points.agg(path.alias("path")).select(
        F.concat(origin, F.transform("path", lambda p: p["fpr"])).alias("roc_fpr"),
        F.concat(origin, F.transform("path", lambda p: p["tpr"])).alias("roc_tpr"),
    )


def train(
    entities: DataFrame,
    reviews: DataFrame,
    cfg: ReviewConfig = ReviewConfig(),
    candidates: list[M.Candidate] | None = None,
    key: str = "business_id",
) -> Trained:
    """Label, balance, split, search, refit the winner, evaluate.

    The labelled set is written once to the shared folder; balancing, search, refit and evaluation read it
    from there.
    """
    labelled = training_reviews(reviews, entities, key, cfg=cfg).withColumn(
        KEY, F.sha2(F.concat_ws("|", key, "text"), 256)
    )
    with staged(labelled) as data:
        return _train_on(data, cfg, candidates or M.default_candidates(cfg))


def _train_on(data: DataFrame, cfg: ReviewConfig, candidates: list[M.Candidate]) -> Trained:
    spark = data.sparkSession
    balance = class_balance(data).first()
    if 0 in (balance["positive_count"], balance["negative_count"]):
        raise OneClassError("need both classes")
    balanced = undersample(data, KEY, seed=cfg.seed)
    # The thinning keeps positives by a fraction of their key, so the split must draw with another seed.
    train_rows, test_rows = hash_split(balanced, KEY, cfg.train_fraction, cfg.seed + 2)

    fit_rows = train_rows
    if cfg.max_fit_rows is not None:
        share = F.lit(float(cfg.max_fit_rows)) / F.greatest(train_rows.agg(F.count("*")).scalar(), F.lit(1))
        fit_rows = train_rows.filter(V.key_fraction(F.col(KEY), cfg.seed + 3) < share)
    chosen = M.select_model(fit_rows, KEY, feature_stages(cfg), candidates, cfg)
    model, winner, results = chosen.model, chosen.winner, chosen.results

    keep = [KEY, "label"]
    scored_train = M.score_table(model, train_rows, keep).persist()
    scored_test = M.score_table(model, test_rows, keep).persist()
    sizes = {"train_size": scored_train.count(), "test_size": scored_test.count()}
    report = EV.gap_report(
        EV.evaluate(scored_train), EV.evaluate(scored_test), F.lit(balance["baseline_accuracy"])
    )
    matrix = EV.confusion(scored_test)
    params = M.best_params(model)
    curve = roc_arrays(scored_test, cfg)
    aucs = [x for r in results for x in (F.lit(r.candidate.name), F.lit(r.best_score))]
    document = report.select(
        "*",
        F.lit(balance["total"]).alias("raw_dataset_size"),
        F.lit(balance["positive_count"]).alias("positive_count"),
        F.lit(balance["negative_count"]).alias("negative_count"),
        F.lit(balance["baseline_accuracy"]).alias("baseline_accuracy"),
        F.lit(sum(sizes.values())).alias("dataset_size"),
        *[F.lit(v).alias(k) for k, v in sizes.items()],
        F.lit(winner.candidate.name).alias("model_type"),
        F.lit(winner.best_score).alias("validation_auc"),
        F.lit("tfidf_bigrams").alias("embedding_type"),
        F.lit(cfg.word_buckets + cfg.bigram_buckets).alias("embedding_dimension"),
        *[matrix.select(c).scalar().alias(f"confusion_{c}") for c in ("tn", "fp", "fn", "tp")],
        F.lit(cfg.high_star).alias("star_label_threshold"),
        *[F.lit(params.get(n)).cast("double").alias(n) for n in M.TUNED],
        F.create_map(*aucs).alias("all_validation_aucs"),
        F.struct(
            F.lit("full" if cfg.max_fit_rows is None else "bounded").alias("mode"),
            F.lit(cfg.word_buckets).alias("word_tfidf_features"),
            F.lit(cfg.bigram_buckets).alias("bigram_tfidf_features"),
            F.lit(cfg.category_vocab).alias("category_features"),
            F.lit(cfg.word_buckets + cfg.bigram_buckets + cfg.category_vocab).alias("total_features"),
        ).alias("training_config"),
        curve.select("roc_fpr").scalar().alias("roc_fpr"),
        curve.select("roc_tpr").scalar().alias("roc_tpr"),
    )
    # The document is a single row; holding it lets the staged rows go.
    metrics = spark.createDataFrame([document.first()], document.schema)
    scored_train.unpersist()
    scored_test.unpersist()
    return Trained(model, winner.candidate.name, metrics)


def save(trained: Trained, out: str) -> None:
    sinks.save_metrics(trained.metrics, f"{out}/model_metrics")
    M.save_model(trained.model, f"{out}/best_model")
