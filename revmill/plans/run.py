"""The whole run in one Spark application: prepare, analyse, explore, train, report."""

from __future__ import annotations

import logging
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from revmill.config import ReviewConfig
from revmill.operators.models import Candidate
from revmill.plans import analyse as A
from revmill.plans import train as T
from revmill.plans.prepare import prepare
from revmill.schemas import BUSINESS, REVIEW_STORE
from revmill.session import staged
from revmill.sources import files

log = logging.getLogger(__name__)


def run_stages(stages: list[tuple[str, Callable[[], object]]]) -> list[str]:
    """Run every stage in turn, go on past a failure, and return the names of those that failed."""
    failed = []
    for name, stage in stages:
        try:
            stage()
        except Exception:
            log.exception("stage %s failed", name)
            failed.append(name)
    return failed


def run_all(
    spark: SparkSession,
    business: str,
    review: str,
    out: str,
    cfg: ReviewConfig = ReviewConfig(),
    candidates: list[Candidate] | None = None,
    fast: bool = False,
    store: tuple[str, str] | None = None,
) -> list[str]:
    """Run all stages on raw files; the tables and documents land under out. Returns the failed stages.

    store names the tables of entities and reviews that the clean rows are appended to, if any.

    The clean JSON tables are read once into staged columnar tables for the stages after preparation.
    """
    tables: dict[str, DataFrame] = {}
    stack = ExitStack()

    def table(name: str, schema: StructType) -> DataFrame:
        if name not in tables:
            files.require_inputs(spark, [f"{out}/{name}"])
            rows = files.read_jsonl(spark, f"{out}/{name}", schema)
            tables[name] = stack.enter_context(staged(rows))
        return tables[name]

    def entities() -> DataFrame:
        return table("business", BUSINESS)

    def reviews() -> DataFrame:
        """All clean reviews; in fast mode there are none but the sample."""
        return table("review_small" if fast else "review", REVIEW_STORE)

    def do_prepare():
        files.require_inputs(spark, [business, review])
        prepare(spark, business, review, out, cfg, fast=fast)

    def do_analyse():
        found = A.analyse(entities(), reviews(), ["business_id"], ["review_id"], cfg)
        A.write_tables(found, f"{out}/analysis")

    def do_store():
        clean = A.clean_tables(entities(), reviews(), ["business_id"], ["review_id"])
        A.load_store(*clean, *store)

    def do_explore():
        A.write_tables(A.eda(entities(), reviews()), f"{out}/eda")

    def do_train():
        T.save(T.train(entities(), reviews(), cfg, candidates), out)

    def do_report():
        document = files.load_metrics(spark, f"{out}/model_metrics")
        if document is None:
            raise FileNotFoundError("no metric document")
        A.write_tables(A.report_tables(document), f"{out}/report")

    with stack:
        return run_stages(
            [
                ("prepare", do_prepare),
                ("analyse", do_analyse),
                *([("store", do_store)] if store else []),
                ("explore", do_explore),
                ("train", do_train),
                ("report", do_report),
            ]
        )
