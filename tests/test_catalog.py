"""Every registered query runs; those with a SQL twin give the same rows."""

import oracle
import pytest

from revmill.plans.catalog import ORACLES, QUERIES
from revmill.plans.views import Views

MODEL_QUERIES = {"q_lr", "q_gap_report", "q_best_model"}


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, folder, name):
    assert oracle.compare(spark, con, QUERIES[name], ORACLES[name], folder) is None


def test_queries_without_twin_are_the_known_ones():
    assert set(QUERIES) - set(ORACLES) == MODEL_QUERIES | {"q_nfkc", "q_tier_tree"}


def test_nfkc_leaves_the_given_texts_alone(spark, folder):
    before = {r.review_id: r.text for r in Views(spark, folder).reviews().collect()}
    after = {r.review_id: r.text for r in QUERIES["q_nfkc"](spark, folder).collect()}
    assert before == after


def test_tier_tree(spark, folder):
    rows = QUERIES["q_tier_tree"](spark, folder).collect()
    assert rows and all(r.label in (0, 1, 2) and r.prediction in (0, 1, 2) for r in rows)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["entity_id", "text", "label", "categories"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
