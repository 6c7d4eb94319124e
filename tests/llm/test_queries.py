"""The registered queries against their SQL, and on tables without rows."""

import oracle
import pytest

from revmill.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, folder, name):
    assert oracle.compare(spark, oracle.connect(folder), QUERIES[name], ORACLES[name], folder) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, folder, tmp_path, name):
    for t in ("documents", "pages", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []
