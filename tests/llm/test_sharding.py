import numpy as np
import pytest
from cases import awkward, empty, frame
from pyspark.sql import functions as F

from revmill.llm import sharding


def test_hypergeometric_mean_and_spread():
    rng = np.random.default_rng(1)
    got = [sharding.hypergeometric(rng, 300, 700, 100) for _ in range(4000)]
    assert abs(np.mean(got) - 30) < 0.3
    assert abs(np.var(got) - 100 * 0.3 * 0.7 * 900 / 999) < 1.5
    assert min(got) >= 0 and max(got) <= 100


def test_hypergeometric_of_huge_populations():
    rng = np.random.default_rng(1)
    got = [sharding.hypergeometric(rng, 10**11, 2 * 10**11, 10**9) for _ in range(200)]
    assert abs(np.mean(got) - 10**9 / 3) < 5000


def test_hypergeometric_bounds():
    rng = np.random.default_rng(1)
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0
    assert {sharding.hypergeometric(rng, 2, 1, 2) for _ in range(100)} == {1, 2}


def test_matrix_sums():
    counts, sizes = [10, 0, 55, 3, 32], [34, 33, 33]
    m = sharding.communication_matrix(counts, sizes, 5)
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).tolist() == sizes and m.min() >= 0


def shards(df):
    return df.select("doc_id", "shard", "slot").collect()


@pytest.mark.parametrize("parts", [1, 7])
def test_sizes_and_slots(spark, parts):
    df = sharding.uniform_shards(spark.range(1003).withColumnRenamed("id", "doc_id").repartition(parts), 24, block_rows=9)
    got = {}
    for r in shards(df):
        got.setdefault(r.shard, []).append(r.slot)
    assert sorted(got) == list(range(24))
    assert {len(v) for v in got.values()} == {41, 42}
    assert all(sorted(v) == list(range(len(v))) for v in got.values())


def test_every_row_once_and_same_again(spark):
    df = sharding.uniform_shards(spark.range(500, numPartitions=4).withColumnRenamed("id", "doc_id"), 5)
    first = sorted(shards(df))
    assert [r.doc_id for r in first] == list(range(500)) and sorted(shards(df)) == first


def test_uniform(spark):
    """Neighbours in the input are as often in one shard as any two rows."""
    at = {r.doc_id: r.shard for r in shards(sharding.uniform_shards(spark.range(6000).withColumnRenamed("id", "doc_id"), 6))}
    together = sum(at[i] == at[i + 1] for i in range(5999))
    assert abs(together - 1000) < 150


def test_awkward_rows(spark):
    got = sharding.uniform_shards(awkward(spark), 4)
    assert got.columns[-2:] == ["shard", "slot"] and got.columns.count("slot") == 1
    assert got.count() == 13 and got.where("text IS NULL").count() == 2
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [3, 3, 3, 4]
    assert sharding.uniform_shards(empty(spark), 4).count() == 0


def test_fewer_rows_than_shards(spark):
    got = sharding.uniform_shards(frame(spark, ["a", "b"]), 24).agg(F.countDistinct("shard"), F.max("slot")).first()
    assert tuple(got) == (2, 0)


def test_query_columns(spark, folder):
    import zlib

    from revmill.llm.shelf import table

    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    rows = sharding.op6_uniform_shards(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
