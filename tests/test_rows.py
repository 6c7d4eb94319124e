import pytest
from pyspark.sql import functions as F

from conftest import executed
from revmill.functions import values as V
from revmill.operators import cleaning, dedupe, joins, limits, rows, sampling
from revmill.plans.views import Views

ENTITIES = [
    (1, "b1", 4.0, "Food", None),
    (2, "b1", 5.0, "Bars", cleaning.DUPLICATE_ID),
    (3, "", 4.0, "Food", cleaning.INVALID),
    (4, None, 4.0, "Food", cleaning.INVALID),
    (5, "b2", 0.5, "Food", cleaning.INVALID),
    (6, "b3", 5.0, " , ", cleaning.INVALID),
    (7, "b4", None, "Food", cleaning.INVALID),
    (8, "b2", 3.0, "Food", None),
    (9, "b2", 9.0, "", cleaning.DUPLICATE_ID),
    (10, "b5", float("nan"), "Food", cleaning.INVALID),
]


def entity_rows(spark, parts):
    data = [e[:4] for e in ENTITIES]
    return spark.createDataFrame(data, "seq int, id string, stars double, categories string").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_entity_reasons(spark, parts):
    got = cleaning.entity_reasons(entity_rows(spark, parts), "id", ["seq"])
    assert {r.seq: r.reason for r in got.collect()} == {e[0]: e[4] for e in ENTITIES}
    counts = cleaning.entity_counters(got).first()
    assert counts.asDict() == {"records_written": 2, cleaning.DUPLICATE_ID: 2, cleaning.INVALID: 6}
    kept = cleaning.prepare_entities(entity_rows(spark, parts), "id", ["seq"])
    assert sorted(r.seq for r in kept.collect()) == [1, 8]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_review_counters_add_up_with_a_hot_key(spark, parts):
    """A third of the rows are copies of one text of one entity."""
    data = [(i, "hot", "the very same words again and again") for i in range(300)]
    data += [(1000 + i, f"e{i % 40}", f"review number {i} with enough words") for i in range(500)]
    data += [(2000 + i, "", "no key but quite enough words") for i in range(60)]
    data += [(3000 + i, "e1", "short") for i in range(40)]
    df = spark.createDataFrame(data, "seq int, e string, text string").repartition(parts)
    states = cleaning.review_states(df, "e", "text")
    counts = cleaning.review_counters(states, "e").first()
    assert counts.asDict() == {
        "records_written": 501,
        "dropped_malformed_json": 0,
        "dropped_empty_short": 100,
        "dropped_duplicate": 299,
    }
    assert sum(counts) == len(data)
    kept = cleaning.kept_reviews(states, "e", ["seq"])
    assert kept.count() == 501 and kept.filter("e = 'hot'").first().seq == 0


def test_keep_first_limits_groups_before_the_shuffle(spark, folder):
    plan = executed(dedupe.keep_first(Views(spark, folder).ratings(), ["order_id"], ["line_id", "price"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_keyed_samples_ignore_partitioning(spark, parts):
    df = spark.range(1000).withColumn("label", (F.col("id") % 5 > 0).cast("double")).repartition(parts)
    train, test = sampling.hash_split(df, "id")
    assert train.count() + test.count() == 1000
    assert 750 < train.count() < 850
    ids = sorted(r.id for r in train.collect())
    assert ids == sorted(r.id for r in sampling.hash_split(df.repartition(2), "id")[0].collect())
    picked = [r.id for r in limits.random_k(df, "id", 20).orderBy("id").collect()]
    assert len(picked) == 20
    assert picked == [r.id for r in limits.random_k(df.coalesce(1), "id", 20).orderBy("id").collect()]
    thin = sampling.undersample(df, "id").groupBy("label").count().orderBy("label").collect()
    assert thin[0]["count"] == 200 and 150 < thin[1]["count"] < 250


def test_undersample_keeps_rare_positives(spark):
    df = spark.range(100).withColumn("label", (F.col("id") < 10).cast("double"))
    assert sampling.undersample(df, "id").count() == 100
    assert sampling.undersample(df.filter("label = 0"), "id").count() == 90


def test_plain_sample_and_split(spark):
    df = spark.range(1000)
    assert 400 < sampling.sample(df, 0.5).count() < 600
    first, second = sampling.split(df)
    assert first.count() + second.count() == 1000


def test_head_sample(spark):
    df = spark.range(500).repartition(7).withColumn("a", F.col("id") % 10)
    assert sorted(r.id for r in limits.head_sample(df, 30, ["id"]).collect()) == list(range(30))
    want = sorted((i % 10, i) for i in range(500))[:60]
    got = sorted((r.a, r.id) for r in limits.head_sample(df, 60, ["a", "id"]).collect())
    assert got == want
    assert limits.head_sample(df, 900, ["id"]).count() == 500
    assert limits.head_sample(df, 0, ["id"]).count() == 0
    assert limits.head_sample(df.filter("id < 0"), 5, ["id"]).count() == 0


def test_head_sample_moves_only_the_order_column(spark, folder):
    plan = executed(limits.head_sample(Views(spark, folder).reviews(), 50, ["review_id"]))
    top = plan[plan.index("TakeOrderedAndProject"):]
    assert "ReadSchema: struct<doc_id:bigint>" in top


def test_fast_sample_against_a_loop(spark):
    texts = [f"words of review {i % 37} in plain sight" if i % 4 else "tiny" for i in range(400)]
    df = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(texts)], "i int, e int, text string")
    seen, want = set(), []
    for i, t in list(enumerate(texts))[:200]:
        if t != "tiny" and (i % 3, t) not in seen and len(want) < 50:
            seen.add((i % 3, t))
            want.append(i)
    got = limits.fast_sample(df.repartition(5), "e", "text", ["i"], max_rows=50, raw_cap=200)
    assert sorted(r.i for r in got.collect()) == want


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 9), ("b", 1, 9)], "k string, v int, at int")
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("c", 4, 1)], "k string, v int, at int")
    got = {r.k: r.v for r in dedupe.upsert(old, new, "k", ["at"]).collect()}
    assert got == {"a": 3, "b": 1, "c": 4}


def test_drop_any_null(spark):
    data = [(1, 1.0, {"a": "b"}), (2, None, {"a": "b"}), (3, float("nan"), {}), (4, 2.0, None)]
    df = spark.createDataFrame(data, "i int, x double, m map<string,string>")
    assert [r.i for r in rows.drop_any_null(df).collect()] == [1]
    assert [r.i for r in rows.drop_any_null(df, ["x"]).collect()] == [1, 4]
    assert rows.drop_any_null(df).collect() == df.dropna().collect()


def test_filters_reach_the_scan(spark, folder):
    v = Views(spark, folder)
    plan = executed(rows.drop_any_null(v.table("part").select("p_partkey", "p_name")))
    assert "IsNotNull(p_partkey),IsNotNull(p_name)" in plan.replace(" ", "")
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_coercions(spark):
    df = spark.createDataFrame([("4.5", "3"), ("x", "3"), (None, "2.5"), (None, None)], "s string, u string")
    spec = {"s": ("double", 0.0), "u": ("int", 7)}
    assert [tuple(r) for r in rows.coerce_defaults(df, spec).collect()] == [(4.5, 3), (0.0, 3), (0.0, 7), (0.0, 7)]
    good, bad = rows.coerce_or_reject(df, spec)
    assert [tuple(r) for r in good.collect()] == [(4.5, 3), (0.0, 7)]
    assert [tuple(r) for r in bad.collect()] == [("x", "3"), (None, "2.5")]
    ranged = df.select(V.valid_range(F.col("s"), 1, 5).alias("v"))
    assert [r.v for r in ranged.collect()] == [True, False, False, False]


def test_select_existing(spark):
    assert rows.select_existing(spark.range(1), ["id", "other"]).columns == ["id"]


def test_label_join_broadcasts_small_labels_only(spark, folder):
    v = Views(spark, folder)
    joined = joins.label_reviews(v.ratings(), joins.entity_labels(v.entities(), "entity_id"), "entity_id")
    assert "BroadcastHashJoin" in executed(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "SortMergeJoin" in executed(joined.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_training_reviews_spread_a_hot_entity(spark, folder):
    """Copies are removed on (entity, text) before any placement by entity alone."""
    v = Views(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = executed(joins.training_reviews(v.reviews(), v.entities(), "entity_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join, distinct = plan.index("SortMergeJoin"), plan.index("HashAggregate")
    assert join < distinct  # the plan prints from the top
    assert "hashpartitioning(entity_id" in plan and ", text" in plan[distinct:]


def test_top_k_plan(spark, folder):
    from revmill.operators.counts import group_count

    plan = executed(limits.top_k(group_count(Views(spark, folder).ratings(), "entity_id"), 5))
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<l_partkey:bigint>" in plan


def test_no_python_outside_nfkc(spark, folder):
    from revmill.plans.catalog import QUERIES

    uses_text = {"q_clean_text", "q_nfkc", "q_tokens", "q_stopwords", "q_bigrams", "q_training_set",
                 "q_dedupe_reviews", "q_fast_sample", "q_prepare_reviews", "q_quality_counters", "q_eda_summary",
                 "q_nfkc_wide", "q_training_repeated", "q_hashed_tf"}
    eager = {"q_tfidf", "q_lr", "q_gap_report", "q_best_model", "q_tier_tree", "q_roc_curve", "q_auc", "q_metrics_long",
             "q_metric_breakdown", "q_category_idf", "q_tier_rows"}
    for name in set(QUERIES) - uses_text - eager:
        plan = executed(QUERIES[name](spark, folder))
        assert "EvalPython" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.fixture
def small_skew_limits(spark):
    """Skew handling at test size: no broadcasts, small partitions, low thresholds."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k in confs:
        spark.conf.unset(k)


def final_plan(df) -> str:
    """The plan after the run-time decisions."""
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    assert rows is not None
    return executed(df)


def hot_rows(spark, n=60_000):
    """A third of the rows hold one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 6).select(F.col("id").alias("seq"), key.alias("entity_id"), F.uuid().alias("text"))


def test_hot_entity_is_split_in_the_label_join(spark, small_skew_limits):
    labels = spark.range(5000).select(
        F.col("id").alias("entity_id"), F.lit(1.0).alias("label"), F.lit("a").alias("categories")
    )
    joined = joins.label_reviews(hot_rows(spark), labels, "entity_id")
    assert "skew=true" in final_plan(joined).replace("isSkewJoin", "skew")


def largest_share(df) -> float:
    """Share of the rows in the fullest partition."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def plain_shuffles(spark):
    """No broadcasts by size and no run-time changes, so that partitions show where rows went."""
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}.items():
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("hot", ["x", "", None])
def test_hot_entity_is_spread_in_the_reasons(spark, plain_shuffles, hot):
    hot_key = F.lit(hot).cast("string")
    raw = spark.range(0, 30_000, 1, 6).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, hot_key).otherwise((F.col("id") % 5000).cast("string")).alias("id"),
        F.lit(4.0).alias("stars"),
        F.lit("a").alias("categories"),
    )
    reasons = cleaning.entity_reasons(raw, "id", ["seq"])
    assert largest_share(reasons) < 0.35  # four shuffle partitions; half of the rows hold one key
    counts = cleaning.entity_counters(reasons).first()
    kept = 2501 if hot == "x" else 2500
    assert (counts.records_written, sum(counts)) == (kept, 30_000)
    assert counts.dropped_invalid == (0 if hot == "x" else 15_000)


def test_hot_term_is_spread(spark, plain_shuffles):
    from revmill.operators.features import tfidf

    docs = spark.range(0, 6000, 1, 4).select(
        "id", F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id").cast("string"))).alias("words")
    )
    table = tfidf(docs, "id", "words")
    assert largest_share(table) < 0.35
    assert table.count() == 12_000 and table.filter("term = 'the'").select("df").distinct().first().df == 6000


def test_head_sample_by_blocks(spark):
    rows = [(f"f{i % 3}", i % 5, i) for i in range(300)]
    df = spark.createDataFrame(rows, "file string, block int, no int").repartition(7)
    for n in (1, 20, 21, 150, 300, 900):
        got = limits.head_sample(df, n, ["file", "block", "no"]).collect()
        assert sorted(map(tuple, got)) == sorted(rows)[:n]


def test_head_sample_with_ties_and_extremes(spark):
    rows = [(5, i) for i in range(50)] + [(-(2**62), 0), (2**62, 0)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    for n in (1, 2, 30, 51, 52, 99):
        assert sorted(map(tuple, limits.head_sample(df, n, ["a", "b"]).collect())) == sorted(rows)[:n]
    assert limits.head_sample(df.limit(0), 3, ["a", "b"]).count() == 0


def test_head_sample_sends_few_rows_to_one_task(spark):
    """5,000 of 400,000 rows over 40 tasks: a small multiple of 5,000 positions meet, not 5,000 of every task."""
    df = spark.range(400_000, numPartitions=40)
    keys = df.select("id")
    total = keys.agg(F.count("*")).scalar()
    share = F.least(F.lit(1.0), (F.lit(5000) + 2.0 * total / limits.RANK_ERROR + 1) / F.greatest(total, F.lit(1)))
    assert keys.filter(F.col("id") <= limits._quantile(keys, "id", share)).count() <= 15_000
    assert limits.head_sample(df, 5000, ["id"]).agg(F.max("id"), F.count("*")).first() == (4999, 5000)
