import zlib

import numpy as np
import pytest
from cases import awkward, empty
from pyspark.sql import functions as F

from revmill.llm import toxicity as T
from revmill.llm.shelf import table

SMALL = T.FtrlSettings(bits=12, rounds=2, shards=2)


def test_ftrl_against_the_plain_rule():
    s = T.FtrlSettings(bits=4, alpha=0.5, beta=1.0, l1=0.2, l2=0.3)
    rng = np.random.default_rng(3)
    rows = [(np.unique(rng.integers(0, 16, 5)), float(rng.integers(0, 2))) for _ in range(60)]
    z, n = np.zeros(16), np.zeros(16)
    T.ftrl_pass(rows, z, n, s)
    pz, pn = [0.0] * 16, [0.0] * 16

    def weight(i):
        l1 = 0.0 if i == T.BIAS else s.l1
        if abs(pz[i]) <= l1:
            return 0.0
        return -(pz[i] - (l1 if pz[i] > 0 else -l1)) / ((s.beta + pn[i] ** 0.5) / s.alpha + s.l2)

    for at, y in rows:
        w = {int(i): weight(int(i)) for i in at}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i, wi in w.items():
            sigma = ((pn[i] + g * g) ** 0.5 - pn[i] ** 0.5) / s.alpha
            pz[i] += g - sigma * wi
            pn[i] += g * g
    assert np.allclose(z, pz) and np.allclose(n, pn)


def test_features():
    h = T.Hasher(20)
    rows, at = h.features(["Bad day, BAD day now", "", "x"])
    assert set(rows) == {0, 2} and (at != T.BIAS).all()
    # five words, four pairs, three skips; no word has over four letters
    assert (rows == 0).sum() == 12 and (rows == 2).sum() == 1
    words = at[rows == 0][:5]
    assert words[0] == words[2] and words[1] == words[3]
    assert not set(at[rows == 2]) & set(at[rows == 0])


def test_pairs_do_not_cross_texts():
    h = T.Hasher(20)
    alone = sorted(np.concatenate([h.features([t])[1] for t in ("a b c", "d e")]))
    assert sorted(h.features(["a b c", "d e"])[1]) == alone


def test_held_out_rows(spark):
    got = spark.range(50).select("id", T.held_out("id").alias("h")).collect()
    assert [r.h for r in got] == [zlib.crc32(str(r.id).encode()) % 4 == 2 for r in got]


def test_learns_planted_words(spark):
    rng = np.random.default_rng(0)
    texts = []
    for i in range(600):
        words = [f"w{k}" for k in rng.integers(0, 300, 40)]
        bad = i % 5 == 0
        if bad:
            words[3:3] = ["nasty", "slur"]
        texts.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    w = T.learn(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    got = T.score(docs, w).join(docs, "doc_id").where(T.held_out()).collect()
    assert len(got) > 100
    assert np.mean([(r.score >= T.THRESHOLD) == bool(r.toxic) for r in got]) > 0.97
    assert 0 < len(w.at) < 2000


def test_held_out_accuracy_on_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    got = T.op1_ftrl_toxicity(spark, folder).join(table(spark, folder, "labels"), "doc_id").collect()
    score = np.array([r.score for r in got])
    bad = np.array([r.toxic == 1 for r in got])
    out = np.array([r.held_out for r in got])
    assert 0 <= score.min() and score.max() <= 1
    ranks = [np.mean(score[out & ~bad] < s) for s in score[out & bad]]
    assert np.mean(ranks) > 0.75  # area under the curve, from under 300 labelled rows


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 7 == 3).cast("int").alias("toxic"))
    changed = labels.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.learn(docs, labels, SMALL), T.learn(docs, changed, SMALL)
    assert np.array_equal(a.at, b.at) and np.allclose(a.value, b.value)


def test_fit_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "fit", lambda rows, s: seen.append(rows.count()))
    docs = spark.createDataFrame([(i, "t") for i in range(4000)], "doc_id long, text string")
    T.learn(docs, docs.select("doc_id", F.lit(0).alias("toxic")), T.FtrlSettings(max_fit_rows=500))
    assert 350 < seen[0] <= 500


def test_the_fit_holds_few_rows_at_once(spark, tmp_path, monkeypatch):
    """A batch of coordinates is bounded by its bytes; 600 texts of 3,000 coordinates are 7 MB."""
    noted = str(tmp_path / "sizes")

    def note(rows, z, n, s):
        with open(noted, "a") as out:
            out.write(f"{sum(4 * len(at) for at, _ in rows)}\n")

    monkeypatch.setattr(T, "ftrl_pass", note)
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda k: F.concat(F.lit("word"), F.col("id") * 1000 + k)))
    docs = spark.range(600).select("id", text.alias("text"), F.lit(0).alias("label"))
    T.fit(docs, T.FtrlSettings(rounds=1, shards=1))
    sizes = [int(x) for x in open(noted)]
    assert sum(sizes) > 6_000_000 and max(sizes) < 5_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 1), (1, 0), (3, 0), (4, 1), (5, 0), (99, 1)]])
def test_awkward_rows(spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    w = T.learn(awkward(spark), known, SMALL)
    got = T.score(awkward(spark), w).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    kept = T.drop_toxic(awkward(spark), w, 2.0)
    assert kept.columns == awkward(spark).columns and kept.count() == 13
    assert T.drop_toxic(awkward(spark), w, 0.0).count() == 0
    assert T.score(empty(spark), w).count() == 0


def test_nothing_known_nothing_toxic(spark):
    w = T.learn(empty(spark), spark.createDataFrame([], "doc_id long, toxic int"), SMALL)
    assert all(r.score < 0.05 for r in T.score(awkward(spark), w).collect())
