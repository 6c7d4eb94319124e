import glob
import math
import os
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import awkward, empty
from pyspark.sql import functions as F

from revmill.llm import scoring as L


def plain(texts, target, s):
    """Losses by dictionaries, with no hashing."""
    split = [L.tokens(t or "") for t in texts]
    top = sorted(Counter(w for t in split for w in t).items(), key=lambda x: (-x[1], x[0]))[: s.vocabulary]
    known = {w for w, _ in top}
    size = len(top) + 3
    rows = [["<s>", *(w if w in known else "<unk>" for w in t), "</s>"] for t in split]

    def model(chosen):
        uni, bi, context = Counter(), Counter(), Counter()
        for r in chosen:
            uni.update(r[1:])
            bi.update(zip(r, r[1:]))
            context.update(r[:-1])
        total = sum(uni.values())

        def loss(row):
            out = []
            for a, b in zip(row, row[1:]):
                p = (uni[b] + s.add) / (total + s.add * size)
                if context[a]:
                    p = s.bigram_weight * bi[a, b] / context[a] + (1 - s.bigram_weight) * p
                out.append(-math.log(p))
            return sum(out) / len(out)

        return loss

    every, good = model(rows), model([r for r, t in zip(rows, target) if t])
    return [(good(r), every(r)) for r in rows]


@pytest.mark.parametrize("bound", [2_000_000, 3])
def test_against_plain_counting(spark, monkeypatch, bound):
    """With target ids sent to the tasks, and with more of them than may be."""
    monkeypatch.setattr(L, "BROADCAST_IDS", bound)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.5, rng.integers(0, 40)) if k < 500) for _ in range(80)] + ["", None]
    target = [i % 3 == 0 for i in range(82)]
    s = L.LmSettings(vocabulary=50)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    ids = spark.createDataFrame([(i,) for i in range(82) if target[i]] + [(0,), (None,), (999,)], "doc_id long")
    want = plain(texts, target, s)
    got = L.cross_entropy_difference(docs, ids, s).collect()
    assert len(got) == 82
    for r in got:
        assert np.allclose((r.target_loss, r.background_loss), want[r.doc_id], rtol=1e-4)
        assert abs(r.score - (r.target_loss - r.background_loss)) < 1e-9


def test_the_target_scores_lower(spark):
    rows = [(i, " ".join(f"{'good' if i % 4 == 0 else 'other'}{(i * 7 + k) % 30}" for k in range(20))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = L.cross_entropy_difference(docs, docs.where("doc_id % 8 = 0").select("doc_id")).collect()
    good = [r.score for r in got if r.doc_id % 4 == 0]
    assert max(good) < min(r.score for r in got if r.doc_id % 4)


def test_awkward_rows(spark):
    for ids in ([], [1, 5]):
        chosen = spark.createDataFrame([(i,) for i in ids], "doc_id long")
        got = L.cross_entropy_difference(awkward(spark), chosen).collect()
        assert len(got) == 13
        assert all(math.isfinite(r.score) and r.n_tokens >= 1 for r in got)
        assert [r.n_tokens for r in got if r.doc_id in (3, 4)] == [1, 1]
    assert L.cross_entropy_difference(empty(spark), chosen).count() == 0


def test_ties_at_the_end_of_the_vocabulary(spark):
    docs = spark.createDataFrame([(1, "b a d c b"), (2, None)], "doc_id long, text string")
    assert L.vocabulary(docs, L.LmSettings(vocabulary=3)) == ["b", "a", "c"]


def test_query_separates_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = L.op10_cross_entropy_difference(spark, folder).join(labels, "doc_id").groupBy("quality").agg(F.avg("score").alias("s"))
    mean = {r.quality: r.s for r in got.collect()}
    assert mean[1] < mean[0]


@pytest.mark.parametrize("head", [400_000, 40, 0])
def test_every_word_and_bigram_counts(spark, monkeypatch, head):
    """No word is unknown by default, and no two bigrams share a count, wherever their losses are looked up."""
    monkeypatch.setattr(L, "HEAD", head)
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(k)}" for k in rng.integers(0, 70_000, 1500)) for _ in range(60)] + ["w1 w2 " * 50, None]
    target = [i % 4 == 0 for i in range(62)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    ids = spark.createDataFrame([(i,) for i in range(62) if target[i]], "doc_id long")
    want = plain(texts, target, L.LmSettings())
    for r in L.cross_entropy_difference(docs, ids).collect():
        assert np.allclose((r.target_loss, r.background_loss), want[r.doc_id], rtol=1e-9)
        assert r.n_tokens == len(L.tokens(texts[r.doc_id] or "")) + 1


def test_more_words_than_a_fixed_width(spark):
    """The words of the last text are rarer than 70,000 others; they keep counts of their own."""
    texts = [" ".join(f"w{k}" for k in range(70_000))] * 2 + ["zz1 zz2 zz1 zz2 zz3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = spark.createDataFrame([(2,)], "doc_id long")
    want = plain(texts, [False, False, True], L.LmSettings())
    for r in L.cross_entropy_difference(docs, ids).collect():
        assert np.allclose((r.target_loss, r.background_loss), want[r.doc_id], rtol=1e-9)


@pytest.mark.parametrize("head", [400_000, 3])
def test_rare_words_are_joined(spark, monkeypatch, head):
    """Few words go to the tasks; rows that repeat, have no id or share one with another text keep their own scores."""
    monkeypatch.setattr(L, "HEAD_WORDS", 5)
    monkeypatch.setattr(L, "HEAD", head)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, 60) if k < 300) for _ in range(40)]
    ids = [*range(40), 7, 7, None, None, 9, None]
    texts += [texts[7], texts[7], texts[7], "w1 w1 w1 w2", "once only here", None]
    target = [i is not None and i % 3 == 1 for i in ids]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
    chosen = spark.createDataFrame([(i,) for i in range(40) if i % 3 == 1], "doc_id long")
    want = plain(texts, target, L.LmSettings())
    got = L.cross_entropy_difference(docs, chosen, L.LmSettings(chunk=100, flush=50)).collect()

    def rows(found):
        return sorted((i is None, i or 0, round(t, 8), round(e, 8)) for i, t, e in found)

    assert rows((r.doc_id, r.target_loss, r.background_loss) for r in got) == rows((i, *w) for i, w in zip(ids, want))


def test_words_with_equal_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(L, "HEAD_WORDS", 1)
    monkeypatch.setattr(L, "rare_number", lambda word: F.lit(-5).cast("long"))
    docs = spark.createDataFrame([(1, "a a a b c b d"), (2, "a d c")], "doc_id long, text string")
    want = plain(["a a a b c b d", "a d c"], [True, False], L.LmSettings())
    for r in L.cross_entropy_difference(docs, docs.where("doc_id = 1").select("doc_id")).collect():
        assert np.allclose((r.target_loss, r.background_loss), want[r.doc_id - 1], rtol=1e-9)


def test_counts_of_frequent_words_are_no_table_of_the_driver(spark, monkeypatch):
    rare = spark.createDataFrame([(-5, 7, 2)], "number long, every long, target long")
    pairs = spark.createDataFrame([(3, -5), (1, 3), (-5, 0)], "a long, b long")
    words = L.Words(["x"], False, np.array([9, 9, 0, 40]), np.array([4, 4, 0, 30]), rare, {"every": 65, "target": 40}, 5)

    def refuse(*args, **kwargs):
        raise AssertionError("the driver makes a table")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    got = {tuple(r) for r in L.with_counts(pairs, words).select("a", "b", "c_every", "c_target", "n_every", "n_target").collect()}
    assert got == {(3, -5, 40, 30, 7, 2), (1, 3, 9, 4, 40, 30), (-5, 0, 7, 2, 9, 4)}


def test_tasks_are_handed_small_batches(spark, folder, monkeypatch):
    name, seen, stage = "spark.sql.execution.arrow.maxBytesPerBatch", [], L.stage
    monkeypatch.setattr(L, "stage", lambda df, label: seen.append(spark.conf.get(name, None)) or stage(df, label))
    assert L.op10_cross_entropy_difference(spark, folder).count() > 0
    assert len(seen) > 3 and set(seen) == {str(L.BATCH_BYTES)}
    assert spark.conf.get(name, None) is None


def test_chunks_and_batches_do_not_change_counts(spark, monkeypatch):
    texts = [f"a b c {i % 7} a b" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    good = docs.where("doc_id % 3 = 0").select("doc_id")
    got = []
    for chunk, limit in ((1_000_000, 1 << 21), (40, 200), (7, 1 << 21)):
        monkeypatch.setattr(L, "BATCH_BYTES", limit)
        rows = L.cross_entropy_difference(docs, good, L.LmSettings(chunk=chunk)).collect()
        got.append({r.doc_id: (r.n_tokens, round(r.score, 9)) for r in rows})
    assert got[0] == got[1] == got[2] and len(got[0]) == 60


@pytest.mark.parametrize("sample", [20_000, 5, 0])
def test_the_sample_changes_no_result(spark, monkeypatch, sample):
    """Frequent words and bigrams that the sample misses are counted all the same."""
    monkeypatch.setattr(L, "SAMPLE", sample)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.3, 80) if k < 400) for _ in range(60)] + ["zz1 zz2 " * 9, "zz1 zz2", None, ""]
    target = [i % 3 == 1 for i in range(64)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = plain(texts, target, L.LmSettings())
    got = L.cross_entropy_difference(docs, docs.where("doc_id % 3 = 1").select("doc_id")).collect()
    assert len(got) == 64
    for r in got:
        assert np.allclose((r.target_loss, r.background_loss), want[r.doc_id], rtol=1e-9)


def test_no_key_is_cut_in_two():
    keys = np.sort(np.random.default_rng(5).zipf(1.5, 500) % 40)
    batch = pa.record_batch({"key": keys, "at": np.arange(500)})
    for most in (1, 20, 1000):
        parts = list(L.whole_groups(iter([batch.slice(i, 7) for i in range(0, 500, 7)]), most))
        assert np.concatenate([p[1] for p in parts]).tolist() == list(range(500))
        assert sum(len(set(p[0])) for p in parts) == len(set(keys))
    assert list(L.whole_groups(iter([]), 20)) == []


def test_tokens_are_words_and_signs():
    texts = ["Don't STOP, x_1... été  b\x1cc", "", " ", "!?", "İstanbul ΣΑΣ", "a​b \U0001f600c"]
    texts += [f"a{chr(c)}b" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert [L.tokens(t) for t in texts] == [re.findall(r"\w+|[^\w\s]", t.lower()) for t in texts]


def test_shuffle_files_go_when_an_action_ends(spark, folder):
    """They stayed until the driver collected garbage: all exchanges of the query lay on the disk at once."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = [f for d in disk.localDirs() for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)]
        return {f for f in found if os.path.getsize(f) > 0}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    value, before = spark.conf.get(name, None), files()
    result = L.op10_cross_entropy_difference(spark, folder)
    for _ in range(50):  # they are removed in the background
        left = files() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(name, None) == value
    assert result.count() > 0
