import re

import pytest
import sentencepiece
from cases import awkward, empty

import corpus_pipeline as C
from revmill.llm import decontam, pieces, toxicity
from revmill.llm.shelf import stage, table


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Input and output of every stage over the whole small table."""
    docs, out = table(spark, folder, "documents"), {}
    for name, step in C.STAGES:
        after = stage(step(spark, docs, folder), "t-stage")
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps, spark, folder):
    for name, (before, after) in steps.items():
        if name != "encoding":
            assert after.schema.simpleString() == table(spark, folder, "documents").schema.simpleString()


def test_toxicity(steps, spark, folder):
    before, after = steps["toxicity"]
    w = toxicity.learn(before, table(spark, folder, "labels"))
    want = {r.doc_id for r in toxicity.score(before, w).collect() if r.score < toxicity.THRESHOLD}
    assert texts(after).keys() == want
    known = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    clean = [i for i in texts(before) if known.get(i) == 0]
    assert sum(i in want for i in clean) > 0.95 * len(clean)


def test_exact_dedup(steps):
    before, after = steps["exact_dedup"]
    best = {}
    for i, t in texts(before).items():
        best[t] = max(best.get(t, i), i)
    assert texts(after) == {i: t for t, i in best.items()}


def test_near_dedup(steps):
    before, after = steps["near_dedup"]
    left = texts(after)
    shingles = {}
    for i, t in texts(before).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        shingles[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    ids, partner = sorted(shingles), {}
    for k, a in enumerate(ids):
        for b in ids[:k]:
            j = len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
            if j >= 0.9:
                assert not (a in left and b in left)
            partner[a] = max(partner.get(a, 0), j)
            partner[b] = max(partner.get(b, 0), j)
    assert all(partner[i] >= 0.6 for i in ids if i not in left)


def test_near_dedup_is_exact(steps):
    """No two texts of 0.8 or more stay, and each that goes has such a partner that stays."""
    before, after = steps["near_dedup"]
    left, shingles = texts(after), {}
    for i, t in texts(before).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        shingles[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}

    def similar(a, b):
        return 5 * len(shingles[a] & shingles[b]) >= 4 * len(shingles[a] | shingles[b])

    kept = sorted(left)
    assert not any(similar(a, b) for k, a in enumerate(kept) for b in kept[:k])
    assert all(any(similar(a, b) for b in kept) for a in shingles if a not in left)


def test_decontamination(steps, spark, folder):
    before, after = steps["decontamination"]
    items = [decontam.normalise(r.text) for r in table(spark, folder, "benchmark").collect()]
    left = texts(after)
    for i, t in texts(before).items():
        holds = any(item in decontam.normalise(t) for item in items)
        assert not (holds and i in left)
    report = decontam.overlap_report(before, table(spark, folder, "benchmark")).where("NOT contaminated")
    assert {r.doc_id for r in report.collect()} == left.keys()


def test_encoding(steps):
    before, after = steps["encoding"]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = texts(before)
    got = {r.doc_id: r.ids for r in after.collect()}
    assert got == {i: library.encode(t) for i, t in want.items()}


def test_run_is_the_stages(steps, spark, folder):
    got = sorted(r.doc_id for r in C.run(spark, folder).collect())
    assert got == sorted(r.doc_id for r in steps["encoding"][1].collect())


def test_awkward_documents(spark, folder):
    for docs in (awkward(spark), empty(spark)):
        for name, step in C.STAGES:
            docs = stage(step(spark, docs, folder), "t-stage")
    for name, step in C.STAGES:
        step(spark, awkward(spark), folder).collect()
