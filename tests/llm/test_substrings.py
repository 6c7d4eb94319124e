import hashlib
import re

import numpy as np
import pytest
from cases import awkward, empty, frame

from revmill.llm import substrings as B


def brute(rows, length):
    """rows: (id, text). Per row the kept words and the largest repeated level."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    out = []
    for i, words in split:
        gone, longest, size = set(), 0, length
        while size <= len(words):
            earlier = {
                tuple(w[k : k + size]) for j, w in split if j is not None and (i is None or j < i)
                for k in range(len(w) - size + 1)
            }
            hits = [k for k in range(len(words) - size + 1) if tuple(words[k : k + size]) in earlier]
            if size == length:
                for k in hits:
                    gone.update(range(k, k + size))
            if hits:
                longest = size
            size *= 2
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone), longest))
    return out


def found(df):
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_text, r.words_sha256, r.longest) for r in df.collect()]


def same(got, want):
    def key(x):
        return (x[0] is None, x[0] or 0, *x[1:])

    done = []
    for i, n, removed, text, digest, longest in got:
        kept = digest if text is None else hashlib.sha256(text.encode()).hexdigest()
        done.append((i, n, removed, kept, longest))
    wanted = [(i, n, removed, hashlib.sha256(t.encode()).hexdigest(), longest) for i, n, removed, t, longest in want]
    assert sorted(done, key=key) == sorted(wanted, key=key)


def test_anchors_lie_in_every_window():
    rng = np.random.default_rng(0)
    for n in (1, 5, 40):
        h = rng.integers(0, 6, 200).astype(np.uint64)
        at = set(B.anchors(h, n).tolist()) if n <= 200 else set()
        assert all(at & set(range(i, i + n)) for i in range(200 - n + 1))


def test_window_hashes_depend_on_the_words_alone():
    w = B.Words()
    words = [b"a", b"b", b"c"] * 30
    for which in (0, 1):
        h = w.windows(w.hashes(words, which), 10, which)
        assert len(set(h.tolist())) == 3 and (h[:3] == h[3:6]).all()
        assert (w.windows(w.hashes(words[1:], which), 10, which) == h[1:]).all()


@pytest.mark.parametrize("length", [2, 5, 8])
def test_against_brute_force(spark, length):
    rng = np.random.default_rng(length)
    texts = []
    for _ in range(50):
        words = [f"w{k}" for k in rng.integers(0, 40, rng.integers(0, 40))]
        if texts and rng.random() < 0.7:
            other = texts[rng.integers(0, len(texts))].split()
            a = rng.integers(0, len(other) + 1)
            words[rng.integers(0, len(words) + 1) :] = other[a : a + rng.integers(0, 40)]
        texts.append(" ".join(words))
    texts += [texts[3], "", "a a a a a a a a a a a a a a a a a a a a", "a a a a a a a a a a"]
    same(found(B.remove_repeats(frame(spark, texts).repartition(4), length)), brute(list(enumerate(texts)), length))


def test_a_passage_in_very_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"x{i} {passage} y{i}" for i in range(300)]
    got = sorted(found(B.remove_repeats(frame(spark, texts).repartition(6))))
    assert [r[2] for r in got] == [0] + [60] * 299
    assert got[7][3] == "x7 y7" and {r[5] for r in got[1:]} == {50}


def test_awkward_rows(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    got = found(B.remove_repeats(awkward(spark)))
    assert len(got) == 13
    by_id = {r[0]: r for r in got}
    assert by_id[5][2] == 0 and by_id[6][2] == 30_000 and by_id[6][3] == ""
    assert [r[2] for r in got if r[0] == 2] == [0, 0] and by_id[10][1:3] == (1, 0) and by_id[4][1:3] == (0, 0)
    assert sum(r[1] for r in got) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows)
    assert found(B.remove_repeats(empty(spark))) == []


def test_rows_that_share_an_id_or_have_none(spark):
    a, b = " ".join(f"a{i}" for i in range(12)), " ".join(f"b{i}" for i in range(12))
    rows = [(1, a), (1, f"{a} tail"), (2, f"{b} {a}"), (None, b), (None, f"{b} {b}"), (3, a), (3, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(found(B.remove_repeats(df, 6)), brute(rows, 6))


def test_without_longest_the_rest_is_the_same(spark):
    rng = np.random.default_rng(5)
    passage = [" ".join(f"p{i}{k}" for k in rng.integers(0, 900, n)) for i, n in enumerate((49, 50, 51, 70, 120))]
    texts = [" ".join([f"w{k}" for k in rng.integers(0, 99, 30)] + [passage[n % 5], f"end{n}"]) for n in range(30)]
    docs = frame(spark, [*texts, texts[2], "", None]).repartition(4)
    want = brute(list(enumerate([*texts, texts[2], "", None])), 50)
    got = B.remove_repeats(docs, longest=False)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text", "words_sha256"]
    level = {i: longest for i, _, _, _, longest in want}
    same([(*r, level[r.doc_id]) for r in got.collect()], want)
    assert sum(r.n_removed > 0 for r in got.collect()) == 21  # five of each passage of 50 words or more, and the copy
