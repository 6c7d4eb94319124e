import random
import zlib
from collections import Counter

import numpy as np
from cases import awkward, empty, frame
from conftest import optimized

from revmill.llm import variants as V


def edits(word, letters):
    """All words one edit away."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i + 1 :] for i in range(len(word))}
        out |= {word[:i] + c + word[i:] for i in range(len(word) + 1)}
    return out - {word}


def brute_force(counts):
    """word -> (form, root, n, n_near, form_n)"""
    letters = set("".join(counts))
    form, out = {}, {}
    for w, n in counts.items():
        near = [x for x in edits(w, letters) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = len(near)
    roots = {}
    for w in counts:
        top = w
        while form[top] is not None:
            top = form[top]
        roots[w] = top
    return {w: (form[w], roots[w], n, out[w], counts.get(form[w])) for w, n in counts.items()}


def table_of(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def grouped(spark, counts, symbols=V.SYMBOLS):
    return table_of(V.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), symbols))


def test_neighbours_of_reduced_words_are_whole_and_each_once():
    rng = random.Random(1)
    for _ in range(150):
        symbols, n = rng.randint(1, 5), rng.randint(1, 9)
        word = [rng.randint(1, symbols) for _ in range(n)]
        reduced = np.array([word], dtype=np.uint64)
        got = np.concatenate([key for _, key in V.neighbour_keys(reduced, symbols)]).tolist()
        text = "".join(map(str, word))
        want = {text} | edits(text, "123456789"[:symbols])
        keys = [int(V.own_keys(np.array([list(map(int, w))], dtype=np.uint64))[0]) if w else 0 for w in want]
        assert sorted(got) == sorted(keys)


def test_one_edit():
    rng = random.Random(2)
    words = ["".join(rng.choice("aé") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    for a in words:
        near = edits(a, "aé")
        for b in words:
            assert V.one_edit(a, b) == (b in near)


def test_groups_against_brute_force(spark):
    rng = random.Random(3)
    for letters, symbols in (("abcdefgh", 2), ("aàbé", 6), ("ab", 1)):
        counts = {}
        while len(counts) < (30 if letters == "ab" else 250):
            w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 7)))
            for x in [w, *rng.sample(sorted(edits(w, letters)), 3)]:
                counts.setdefault(x, int(3 * 2 ** (rng.random() * 8)))
        assert grouped(spark, counts, symbols) == brute_force(counts)


def test_long_chain_of_forms(spark):
    """Each word is one letter longer than the one before and twice as frequent; the last is the root of all."""
    counts = {"a" * (5 + i): 3 << i for i in range(40)}
    assert grouped(spark, counts) == brute_force(counts)


def test_ties_go_to_the_smaller_form(spark):
    got = grouped(spark, {"house": 3, "houses": 9, "mouse": 9, "èouse": 9})
    assert got["house"] == ("houses", "houses", 3, 3, 9) and got["mouse"] == (None, "mouse", 9, 2, None)


def test_awkward_vocabularies(spark):
    schema = "word string, n long"
    assert V.group_variants(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, 5), ("words", 2), ("words", 2), ("word", 9), ("x" * 30_000, 3), ("x" * 30_001, 7)]
    got = table_of(V.group_variants(spark.createDataFrame(rows, schema)))
    assert got["words"] == ("word", "word", 4, 1, 9)
    assert got["x" * 30_000][0] == "x" * 30_001 and len(got) == 4


def count_by_hand(rows):
    """The words of (doc_id, text) rows, some of them short of a letter."""
    import re

    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return dict(out)


def test_counting(spark, monkeypatch):
    monkeypatch.setattr(V, "COMBINE_WORDS", 40)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abÉß-XY×") for _ in range(rng.randint(1, 9))) for _ in range(80)) for _ in range(60)]
    docs = frame(spark, [*texts, None, "", "ÀÉÎÕÜ", "abcd"])
    got = {r.word: r.n for r in V.count_words(docs, noisy=True).collect()}
    assert got == count_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    plain = {r.word: r.n for r in V.count_words(frame(spark, ["Words words, WORDS short longer"])).collect()}
    assert plain == {"words": 3, "short": 1, "longer": 1}


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = {r.word: r.n for r in V.count_words(docs, noisy=True).collect()}
    assert got == count_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert V.count_words(empty(spark)).count() == 0


def test_query_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").filter("doc_id < 60")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    counts = count_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    want = brute_force({w: n for w, n in counts.items() if n >= 3})
    assert table_of(V.op11_reduced_alphabet(spark, str(tmp_path))) == want


def test_candidates_are_joined_by_key_and_never_all_with_all(spark):
    words = spark.createDataFrame([(1, "words", 3)], "id long, word string, n long")
    plan = optimized(V.near_words(words))
    assert "Cross" not in plan and plan.count("Join Inner") == 3
