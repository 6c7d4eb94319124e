import hashlib
import random
import time
import zlib

from cases import awkward, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from revmill.llm import periods as P


def brute_force(words, min_length=2, min_exponent=2):
    """Every maximal stretch for every period; of equal stretches the smallest period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= 2 * p:
                found.setdefault((i, length), p)
            i = max(j, i + 1)
    return sorted(
        ((s, n, p) for (s, n), p in found.items() if n >= max(min_length, min_exponent * p)), key=lambda r: (r[0], r[2])
    )


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_every_run_of_short_texts(words):
    assert P.find_runs(words) == brute_force(words)


def test_runs_of_longer_texts_with_long_periods(monkeypatch):
    rng = random.Random(1)
    for direct in (0, 8, 64):
        monkeypatch.setattr(P, "DIRECT", direct)
        for _ in range(40):
            words = []
            while len(words) < rng.randint(100, 600):
                words += [rng.randrange(40) for _ in range(rng.randint(1, 130))] * rng.randint(1, 5)
            assert P.find_runs(words) == brute_force(words)
            assert P.find_runs(words, 6, 4) == brute_force(words, 6, 4)


def test_appended_word_by_word():
    words = [0, 1, 2, 0, 1, 2, 0, 3, 3]
    one, whole = P.Catchers(), P.Catchers()
    for w in words:
        one.extend([w])
    whole.extend(words)
    assert one.finish() == whole.finish() == [(0, 7, 3), (7, 9, 1)]


def test_a_growing_square_is_known_before_it_ends():
    c = P.Catchers()
    c.extend([5, 6, 7, 8, 5, 6, 7])
    assert c.growing == []
    c.extend([8])
    assert c.growing == [(4, 0)] and c.runs == []


def test_long_repetitive_texts_take_little_more_than_linear_time():
    start = time.time()
    assert P.find_runs(["a"] * 60_000) == [(0, 60_000, 1)]
    assert P.find_runs(["a"] * 30_000 + ["b"] + ["a"] * 30_000, 6, 4) == [(0, 30_000, 1), (30_001, 30_000, 1)]
    assert P.find_runs([i % 7000 for i in range(60_000)], 6, 4) == [(0, 60_000, 7000)]
    assert time.time() - start < 60


def test_strongest_and_collapse():
    assert P.strongest([]) is None
    assert P.strongest([(0, 8, 2), (20, 12, 3), (40, 9, 2)]) == (40, 9, 2)
    assert P.strongest([(9, 8, 2), (3, 12, 3), (3, 4, 1)]) == (3, 4, 1)
    assert P.collapse(list("abababab"), [(0, 8, 2)]) == ["a", "b"]


def test_awkward_rows(spark):
    got = {}
    for r in P.periodic_runs(awkward(spark)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == 13 and len(got[2]) == len(got[None]) == 2
    assert [got[i][0].n_words for i in (3, 4, 7, 9, 10, 5)] == [0, 0, 0, 1, 1, 30_000]
    assert got[4][0].runs == [] and got[4][0].best is None and got[4][0].collapsed == ""
    assert [(tuple(x)) for x in got[8][0].runs] == []  # three copies are fewer than four
    assert [tuple(x) for x in P.periodic_runs(awkward(spark), 2, 2).filter("doc_id = 8").first().runs] == [(0, 12, 4)]
    assert P.periodic_runs(empty(spark)).count() == 0


def test_words_end_at_ascii_white_space_only(spark):
    row = P.periodic_runs(frame(spark, ["a b\x1c \x0b\x0cé x\t\r\n é"])).first()
    assert row.n_words == 3 and row.collapsed == "a b\x1c é x é"


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark, folder, tmp_path):
    rng = random.Random(3)
    texts = [" \n".join(rng.choice("ab éé".split()) for _ in range(rng.randint(0, 90))) for _ in range(150)] + [None, "", " "]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in P.op13_dyadic_squares(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = planted(i, (text or "").split())
        runs = brute_force(words, 6, 4)
        best = P.strongest(runs) or (None,) * 3
        assert (got[i].n_runs, got[i].start, got[i]["length"], got[i].period) == (len(runs), *best)
        assert got[i].exponent_milli == (best[0] is not None and 1000 * best[1] // best[2] or None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert got[i].runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        stay = [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]
        assert got[i].collapsed_sha256 == hashlib.sha256(" ".join(stay).encode()).hexdigest()


def test_planting_of_awkward_rows(spark):
    rows = P.with_planted_repeats(awkward(spark)).collect()
    assert len(rows) == 13 and sum(r.doc_id is None for r in rows) == 2
    assert {r.text for r in rows if r.doc_id is None} == {"no id here", ""}
