import random

import pytest
from cases import LONG, awkward, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from revmill.llm import decontam as D


def best_match(item, text):
    """Fewest edits of item against any stretch of text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        above, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[j - 1] + 1))
    return min(row)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def damaged(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[i] = rng.choice("xyz")
        elif kind == 1:
            del chars[i]
        else:
            chars.insert(i, rng.choice("xyz"))
    return "".join(chars)


def test_against_the_plain_table():
    rng = random.Random(4)
    items = [D.normalise(words(rng, rng.randint(4, 40))) for _ in range(12)]
    p = D.Patterns(list(range(12)), items)
    texts, near = [], 0
    for k in range(120):
        item = items[k % 12]
        budget = D.edit_budget(len(item))
        part = damaged(rng, item, rng.randint(0, 2 * budget + 1)) if k % 4 else ""
        texts.append(D.normalise(f"{words(rng, rng.randint(0, 30))} {part} {words(rng, rng.randint(0, 30))}"))
    found = {}
    for k, item, start, end, edits in D.find_matches(p, texts):
        found[k, item] = min(edits, found.get((k, item), 99))
        assert best_match(items[item], texts[k][start:end]) <= edits
    for k, text in enumerate(texts):
        for i, item in enumerate(items):
            least = best_match(item, text)
            if least <= D.edit_budget(len(item)):
                near += 1
                assert found.get((k, i)) == least
            else:
                assert (k, i) not in found
    assert near > 40


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab ", min_size=0, max_size=60), st.text(alphabet="ab ", min_size=9, max_size=30))
def test_small_alphabets(text, item):
    """Texts full of repeats give very many shared q-grams; nothing is lost."""
    item, text = D.normalise(item), D.normalise(text)
    if len(item) < D.Q:
        return
    p = D.Patterns([1], [item], rate=0.2)
    least = best_match(item, text)
    edits = [m[4] for m in D.find_matches(p, ["zz", text, "yy"])]
    assert (min(edits) == least) if least <= p.edits[0] else not edits


def test_spans_point_into_the_original(spark):
    item = "The quick brown fox jumps over the lazy dog, twice."
    text = "Intro — «THE QUICK  brown\nfox; jumps over the LAZY dog (twice)» end"
    bench = spark.createDataFrame([(7, item, "x")], "item_id long, text string, doc_id string")
    got = {r.doc_id: r for r in D.overlap_report(frame(spark, ["nothing here at all", text, f"{item} and {item}"]), bench).collect()}
    assert not got[0].contaminated and got[0].spans == []
    (s,) = got[1].spans
    assert text[s.start : s.end] == "THE QUICK  brown\nfox; jumps over the LAZY dog (twice" and s.edits == 0
    assert [x.item_id for x in got[2].spans] == [7, 7] and got[2].item_ids == [7]


def test_lower_case_that_grows():
    text = "İİ stanbul x"
    assert len(D.spans_of(text)) >= len(D.normalise(text)) - 2
    assert D.spans_of("a, B") == [(0, 1), (1, 3), (3, 4)]


def test_ties_short_and_null_items(spark):
    bench = spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, "Alpha, beta; gamma delta"), (3, "short"), (4, None), (5, ""), (None, "epsilon zeta eta theta")],
        "item_id long, text string",
    )
    docs = frame(spark, ["short alpha beta gamma delta", "short", None, "epsilon zeta eta theta"])
    got = {r.doc_id: r for r in D.overlap_report(docs, bench).collect()}
    assert got[0].item_ids == [1, 2] and not got[1].contaminated and not got[2].contaminated
    assert got[3].contaminated and got[3].item_ids == []


@pytest.mark.parametrize("blocks", [1, 3])
def test_awkward_rows(spark, monkeypatch, blocks):
    if blocks > 1:
        monkeypatch.setattr(D, "BLOCK_CHARS", 60)
        monkeypatch.setattr(D.pattern_blocks, "__defaults__", (D.ERROR_RATE, 60))
    tail = " ".join(LONG.split(" ")[-30:])
    bench = spark.createDataFrame([(1, "plain text with some words"), (2, tail)], "item_id long, text string")
    rows = D.overlap_report(awkward(spark), bench).collect()
    assert len(rows) == 13
    assert sorted(r.doc_id for r in rows if r.contaminated) == [1, 2, 2, 5, 6]
    kept = D.drop_contaminated(awkward(spark), bench)
    assert kept.columns == awkward(spark).columns and kept.count() == 8
    assert D.overlap_report(empty(spark), bench).count() == 0
    none = bench.limit(0)
    assert D.overlap_report(awkward(spark), none).where("contaminated").count() == 0
    assert D.drop_contaminated(awkward(spark), none).count() == 13


def test_query_against_search(spark, folder):
    """Whole small table: exact passages are found, and nothing is found that the plain table denies."""
    from revmill.llm.shelf import table

    items = {r.item_id: D.normalise(r.text) for r in table(spark, folder, "benchmark").collect()}
    texts = {r.doc_id: D.normalise(r.text) for r in table(spark, folder, "documents").collect()}
    got = {r.doc_id: set(r.item_ids) for r in D.op2_qgram_bands(spark, folder).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for i, text in texts.items():
        exact = {k for k, item in items.items() if item in text}
        assert exact <= got[i]
        some += len(exact)
        for k in got[i] - exact:
            assert best_match(items[k], text) <= D.edit_budget(len(items[k]))
    assert some
