import random
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from conftest import executed
from revmill.config import ReviewConfig
from revmill.functions import text as X
from revmill.operators.cleaning import clean_text
from revmill.operators.features import STOP_WORDS
from revmill.session import cut_lineage

CLEANED = [
    ("Visit https://x.co/a NOW, it's GREAT!!!", "visit now it's great"),
    ("Mail me: a.b@c.com please, thanks", "mail me please thanks"),
    ("Café déjà vu — très bon!", "caf d j vu tr s bon"),
    ("short", None),
    ("abcdefg hijklm", None),
    ("abcdefg hijklmn", "abcdefg hijklmn"),
    ("ＧＲＥＡＴ ｆｏｏｄ here ok", "great food here ok"),
    ("ﬁne dining experience", "fine dining experience"),
    ("ısırgan soup was very good", "ısırgan soup was very good"),
    ("İstanbul kebab was very good", "i stanbul kebab was very good"),
    ("!!! ??? ... --- !!!", None),
    ("''' ' '' '''''' ''''''", "''' ' '' '''''' ''''''"),
    (None, None),
    ("", None),
    (" \t\n ", None),
]


def clean(spark, texts, cfg=ReviewConfig()):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.out for r in clean_text(df, "text", "out", cfg).orderBy("i").collect()]


def test_cleaner_cases(spark):
    assert clean(spark, [c for c, _ in CLEANED]) == [w for _, w in CLEANED]


def test_cleaner_bounds(spark):
    texts = ["ab " * 4000, "x" * 9000, "x" * 8500 + " yz", "x" * 7999 + " " + "y" * 20]
    assert [len(t) for t in clean(spark, texts, ReviewConfig(max_chars=8000))] == [7997, 8000, 8000, 7999]
    assert [len(t) for t in clean(spark, texts)] == [11999, 9000, 8503, 8020]


def scanned(text):
    """What is left of a text, found by looking at its tokens and characters one by one."""
    words = []
    for token in unicodedata.normalize("NFKC", text).split():
        plain = "".join(c.lower() if c < "\x80" else c for c in token)
        marks = [(plain.find(m), len(m)) for m in ("http://", "https://", "www.")]
        while any(at >= 0 and at + size == len(plain) for at, size in marks):  # an address needs something after its mark
            marks = [(at, size) for at, size in marks if at + size != len(plain)]
        head = token[: min([at for at, _ in marks if at >= 0], default=len(token))]
        at_signs = [i for i, c in enumerate(head) if c == "@" and i > 0]
        if any(c == "." and j > i + 1 and j + 1 < len(head) for i in at_signs for j, c in enumerate(head)):
            continue
        word = ""
        for c in head.lower() + " ":
            if c.isascii() and (c.isalnum() or c == "'") or c == "ı":
                word += c
            elif word:
                words.append(word)
                word = ""
    out = " ".join(words)
    return out if len(out) >= 15 else None


PIECES = st.sampled_from(
    ["Good", " ", "  ", "\t", "\x1c", " ", " ", "@", ".", "a@b.c", "x@y", "@@a.b", "http://q.r/s",
     "HTTPS://Z", "www.", "WWW.k.l", "don't", "é", "é", "ı", "İ", "K", "ſ", "7",
     "①", "ﬁ", "-", "\x85", "　", "가", "가", "\U0001d400", "fine words here "]
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=150, max_size=150))
def test_cleaner_against_rules(spark, texts):
    got = clean(spark, texts)
    want = [scanned(t) for t in texts]
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []


def test_space_table_is_complete():
    assert set(X.SPACE_CHARS) | {" "} == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_stable_set_is_stable():
    assert len(X.NFKC_STABLE) > 500 and "\u00e9" in X.NFKC_STABLE
    chars = "".join(map(chr, range(128))) + X.NFKC_STABLE
    assert not any(unicodedata.combining(c) for c in chars)
    rng = random.Random(1)
    for _ in range(300):
        mixed = "".join(rng.choices(chars, k=500))
        assert unicodedata.normalize("NFKC", mixed) == mixed


@pytest.mark.parametrize(
    "raw, want",
    [("Food, Bars,food , ,Bars", "food, bars"), ("Restaurants", "restaurants"), (" , ,", None), (None, None),
     ("", None), ("\tA b , a b", "a b")],
)
def test_categories(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(X.normalise_categories(F.col("c"))).first()[0] == want


def test_suffix(spark):
    df = spark.createDataFrame([("a" * 5000,), ("a" * 5001,)], "c string")
    got = [r[0] for r in df.select(X.truncate_suffix(F.col("c"))).collect()]
    assert got == ["a" * 5000, "a" * 5000 + "... [truncated]"]


def test_native_words_equal_ml_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = cut_lineage(clean_text(docs, "text", "text").filter("text IS NOT NULL"))
    ml = Tokenizer(inputCol="text", outputCol="t").transform(docs)
    ml = StopWordsRemover(inputCol="t", outputCol="s").transform(ml)
    ml = NGram(n=2, inputCol="s", outputCol="b").transform(ml)
    kept = X.without(F.col("t2"), STOP_WORDS)
    both = ml.withColumn("t2", X.tokens(F.col("text"))).withColumn("s2", kept)
    both = both.withColumn("b2", X.bigrams(F.col("s2")))
    assert both.count() > 100
    assert both.filter("t <> t2 OR s <> s2 OR b <> b2").count() == 0


def test_stop_words_are_the_default_ones(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_filter_does_not_repeat_the_cleaning(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = clean_text(docs, "text", "clean").filter("clean IS NOT NULL")
    plan = executed(kept)
    assert plan.count("regexp_extract_all") == 1
    assert plan.count("ArrowEvalPython") == 1
