import hashlib
import random

import numpy as np
import pytest
from cases import awkward, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revmill.llm import merges as M


@pytest.fixture(scope="module")
def merges():
    return M.Merges.load()


@pytest.fixture(scope="module")
def encoder(merges):
    return M.Encoder(merges)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path(M.MODEL))


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype=np.int32).tolist()


def test_every_character(encoder, library):
    wrong = []
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or (c > 0x3FFFF and c % 997):
            continue
        text = f"a{chr(c)}B 1{chr(c)}{chr(c)}"
        if ids(encoder, text) != library.encode(text, add_special_tokens=False).ids:
            wrong.append(hex(c))
    assert wrong == []


TEXT = st.text(alphabet="abcdetheing'’ \n\t\x1f éÉßΣςİ漢😀ﬁ0١½.,<|>", max_size=40)
SPECIAL = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", "don't", "é", " "])
KNOWN: dict = {}


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT | SPECIAL, max_size=6).map("".join))
def test_same_ids_and_text_as_the_library(text):
    if not KNOWN:
        import public_tokenizers

        merges = M.Merges.load()
        KNOWN.update(e=M.Encoder(merges), d=M.Decoder(merges, True), l=Tokenizer.from_file(public_tokenizers.path(M.MODEL)))
    got = ids(KNOWN["e"], text)
    assert got == KNOWN["l"].encode(text, add_special_tokens=False).ids
    assert KNOWN["d"].decode(got) == "".join(KNOWN["d"].stream(got)) == KNOWN["l"].decode(got, skip_special_tokens=False)


def long_words():
    rng = random.Random(4)
    letters = "etaoinshrdlu"
    for i in range(120):
        unit = "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))
        yield (unit * 3000)[: rng.randint(900, 3000)] if i % 2 else "".join(rng.choice(letters) for _ in range(2500))


def test_long_words_are_emitted_in_portions(merges, encoder, library):
    for word in long_words():
        assert ids(encoder, word) == library.encode(word, add_special_tokens=False).ids
        machine, most, out = M.Transducer(merges), 0, []
        for c in word:
            out += machine.feed(c)
            most = max(most, len(machine.held))
        out += machine.finish()
        assert most <= machine.full + M.STEP and out == merges.merge([*word[:-1], word[-1] + merges.word_end])


def test_lookahead_is_sufficient():
    """In small merge lists, at random, no continuation changes a token that ends further back than the lookahead."""
    rng = random.Random(9)
    for _ in range(300):
        tokens, pairs = list("ab"), []
        for _ in range(rng.randint(1, 8)):
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair[0] + pair[1] not in tokens:
                pairs.append(pair)
                tokens.append(pair[0] + pair[1])
        m = M.Merges({}, pairs, "", {})
        for _ in range(60):
            text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))
            more = text + "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
            end, other = 0, m.merge(list(more))
            for i, token in enumerate(m.merge(list(text))):
                end += len(token)
                if end > len(text) - m.lookahead:
                    break
                assert other[i] == token


def test_lookahead_of_the_given_list(merges):
    assert merges.longest < merges.lookahead < 2000


def test_merging_with_a_heap_is_the_same(merges):
    rng = random.Random(6)
    for _ in range(300):
        symbols = [rng.choice("etainshr") for _ in range(rng.randint(1, M.FEW))]
        assert merges.merge(symbols) == merges._merge_many(symbols)


def test_merging_by_ids_is_the_same(merges, encoder):
    rng = random.Random(8)
    for size in (1, 2, 5, 12, M.FEW):
        words = ["".join(rng.choice("etainshr") for _ in range(size)) for _ in range(200)]
        want = []
        for word in words:
            tokens = merges.merge([*word[:-1], word[-1] + merges.word_end])
            want.append([merges.ids[t] for t in tokens])
        got = dict(encoder._merge_all([w.encode() for w in words]))
        assert [np.frombuffer(got[i], dtype=np.int32).tolist() for i in range(200)] == want


def test_lists_out_of_order_are_refused():
    with pytest.raises(ValueError):
        M.Merges({}, [("ab", "c"), ("a", "b")], "", {})


def test_words_are_forgotten_and_learned_again(merges, library, monkeypatch):
    monkeypatch.setattr(M, "KNOWN_WORDS", 5)
    e = M.Encoder(merges)
    for text in ("one two three four five", "six seven one two"):
        assert ids(e, text) == library.encode(text, add_special_tokens=False).ids
    assert len(e.known) <= 5


def test_words_are_looked_up_once_in_a_batch(merges, library, monkeypatch):
    monkeypatch.setattr(M, "KNOWN_WORDS", 5)
    slow, word_ids = [], M.Encoder.word_ids
    monkeypatch.setattr(M.Encoder, "word_ids", lambda self, word: slow.append(word) or word_ids(self, word))
    e, long = M.Encoder(merges), "etaoinshrdlu" * 5
    for text in (f"one two {long} {long}", f"one three four five {long}", "one two"):
        assert ids(e, text) == library.encode(text, add_special_tokens=False).ids
    assert slow == [long, long] and long not in e.known and long not in e.older


def test_plain_decoding(merges, encoder):
    d = M.Decoder(merges, False)
    assert d.decode(ids(encoder, "Déjà vu, 漢字 😀!")) == "déjà vu , 漢字 😀! "
    half = ids(encoder, "𒀀")[:1]
    assert "".join(d.stream(half)) == "�" == d.decode(half)
    pieces = list(d.stream(ids(encoder, "漢")))
    assert "".join(pieces).strip() == "漢" and len(pieces) > 2 and pieces[0] == ""


def test_awkward_rows(spark, merges, library):
    tokens = M.encode(awkward(spark), merges)
    rows = {}
    for r in M.decode(tokens, merges, spelled=True).collect():
        rows.setdefault(r.doc_id, []).append(r)
        assert r.text == library.decode(r.ids, skip_special_tokens=False)
    assert sum(map(len, rows.values())) == 13 and len(rows[2]) == len(rows[None]) == 2
    assert rows[3][0].ids == rows[4][0].ids == rows[7][0].ids == []
    assert rows[10][0].ids == library.encode("x" * 100_000, add_special_tokens=False).ids
    assert M.encode(empty(spark), merges).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert M.decode(nothing, merges).first().text == ""


def test_query_against_the_library(spark, folder, library, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = frame(spark, [None, "", " ", "<|endoftext|> 😀", "x" * 5000], first=10_000)
    docs.select("doc_id", "text").union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    got = M.op12_bounded_lookahead(spark, str(tmp_path)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        decoded = library.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
