"""Spelling variants: words one edit apart, found through words over a reduced alphabet.

Letters are hashed to a few symbols, so each word has a reduced word. Words that differ by one inserted, deleted or replaced
letter have reduced words that are equal or differ in the same way. So the full one-edit neighbourhood of each reduced
word is generated and joined with the reduced words of the vocabulary; the pairs found are compared letter by letter.
Reduced words travel as polynomial hashes: those of all neighbours follow from the word's own in constant time
each, and a collision only costs a comparison. A filter of fixed size, made of the reduced words, keeps most neighbours that are none
of them out of the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.periods import SQL_CRC, sql_crc
from revmill.llm.shelf import remove, stage, table

SYMBOLS = 8  # size of the reduced alphabet: more symbols give more neighbours and fewer false candidates
FILTER_BITS, SEGMENT_BITS = 27, 19  # the broadcast filter has 2^27 bits (16 MiB), made in segments of 2^19
MIN_LETTERS, MIN_COUNT, FACTOR = 5, 3, 2
COMBINE_WORDS = 200_000  # distinct words that a task counts before it passes them on
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
MASK = (1 << 64) - 1


def count_words(docs: DataFrame, noisy: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all maximal runs of A-Z, a-z and U+00C0 to U+00FF in the texts, A-Z in lower case.

    With `noisy`, a run loses one letter where 97 divides the checksum of its id and itself; a null id counts as empty. Only words of
    MIN_LETTERS letters or more are counted. Words are counted within a task first, so a word that fills a third of
    all texts is a row for each buffer.
    """

    def run(batches: Iterator) -> Iterator:
        import re
        from zlib import crc32

        import pyarrow as pa

        letters = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+").findall
        held: dict[bytes, int] = {}

        def out():
            words = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                seed = crc32(doc_id)
                for word in letters(text.lower()):  # of bytes: A-Z only
                    if len(word) < MIN_LETTERS:
                        continue
                    if noisy and (h := crc32(word, seed)) % 97 == 0:
                        chars = word.decode()
                        at = h % len(chars)
                        word = (chars[:at] + chars[at + 1 :]).encode()
                    held[word] = held.get(word, 0) + 1
                if len(held) > COMBINE_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    rows = docs.select(
        key.cast("binary").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.char_length("word") >= MIN_LETTERS)


def reduce_letters(words: list[str], symbols: int) -> np.ndarray:
    """The symbol of each letter of words of one length, from 1: a hash of its code point."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    mixed = (code * np.uint64(BASE)) >> np.uint64(40)
    return (mixed % np.uint64(symbols) + np.uint64(1)).reshape(len(words), -1)


def powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, BASE, dtype=np.uint64)]))


def own_keys(reduced: np.ndarray) -> np.ndarray:
    return (reduced * powers(reduced.shape[1] - 1)).sum(axis=1, dtype=np.uint64)


def neighbour_keys(reduced: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of each reduced word itself and of all that one edit makes of it, each once.

    Of the edits that give the same word, as deleting either of two equal neighbours does, the last is taken.
    """
    rows, n = reduced.shape
    power, inverse = powers(n), np.uint64(pow(BASE, -1, 1 << 64))
    place = reduced * power[:n]
    before = np.concatenate([np.zeros((rows, 1), np.uint64), np.cumsum(place, axis=1, dtype=np.uint64)], axis=1)
    whole = before[:, -1:]
    after = whole - before
    every = np.arange(rows)
    yield every, whole[:, 0]
    last = np.ones((rows, n), dtype=bool)
    last[:, :-1] = reduced[:, :-1] != reduced[:, 1:]
    at = np.nonzero(last)
    yield at[0], (before[:, :-1] + after[:, 1:] * inverse)[at]
    for c in range(1, symbols + 1):
        put = power * np.uint64(c)
        other = np.nonzero(reduced != c)
        yield other[0], (whole - place + put[:n])[other]
        inserted = before + put + after * np.uint64(BASE)
        yield other[0], inserted[:, :n][other]
        yield every, inserted[:, n]


def _by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of words of one length, few enough that all their neighbours fit into memory."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    begin = 0
    for i in range(1, len(order) + 1):
        n = len(words[order[begin]])
        if i == len(order) or len(words[order[i]]) != n or (i - begin) * n > 40_000:
            yield order[begin:i]
            begin = i


def _keys(vocabulary: DataFrame, symbols: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(id, key) of the reduced words or, with a filter, of all in their neighbourhoods that it lets through."""
    neighbours = wanted is not None
    shared = vocabulary.sparkSession.sparkContext.broadcast(wanted) if neighbours else None

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits = shared.value if neighbours else None
        for batch in batches:
            ids = batch.column("id").to_numpy()
            words = batch.column("word").to_pylist()
            for places in _by_length(words):
                reduced, own = reduce_letters([words[i] for i in places], symbols), ids[places]
                found = neighbour_keys(reduced, symbols) if neighbours else [(np.arange(len(own)), own_keys(reduced))]
                for row, key in found:
                    if neighbours:
                        slot = key >> np.uint64(64 - FILTER_BITS)
                        known = np.nonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                        row, key = row[known], key[known]
                    for a in range(0, len(row), 100_000):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[row[a : a + 100_000]]), pa.array(key[a : a + 100_000].astype(np.int64))],
                            names=["id", "key"],
                        )

    return vocabulary.select("id", "word").mapInArrow(run, "id long, key long")


def key_filter(vocabulary: DataFrame, symbols: int = SYMBOLS) -> np.ndarray:
    """A bit for each value of the first FILTER_BITS bits of a key, set if a reduced word has it.

    Its size is fixed. It lets every neighbour through that is a reduced word, so no pair is lost; in a very large
    vocabulary it lets more of the others through, which the join then drops.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            for segment in np.unique(slot >> SEGMENT_BITS).tolist():
                place = slot[slot >> SEGMENT_BITS == segment] & ((1 << SEGMENT_BITS) - 1)
                bits = found.setdefault(segment, np.zeros(1 << (SEGMENT_BITS - 3), dtype=np.uint8))
                np.bitwise_or.at(bits, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
        for segment, bits in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.array([bits.tobytes()])], names=["segment", "bits"])

    slots = _keys(vocabulary, symbols).select(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("slot"))
    dealt = slots.repartition(1 << (FILTER_BITS - SEGMENT_BITS), F.shiftright("slot", SEGMENT_BITS))
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for segment, bits in dealt.mapInArrow(run, "segment long, bits binary").collect():
        begin = segment << (SEGMENT_BITS - 3)
        out[begin : begin + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return out


def one_edit(a: str, b: str) -> bool:
    """Whether just one letter is inserted, deleted or replaced between two words."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _verified(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ok = map(one_edit, batch.column("word").to_pylist(), batch.column("other").to_pylist())
            yield batch.filter(pa.array(list(ok), pa.bool_()))

    return pairs.mapInArrow(run, pairs.schema)


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(id, word, n, other_id, other, other_n): every ordered pair of words one edit apart, from a staged (id, word, n)."""
    pairs = _keys(vocabulary, symbols, key_filter(vocabulary, symbols)).join(
        _keys(vocabulary, symbols).select(F.col("id").alias("other_id"), "key"), "key"
    ).filter("id <> other_id")
    other = vocabulary.select(
        F.col("id").alias("other_id"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    # Both joins meet rows that were dealt for them, so a word with very many candidates can be split.
    full = pairs.select("id", "other_id").join(vocabulary, "id").join(other, "other_id")
    return _verified(full.select("id", "word", "n", "other_id", "other", "other_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) of all words that have a form: each round follows twice as many forms as the one before.

    A form has at least twice the count of its word, so there are at most log2(log2 of the largest count) + 1 rounds.
    """
    up = stage(forms.select("id", F.col("form_id").alias("root_id"), F.lit(True).alias("open")), "variant-roots")
    while not up.filter("open").isEmpty():
        above = up.select(F.col("id").alias("root_id"), F.col("root_id").alias("higher"))
        moved = up.join(above, "root_id", "left").select(
            "id", F.coalesce("higher", "root_id").alias("root_id"), F.col("higher").isNotNull().alias("open")
        )
        up, old = stage(moved, "variant-roots"), up
        remove(old)
    return up.select("id", "root_id")


def group_variants(counted: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a counted vocabulary (word, n).

    A word is near another if one edit of a letter makes it of it. Its form is the near word of the largest count, of equals the
    smallest, if that has FACTOR times its own count or more; its root is where the forms lead. form and form_n are null
    for a word without a form; a word without near words has n_near 0. Null words are left out; a word listed twice
    counts once, with its counts added. An empty vocabulary gives no rows.
    """
    words = counted.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = stage(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "variant-words")
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other", "other_id"))
    near = near_words(vocabulary, symbols).groupBy("id", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    has_form = -F.col("best.order") >= FACTOR * F.col("n")
    near = stage(
        near.select(
            "id", "n_near", *(F.when(has_form, F.col(c)).alias(a) for c, a in (("best.other", "form"), ("best.other_id", "form_id"))),
            F.when(has_form, -F.col("best.order")).alias("form_n"),
        ),
        "variant-near",
    )
    roots = stage(_roots(near.filter("form_id IS NOT NULL").select("id", "form_id")), "variant-tops")
    named = roots.join(vocabulary.select(F.col("id").alias("root_id"), F.col("word").alias("root")), "root_id")
    return (
        vocabulary.join(near, "id", "left").join(named.select("id", "root"), "id", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )


def op11_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_words(table(spark, sf_dir, "documents"), noisy=True)
    return group_variants(counted.filter(F.col("n") >= MIN_COUNT))


SQL_OP11 = f"""
WITH RECURSIVE {SQL_CRC},
token AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS raw FROM documents),
lower_token AS (
  SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM token
  WHERE length(raw) >= {MIN_LETTERS}),
checked AS (
  SELECT run, {sql_crc("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))")} AS h
  FROM lower_token, crc_table),
result AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word
  FROM checked),
vocab AS MATERIALIZED (
  SELECT word, count(*) AS n FROM result WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING count(*) >= {MIN_COUNT}),
cut AS MATERIALIZED (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN vocab b ON a.rest = b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM vocab a JOIN cut b ON a.word = b.rest),
best AS (
  SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word, n),
form AS MATERIALIZED (
  SELECT word, n_near, CASE WHEN other_n >= {FACTOR} * n THEN other END AS form,
         CASE WHEN other_n >= {FACTOR} * n THEN other_n END AS form_n FROM best),
climb AS (
  SELECT word, word AS top FROM vocab
  UNION ALL SELECT c.word, f.form FROM climb c JOIN form f ON f.word = c.top WHERE f.form IS NOT NULL),
root AS (
  SELECT c.word, c.top AS root FROM climb c LEFT JOIN form f ON f.word = c.top WHERE f.form IS NULL)
SELECT v.word, f.form, r.root, v.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n
FROM vocab v LEFT JOIN form f USING (word) JOIN root r USING (word)
"""
