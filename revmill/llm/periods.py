"""Periodic runs in texts: squares are caught online, word by word, and merge into runs.

A square is a stretch of words followed at once by itself; a run is a longest stretch with one smallest period. Words are
appended one at a time. Whenever the number of words is a multiple of a power of two, the block of that many
last words is complete and a catcher waits for it to come again. A square whose halves have p words holds a whole
block of 2^k words, 2^k <= p / 2 < 2^(k+1), in its first half, so its catcher sees that block again p words later. Then the
text before both places is compared from the end, which tells where the second half would end; at that word the rest is
compared and the square is reported. From there on it grows with every word that continues the period.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import record_batches, table

SPACE = r"[\x20\x09-\x0D]+"
MIN_LENGTH, MIN_EXPONENT = 6, 4  # what the query counts as a run
DIRECT = 64  # stretches up to this length are compared word by word, longer ones by their hash first
BASE, PRIME = 0x9E3779B97F4A7C1, (1 << 61) - 1


class Catchers:
    """Reports the squares of a text while it is appended; `runs` has (start, end, smallest period) of those that ended."""

    def __init__(self):
        self.text: list[int] = []
        self.waiting: dict[int, list[int]] = {}  # word -> ends of the complete blocks that it closes
        self.growing: list[tuple[int, int]] = []  # (period, start) of squares that reach the end of the text
        self.due: dict[int, dict[int, int]] = {}  # place -> period of a square that may end there -> place compared so far
        self.runs: list[tuple[int, int, int]] = []
        self.hashes, self.powers = [0], [1]

    def _hash(self, begin: int, end: int) -> int:
        hashes, powers, text = self.hashes, self.powers, self.text
        while len(hashes) <= end:
            hashes.append((hashes[-1] * BASE + text[len(hashes) - 1] + 1) % PRIME)
            powers.append(powers[-1] * BASE % PRIME)
        return (hashes[end] - hashes[begin] * powers[end - begin]) % PRIME

    def _same(self, a: int, b: int, length: int) -> bool:
        """Whether the stretches of this length that end before a and b are equal; long ones by hash."""
        if length > DIRECT:
            return self._hash(a - length, a) == self._hash(b - length, b)
        return self.text[a - length : a] == self.text[b - length : b]

    def _back(self, a: int, b: int, most: int) -> int:
        """How many words, `most` at most, are equal before the places a < b."""
        text, most = self.text, min(most, a)
        n = 0
        while n < most and n < 8:
            if text[a - n - 1] != text[b - n - 1]:
                return n
            n += 1
        step = 8
        while n + step <= most and self._same(a - n, b - n, step):
            n, step = n + step, 2 * step
        while step:
            if n + step <= most and self._same(a - n, b - n, step):
                n += step
            step >>= 1
        return n

    def _catch(self, period: int, last: int) -> None:
        """A square ends with word `last`: let it grow, unless its half is itself a repetition."""
        start = last - 2 * period + 1
        for p, begin in self.growing:
            # A run of a smaller period that covers one half and divides it, or the run itself.
            if period % p == 0 and begin <= last - period + 1:
                return
        self.growing.append((period, start))

    def _meet(self, ends: list[int], last: int) -> None:
        """Compare before the ends of known blocks and before word `last`, which is equal to their last words."""
        for end in ends:
            period = last - end
            if period < 4 or any(period % p == 0 and begin <= end + 1 for p, begin in self.growing):
                continue
            block = 1 << (period.bit_length() - 2)
            equal = self._back(end + 1, last + 1, period + 1)
            if equal == period:
                self._catch(period, last)
            elif block <= equal < period:
                places = self.due.setdefault(last + period - equal, {})
                places[period] = max(last, places.get(period, 0))

    def extend(self, words) -> None:
        text, waiting, due = self.text, self.waiting, self.due
        for word in words:
            last = len(text)
            if self.growing:
                still = []
                for period, start in self.growing:
                    if text[last - period] == word:
                        still.append((period, start))
                    else:
                        self.runs.append((start, last, period))
                self.growing = still
            text.append(word)
            if due:
                for period, compared in sorted(due.pop(last, {}).items()):
                    if text[last - period] == word and self._back(last + 1 - period, last + 1, last - compared) == last - compared:
                        # The hash has said that the halves are equal; now the words decide.
                        if text[last + 1 - period :] == text[last + 1 - 2 * period : last + 1 - period]:
                            self._catch(period, last)
            # Blocks of one word: halves of one, two and three words.
            if last and text[last - 1] == word:
                self._catch(1, last)
            if last > 2 and text[last - 2] == word and text[last - 3] == text[last - 1]:
                self._catch(2, last)
            if last > 4 and text[last - 3] == word and text[last - 5 : last - 3] == text[last - 2 : last]:
                self._catch(3, last)
            ends = waiting.get(word)
            if ends is not None:
                live = [e for e in ends if last - e < 4 * ((e + 1) & -(e + 1))]
                if live:
                    self._meet(live, last)
                if last & 1:
                    live.append(last)
                waiting[word] = live
            elif last & 1:
                waiting[word] = [last]

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs of at least two periods, in order of start and period."""
        self.runs += [(start, len(self.text), period) for period, start in self.growing]
        self.growing = []
        return sorted(self.runs, key=lambda r: (r[0], r[2]))


def find_runs(words: list, min_length: int = 2, min_exponent: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words with at least that length and that many periods."""
    catchers = Catchers()
    catchers.extend(map({}.setdefault, words, count()))
    found = ((start, end - start, p) for start, end, p in catchers.finish())
    return [r for r in found if r[1] >= max(min_length, min_exponent * r[2])]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equals the first, then the one with the smaller period."""
    best = None
    for start, length, period in runs:
        if best is None or (length * best[2], -start, -period) > (best[1] * period, -best[0], -best[2]):
            best = (start, length, period)
    return best


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that any run holds after its first period."""
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\x01" * (length - period)
    return [w for w, d in zip(words, dropped) if not d] if runs else words


RUN = "start: bigint, length: bigint, period: bigint"
RUNS = f"doc_id long, n_words long, runs array<struct<{RUN}>>, best struct<{RUN}>, collapsed string"


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) of every row and whole text.

    Words are maximal stretches without ASCII white space, numbered from 0. runs are in order of start and period; best is the
    strongest of them or null; collapsed has the words that stay, joined by one blank. Null and empty texts have no
    words, no runs and an empty collapsed text. Rows stay where they are: repeated rows and null ids are rows like others,
    other columns are not read. A task holds one text and its catchers, which take memory in proportion to its words.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(triple)), ("best", triple)]
            + [("collapsed", pa.binary())]
        )
        text_schema = schema.set(4, pa.field("collapsed", pa.string()))
        names = ("start", "length", "period")

        def rows():
            for batch in batches:
                for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                    words = text.split()  # of bytes: at ASCII white space only
                    runs = find_runs(words, min_length, min_exponent)
                    best = strongest(runs)
                    yield (
                        doc_id, len(words), [dict(zip(names, r)) for r in runs], best and dict(zip(names, best)),
                        b" ".join(collapse(words, runs)),
                    )

        for batch in record_batches(rows(), schema):
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(4).cast(pa.string())], schema=text_schema)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, RUNS)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, by the checksum of the id, repeat some of their words up to the end.

    A row without an id has no checksum and keeps its text, as do texts without words.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"),
    )
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), times)), F.lit(1), n - a)
    planted: Column = F.concat_ws(" ", F.slice("words", F.lit(1), a), tail)
    return chosen.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_dyadic_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# CRC-32 as a list of remainders for each byte, made from its polynomial, and folded over the bytes of a text.
SQL_CRC = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))"""


def sql_crc(numbers: str) -> str:
    """The CRC-32 of a list of byte values, as SQL over crc_table."""
    return f"""xor(list_reduce(list_concat([4294967295], {numbers}),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


LEVELS = 20  # the SQL names windows of up to 2^19 words, so it sees every run of texts of up to 2,000,000 words


def _sql_level(k: int) -> str:
    """Windows of 2^k words that come again in their text, and those that do so after 2^(k-1) to 2^k words.

    In a run of four periods each window of at least one period comes again just one period later.
    """
    size = 1 << k
    name = (
        "SELECT doc_id, i, hash(w) AS h FROM word" if k == 0 else
        f"SELECT a.doc_id, a.i, hash(a.h, b.h) AS h FROM again{k - 1} a JOIN again{k - 1} b"
        f" ON b.doc_id = a.doc_id AND b.i = a.i + {size // 2}"
    )
    return f"""again{k} AS MATERIALIZED (
  SELECT *, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS d FROM ({name})
  QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
stretch{k} AS (
  SELECT doc_id, min(i) AS start, max(i) - min(i) + {size} + d AS length, d AS period
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM again{k}
        WHERE d > {size // 2} AND d <= {size})
  GROUP BY doc_id, d, island)"""


SQL_OP13 = f"""
WITH {SQL_CRC},
doc AS (SELECT doc_id, text, crc AS h, crc // 10 AS g FROM (
  SELECT doc_id, text, {sql_crc("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c))")} AS crc
  FROM documents, crc_table)),
given AS (SELECT doc_id, h, g, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM doc),
sized AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN g % len(ws) END AS a FROM given),
planted AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM sized),
word AS MATERIALIZED (
  SELECT doc_id, i, ws[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM planted)),
{", ".join(_sql_level(k) for k in range(LEVELS))},
run AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(f"SELECT * FROM stretch{k}" for k in range(LEVELS))})
  WHERE length >= greatest(6, 4 * period)),
best AS (SELECT * FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS words
  FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
       period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
