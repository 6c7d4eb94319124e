"""Benchmark decontamination: q-gram counts in diagonal bands, then banded alignment of the regions that pass."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import keep_rows, record_batches, table, text_or_empty

WORD = re.compile(r"[^\W_]+")
Q = 8  # characters of a q-gram; eight one-byte codes fill one 64-bit number
TABLE_BITS = 22
ERROR_RATE = 0.1
BLOCK_CHARS = 4_000_000  # benchmark characters that one pass over the documents holds and broadcasts
BATCH_CHARS = 2_000_000


def normalise(text: str) -> str:
    """Lower case; letters and digits stay, whatever is between them is one blank."""
    return " ".join(WORD.findall(text.lower()))


def spans_of(text: str) -> list[tuple[int, int]]:
    """For each character of normalise(text) the start and end, in text, of what it stands for."""
    out: list[tuple[int, int]] = []
    for i, c in enumerate(text):
        low = c.lower()
        if WORD.match(low):
            if out and out[-1][1] < i:
                out.append((out[-1][1], i))
            # A character whose lower case has several stands for each that is kept.
            out += [(i, i + 1)] * len("".join(WORD.findall(low)))
    return out


def codes(text: str) -> np.ndarray:
    """A byte for each character. Different characters may share one, which only lets more regions through."""
    return (np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) & 0xFF).astype(np.uint8)


def grams(code: np.ndarray) -> np.ndarray:
    """The q-gram that starts at each place, as one number."""
    if len(code) < Q:
        return np.zeros(0, dtype=np.uint64)
    return np.ndarray((len(code) - Q + 1,), dtype="<u8", buffer=np.ascontiguousarray(code), strides=(1,))


def slot(gram: np.ndarray) -> np.ndarray:
    return ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def edit_budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed in a passage of this length: the rate, or fewer if the q-gram lemma would then ask for no q-gram."""
    return max(0, min(int(length * rate), (length - Q) // Q))


def least_shared(length: int, edits: int) -> int:
    """The q-gram lemma: a region within so many edits shares at least this many q-grams."""
    return length - Q + 1 - edits * Q


@dataclass
class Patterns:
    """Normalised benchmark items with an index of their q-grams."""

    ids: list[int]
    texts: list[str]
    rate: float = ERROR_RATE
    key: np.ndarray = field(init=False)
    item: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)

    def __post_init__(self):
        own = [grams(codes(t)) for t in self.texts]
        key = np.concatenate([np.zeros(0, np.uint64), *own])
        item = np.repeat(np.arange(len(own)), [len(g) for g in own])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in own]])
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place = key[order], item[order], place[order]
        self.bitmap = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.bitmap[slot(self.key)] = True
        self.edits = np.array([edit_budget(len(t), self.rate) for t in self.texts], dtype=np.int64)
        self.least = np.array([least_shared(len(t), k) for t, k in zip(self.texts, self.edits)], dtype=np.int64)
        # The diagonals of a match lie within its edits of each other. Bands of an item start every `width` diagonals and
        # are longer by its budget, so they overlap and any match lies in one of them whole.
        self.width = np.maximum(16, self.edits + 1)

    def candidates(self, text: str) -> list[tuple[int, int]]:
        """(item, first diagonal of a band) of the bands that share enough q-grams with the item."""
        gram = grams(codes(text))
        at = np.flatnonzero(self.bitmap[slot(gram)])
        low = np.searchsorted(self.key, gram[at], side="left")
        many = np.searchsorted(self.key, gram[at], side="right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        if not len(at):
            return []
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        item = self.item[entry]
        place = self.place[entry]
        diagonal = np.repeat(at, many) - place + (1 << 20)
        band, inside = np.divmod(diagonal, self.width[item])
        again = inside < self.edits[item]
        item, band, place = (
            np.concatenate([x, y]) for x, y in ((item, item[again]), (band, band[again] - 1), (place, place[again]))
        )
        # A cheap upper bound of the counts first, the exact counts only where that may suffice.
        cell = (band * 0x9E3779B1 + item * 0x85EBCA6B) & 0xFFFFF
        may = np.bincount(cell, minlength=1 << 20)[cell] >= self.least[item]
        keys, group, counts = np.unique(item[may] << 40 | band[may], return_inverse=True, return_counts=True)
        item, band = keys >> 40, keys & ((1 << 40) - 1)
        # A q-gram of the item counts once, however often the text repeats it.
        keep = counts >= self.least[item]
        own = keep[group]
        places = np.unique(group[own] << 32 | place[may][own])
        keep &= np.bincount(places >> 32, minlength=len(keys)) >= self.least[item]
        return list(zip(item[keep].tolist(), (band[keep] * self.width[item[keep]] - (1 << 20)).tolist()))


def align(item: np.ndarray, region: np.ndarray, first: int, band: int, limit: int) -> tuple[int, int, int] | None:
    """The best match of the whole item inside region, on diagonals first to first + band - 1.

    Returns (edits, start, end) if at most limit edits are needed: the fewest edits, then the earliest end, then
    the longest stretch.
    """
    far = 1 << 20
    step = np.arange(band)
    # cost[d] is for the place first + d + (characters of the item used); start[d] is where the match began.
    column = first + step
    inside = (column >= 0) & (column <= len(region))
    cost, start = np.where(inside, 0, far), column.copy()
    for i, c in enumerate(item):
        column = first + step + i  # place before the character that a diagonal move uses
        ok = (column >= 0) & (column < len(region))
        same = np.zeros(band, dtype=bool)
        same[ok] = region[column[ok]] == c
        diagonal = np.where(ok, cost + ~same, far)
        skip = np.append(cost[1:] + 1, far)  # the item's character has no partner
        from_skip = np.append(start[1:], 0)
        take = skip < diagonal
        now, begin = np.where(take, skip, diagonal), np.where(take, from_skip, start)
        # Characters of the region without a partner: the cheapest cell to the left, plus the distance.
        shifted = now - step
        best = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == best, step, 0))
        source = np.where(shifted[source] == best, source, step)
        end = first + step + i + 1
        cost = np.where((end >= 0) & (end <= len(region)), best + step, far)
        start = begin[source]
        if cost.min() > limit:
            return None
    d = int(np.argmin(cost))
    if cost[d] > limit:
        return None
    return int(cost[d]), int(start[d]), int(first + d + len(item))


def find_matches(patterns: Patterns, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) in normalised characters: the best match of each band that passes."""
    tail = "\n" * (Q + 1)  # no item holds it, and no q-gram of an item crosses it
    starts, parts, at = [], [], 0
    for t in texts:
        starts.append(at)
        parts += [t, tail]
        at += len(t) + len(tail)
    starts = np.array(starts)
    for item, diagonal in patterns.candidates("".join(parts)):
        pattern, limit = patterns.texts[item], int(patterns.edits[item])
        low, band = diagonal, int(patterns.width[item]) + limit
        # A band may touch several short texts.
        first = max(0, int(np.searchsorted(starts, low, side="right")) - 1)
        last = int(np.searchsorted(starts, low + band + len(pattern), side="left"))
        for k in range(first, last):
            text = texts[k]
            begin = max(0, low - int(starts[k]))
            region = text[begin : max(0, low + band + len(pattern) - int(starts[k]))]
            exact = region.find(pattern)
            if exact >= 0:
                while exact >= 0:
                    yield k, item, begin + exact, begin + exact + len(pattern), 0
                    exact = region.find(pattern, exact + len(pattern))
                continue
            if len(region) < len(pattern) - limit:
                continue
            as_number = [np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (pattern, region)]
            found = align(*as_number, low - int(starts[k]) - begin, band, limit)
            if found:
                yield k, item, begin + found[1], begin + found[2], found[0]


MATCH = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("contaminated", pa.bool_()), ("item_ids", pa.list_(pa.int64()))]
    + [("spans", pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "start", "end", "edits")])))]
)
MATCH_DDL = (
    "row long, doc_id long, contaminated boolean, item_ids array<long>, "
    "spans array<struct<item_id: long, start: long, `end`: long, edits: long>>"
)


def overlap_report(
    docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: whether it holds a passage of the benchmark, which items, and where.

    Texts are compared lower-cased, with letters and digits only and one blank between words. An item is
    found where a stretch of the document differs from the whole item by at most edit_budget(length, rate) edits. Spans
    are characters of the original text, end not included; overlapping finds of one item are reported once, the best.
    Items shorter than 8 normalised characters, among them null and empty ones, are no passages and are never reported;
    items with equal texts are all reported. Null and empty documents are clean. Rows that repeat are reported row by
    row, and other columns are not read. The benchmark is broadcast in blocks of bounded size, each with a pass
    over the documents of its own; every document is read whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parts = [_report(rows, patterns) for patterns in pattern_blocks(benchmark, rate)]
    if len(parts) == 1:
        return parts[0].drop("row")
    # The scan numbers rows alike in every pass.
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("row", "doc_id").agg(
        F.max("contaminated").alias("contaminated"),
        F.array_sort(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    ).drop("row")


def pattern_blocks(benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> Iterator[Patterns]:
    """The benchmark's items in blocks of about block_chars characters at most; one block at least, if an empty one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-2 * chars // block_chars) if chars > block_chars else 1
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        texts = sorted((r["item_id"] is None, r["item_id"] or 0, normalise(r["text"])) for r in own)
        texts = [(None if none else i, t) for none, i, t in texts if len(t) >= Q]
        yield Patterns([i for i, _ in texts], [t for _, t in texts], rate)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows, with all their columns, that hold no passage of the benchmark."""
    for patterns in pattern_blocks(benchmark, rate):
        shared = docs.sparkSession.sparkContext.broadcast((patterns.ids, patterns.texts, patterns.rate))

        def decider(shared=shared):
            known = Patterns(*shared.value)

            def clean(texts):
                held = {k for part in _portions(texts) for k in _holding(known, texts, part)}
                return [k not in held for k in range(len(texts))]

            return clean

        docs = keep_rows(docs, decider)
    return docs


def _portions(texts: list[str]) -> Iterator[range]:
    """Consecutive texts of about BATCH_CHARS characters together."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > BATCH_CHARS or i + 1 == len(texts):
            yield range(begin, i + 1)
            begin, size = i + 1, 0


def _holding(known: Patterns, texts: list[str], part: range) -> set[int]:
    return {part[0] + m[0] for m in find_matches(known, [normalise(texts[k]) for k in part])}


def _report(rows: DataFrame, patterns: Patterns) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((patterns.ids, patterns.texts, patterns.rate))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Patterns(*shared.value)

        def matched(ids, texts):
            plain = [normalise(t) for t in texts]
            found: dict[int, list] = {}
            for k, item, start, end, edits in find_matches(known, plain):
                found.setdefault(k, []).append((edits, item, start, end))
            for k, doc_id in enumerate(ids):
                places, spans = None, []
                for edits, item, start, end in sorted(found.get(k, ())):
                    places = places or spans_of(texts[k])
                    begin, stop = places[start][0], places[max(start, end - 1)][1]
                    item_id = known.ids[item]
                    if not any(s[0] == item and s[1]["start"] < stop and begin < s[1]["end"] for s in spans):
                        spans.append((item, {"item_id": item_id, "start": begin, "end": stop, "edits": edits}))
                spans = sorted((s for _, s in spans), key=lambda s: (s["start"], s["end"], s["item_id"] or 0))
                yield doc_id, bool(spans), sorted({s["item_id"] for s in spans if s["item_id"] is not None}), spans

        def rows():
            for batch in batches:
                row, ids, texts = (batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))
                for part in _portions(texts):
                    own = slice(part.start, part.stop)
                    yield from ((r, *m) for r, m in zip(row[own], matched(ids[own], texts[own])))

        yield from record_batches(rows(), MATCH)

    return rows.mapInArrow(run, MATCH_DDL)


def op2_qgram_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
