"""SimHash near-duplicates by a generalised pigeonhole search.

The bits of the fingerprints are grouped into partitions, correlated bits together. If two fingerprints differ in at
most tau bits, and the partitions' thresholds add up to tau - m + 1, at least one partition differs by no more than
its threshold. A dynamic program spends the thresholds where the estimated work is least; a threshold of -1
leaves a partition out. A partition of threshold t is probed by its bits with any t of them left out, so
fingerprints that are near in it share a block. Each block is verified on the whole fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.graph import components
from revmill.llm.shelf import record_batches, small_batches, stage, table, text_or_empty

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BITS = 64
SEED = 42
ROW_COST = 1.0  # of a block row that is exchanged
PAIR_COST = 0.01  # of a pair that is compared inside a block
LARGE_BLOCK = 20_000  # a block with more fingerprints is probed again on its other bits
LEVELS = 4
ODD = (
    0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD,
)


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; A-Z count as a-z. A shorter text is one shingle, an empty one none."""
    found = WORD.findall(text.lower())
    if not found:
        return np.zeros(0, dtype=np.uint64)
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], dtype=np.uint64)


def remixed(h: np.ndarray, odd: int) -> np.ndarray:
    """Another hash of the same shingles; the first is the hash itself."""
    if not odd:
        return h
    h = (h ^ np.uint64(odd)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def majority(h: np.ndarray) -> int:
    """A bit is set if it is in more than half of the hashes."""
    total = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(h), 1 << 14):
        part = np.ascontiguousarray(h[start : start + (1 << 14)])
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(total * 2 > len(h), bitorder="little").view(np.uint64)[0])


def names(count: int) -> list[str]:
    return [f"f{i}" for i in range(count)]


def fingerprints(
    docs: DataFrame, words: int, count: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, mark, f0, f1, ...) of every row: `count` independent 64-bit fingerprints of the whole text, as signed longs.

    mark is a hash of the text, which tells rows with one id apart. Texts without words, null ones among them, have
    fingerprint zero; texts with fewer words than a shingle are one shingle. Other columns are not read.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "mark", *names(count))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                ids, marks = (batch.column(c).to_pylist() for c in ("doc_id", "mark"))
                for doc_id, mark, text in zip(ids, marks, batch.column("text")):
                    h = shingle_hashes(text.as_py(), words)
                    found = [majority(remixed(h, ODD[i])) for i in range(count)]
                    yield doc_id, mark, *(f - (1 << 64) if f >> 63 else f for f in found)

        yield from record_batches(rows(), schema)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty(text_col)).alias("mark"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "mark", *names(count))))


def bit_counts(classes: DataFrame, column: str) -> np.ndarray:
    """How often two bits are set together, over all fingerprints; the diagonal counts single bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(total.ravel().astype(np.int64))], ["cell", "n"]
        )

    sums = classes.select(column).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(BITS * BITS)
    for r in sums.collect():
        out[r["cell"]] = r["n"]
    return out.reshape(BITS, BITS)


def correlated_groups(both: np.ndarray, total: int, m: int) -> list[list[int]]:
    """m groups of nearly equal size; each starts with the free bits that correlate most and takes in those nearest to it."""
    p = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    link = np.abs(both / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(link, 0.0)
    free, out = list(range(BITS)), []
    for g in range(m):
        size = (BITS - sum(map(len, out)) + (m - g) - 1) // (m - g)
        inside = link[np.ix_(free, free)].max(axis=1)
        group = [free.pop(int(np.argmax(inside)))]
        while len(group) < size:
            near = link[np.ix_(free, group)].mean(axis=1)
            group.append(free.pop(int(np.argmax(near))))
        out.append(sorted(group))
    return out


def near_chances(agree: np.ndarray, most: int) -> list[float]:
    """The chance that two random fingerprints differ in at most t of these bits, for t from 0 to most."""
    dist = np.zeros(most + 1)
    dist[0] = 1.0
    for a in agree:
        dist[1:] = dist[1:] * a + dist[:-1] * (1 - a)
        dist[0] *= a
    return np.cumsum(dist).tolist()


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds, at least -1 each and budget in sum, of the least cost; costs[i][t + 1] is that of threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in enumerate(row, -1):
                key = used + t
                if key not in following or cost + c < following[key][0]:
                    following[key] = (cost + c, [*chosen, t])
        best = following
    return best[budget]


def plan(both: np.ndarray, total: int, tau: int) -> list[tuple[int, int]]:
    """(mask, whole partition) of every probe: the cheapest grouping into 1 to tau + 1 partitions and its thresholds."""
    agree = np.diag(both) / max(total, 1)
    agree = agree**2 + (1 - agree) ** 2
    best: tuple[float, list] | None = None
    for m in range(1, tau + 2):
        groups = correlated_groups(both, total, m)
        costs = []
        for g in groups:
            chance = near_chances(agree[g], tau)
            costs.append([0.0] + [
                ROW_COST * total * comb(len(g), t) + PAIR_COST * total * total / 2 * chance[t]
                for t in range(min(tau, len(g) - 1) + 1)
            ])
        cost, chosen = allocate(costs, tau - m + 1)
        if best is None or cost < best[0]:
            best = cost, list(zip(groups, chosen))
    out = []
    for group, t in best[1]:
        whole = sum(1 << b for b in group)
        if t >= 0:
            out += [(whole & ~sum(1 << b for b in left), whole) for left in combinations(group, t)]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(f: np.ndarray, keep: int, n: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that join all rows of f that a chain of steps of at most `keep` bits connects; no more than rows.

    With the sizes n of sets, steps lead to sets that may be similar.
    """
    out, rest, todo = [], np.arange(1, len(f)), [0]
    while len(rest):
        if not todo:
            todo, rest = [int(rest[0])], rest[1:]
        i = todo.pop()
        if n is None:
            near = np.bitwise_count(f[rest] ^ f[i]).sum(axis=1) <= keep
        else:
            near = may_be_similar(f, n, i, rest, keep)
        found = rest[near].tolist()
        out += [(i, j) for j in found]
        todo += found
        rest = rest[~near]
    return out


def _verify(blocks: DataFrame, count: int, keep: int, sized: bool = False) -> DataFrame:
    """Edges inside blocks of (key, node, f0, ...), with n and near if sized; a task holds one block at a time.

    Nodes of one near group are connected already, so a block that holds one group alone is left out.
    """
    more = ["n", "near"] if sized else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(parts):
            node = np.concatenate([p[0] for p in parts])
            if len(node) < 2:
                return []
            n = None
            if sized:
                n, near = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
                if (near == near[0]).all():
                    return []
            return [(int(node[i]), int(node[j])) for i, j in forest(np.concatenate([p[1] for p in parts]), keep, n)]

        def edges():
            key, parts = None, []
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, node = batch.column("key").to_numpy(), batch.column("node").to_numpy()
                f = np.stack([batch.column(c).to_numpy() for c in names(count)], axis=1).view(np.uint64)
                others = [batch.column(c).to_numpy() for c in more]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if keys[a] != key:
                        if parts:
                            yield from finished(parts)
                        key, parts = keys[a], []
                    parts.append((node[a:b], f[a:b], *(x[a:b] for x in others)))
            if parts:
                yield from finished(parts)

        yield from record_batches(edges(), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return blocks.select("key", "node", *names(count), *more).mapInArrow(run, "a long, b long")


def links(classes: DataFrame, count: int, tau: int, keep: int, probed: int) -> DataFrame:
    """Edges (a, b) between nodes that connect what the search finds.

    classes: (node, f0, ...), one row for each distinct fingerprint. All pairs are found that differ in at most tau bits of
    one of the first `probed` words, and of those the ones within `keep` bits over all `count` words count. A block with more than
    LARGE_BLOCK fingerprints is split by pieces of its other bits, of which one must agree; only what
    LEVELS splits leave together is compared as it is. Inside a block no pair is emitted that earlier edges connect,
    so a group of near copies gives no more edges than block rows.
    """
    total = classes.count()
    if total < 2:
        return classes.sparkSession.createDataFrame([], "a long, b long")
    rows = None
    for w, c in enumerate(names(probed)):
        probes = plan(bit_counts(classes, c), total, tau)

        def entry(i: int, mask: int, whole: int, c: str = c, w: int = w) -> Column:
            at = F.xxhash64(F.lit(w), F.lit(i), F.col(c).bitwiseAND(F.lit(_signed(mask))))
            return F.struct(at.alias("key"), F.lit(_signed(whole)).alias("used"))

        own = classes.select(
            "node", *names(count), F.lit(w).alias("word"),
            F.explode(F.array(*(entry(i, *p) for i, p in enumerate(probes)))).alias("e"),
        ).select("node", *names(count), "word", "e.key", "e.used")
        rows = own if rows is None else rows.unionByName(own)
    out = None
    for level in range(LEVELS + 1):
        sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        met = rows.join(sizes, "key")
        small = met if level == LEVELS else met.where(F.col("n") <= LARGE_BLOCK)
        # Blocks are dealt by their key; the largest are of bounded size.
        dealt = small.repartition(F.col("key")).sortWithinPartitions("key")
        found = _verify(dealt, count, keep)
        out = found if out is None else out.unionByName(found)
        if level == LEVELS or sizes.where(F.col("n") > LARGE_BLOCK).isEmpty():
            return out
        rows = stage(met.where(F.col("n") > LARGE_BLOCK).drop("n"), "large-blocks")
        rows = _split(rows, count, tau, level)
    return out


def _split(rows: DataFrame, count: int, tau: int, level: int) -> DataFrame:
    """Rows of large blocks under tau + 1 new keys each: bits not used yet, dealt out by turns."""
    word = F.element_at(F.array(*names(count)), F.col("word") + 1)
    free = F.bitwise_not("used")
    pieces = []
    for i in range(tau + 1):
        mask = _signed(sum(1 << b for b in range(BITS) if (b + level) % (tau + 1) == i))
        piece = free.bitwiseAND(F.lit(mask))
        pieces.append(
            F.struct(
                F.xxhash64("key", F.lit(i), word.bitwiseAND(piece)).alias("key"),
                F.col("used").bitwiseOR(piece).alias("used"),
            )
        )
    return rows.select("node", *names(count), "word", F.explode(F.array(*pieces)).alias("e")).select(
        "node", *names(count), "word", "e.key", "e.used"
    )


def linked_prints(prints: DataFrame, count: int, tau: int, keep: int, probed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(classes, joined): (f0, ..., first, node) of every distinct fingerprint, first being its smallest doc_id, and (node, root)
    of those that the search links to others."""
    classes = stage(prints.groupBy(*names(count)).agg(F.min("doc_id").alias("first")), "fingerprint-classes").select(
        "*",
        F.shiftleft(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long"), 40)
        .bitwiseOR(F.col("_metadata.row_index")).alias("node"),
    )
    return classes, components(links(classes.drop("first"), count, tau, keep, probed or count))


def near_groups(prints: DataFrame, count: int, tau: int, keep: int, probed: int | None = None) -> DataFrame:
    """(doc_id, mark, f0, ..., component_id) of every row of prints; component_id is the smallest doc_id of the group.

    Rows with equal fingerprints are one class, made by an aggregate, so copies cost no pairs. A null doc_id is larger than
    any other; a group of such rows alone has the component null.
    """
    prints = stage(prints, "fingerprints")
    classes, joined = linked_prints(prints, count, tau, keep, probed)
    members = classes.join(joined, "node")
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    merged = members.join(least, "root").select(*names(count), "component_id")
    grouped = prints.join(merged, names(count), "left").join(
        classes.select(*names(count), "first"), names(count)
    )
    return grouped.select("doc_id", "mark", *names(count), F.coalesce("component_id", "first").alias("component_id"))


# Near copies for a corpus: five-word shingles whose Jaccard similarity is 0.8 or more. Sets of shingles decide; loose
# links come before that. Most come from the pigeonhole search above, over one fingerprint of each set. It links at NEAR
# bits, and a pair of similarity 0.8 may be 20 apart, for which no partitions are selective; so the sets that it leaves
# apart are searched by shared shingles and 384 bits more:
# - up to SMALL shingles, the parities of the shingles in 384 cells. A shingle that one set alone holds changes one parity,
#   so similar sets, which have at most a ninth of their sizes' sum to themselves, differ in no more cells. Never wrong.
# - from 4/5 of SMALL on, fingerprints of the set. At 0.8 they differ in 58 bits with a spread of 7; keep leaves eight
#   spreads, so a similar pair is lost with a chance below 10^-15, less than that of equal 64-bit hashes.
# Sizes in between have both, so every two similar sets meet in one of them.
CORPUS = {"words": 5, "count": 6, "keep": 116}
NEAR = 3
SMALL = 640
SIMILAR = 4, 5
BATCH_BYTES = 4 << 20  # of texts or shingles that a task is handed at once
IN_TASK = 4_000_000  # shingles, 32 MB, of a group that one task decides


def parities(shingles: np.ndarray, count: int) -> list[int]:
    """Whether an odd number of shingles is in each of 64 count cells, as `count` words."""
    odd = np.bincount((remixed(shingles, ODD[1]) % np.uint64(BITS * count)).astype(np.int64), minlength=BITS * count) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64).tolist()


def may_be_similar(f: np.ndarray, n: np.ndarray, i: int, rest: np.ndarray, keep: int) -> np.ndarray:
    """True wherever sets may have the similarity of SIMILAR; n is the size of a set, negative with a fingerprint."""
    num, den = SIMILAR
    size, own = np.abs(n[rest]), abs(int(n[i]))
    bits = np.bitwise_count(f[rest] ^ f[i]).sum(axis=1).astype(np.int64)
    # Both sets have (sum - apart) / 2 in common and (sum + apart) / 2 together.
    most = (den - num) * (size + own) // (den + num) if n[i] >= 0 else keep
    return ((n[rest] >= 0) == (n[i] >= 0)) & (den * np.minimum(size, own) >= num * np.maximum(size, own)) & (bits <= most)


def prefix(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set, common ones last, of which two similar sets share at least one.

    Sets of a similarity s share s of the larger one at least, so each has a shared one among its first n - ceil(s n) + 1
    in any order that all sets have in common.
    """
    if not len(shingles):
        return np.zeros(1, dtype=np.uint64)
    if len(common):
        late = np.isin(shingles, common)
        shingles = np.concatenate([shingles[~late], shingles[late]])
    num, den = SIMILAR
    return shingles[: len(shingles) + (-num * len(shingles)) // den + 1]


def _signatures(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(doc_id, mark, sign, n, f0, prints, prefix) of every row: a hash of the set of shingles, its size, its fingerprint
    for the search, its parities, its fingerprints or both, one after the other, and its prefix."""
    count, words = CORPUS["count"], CORPUS["words"]
    longs = ("doc_id", "mark", "sign", "n", "f0")
    lists = ("prints", "prefix")
    schema = pa.schema([*((c, pa.int64()) for c in longs), *((c, pa.list_(pa.int64())) for c in lists)])
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                ids, marks = (batch.column(c).to_pylist() for c in ("doc_id", "mark"))
                for doc_id, mark, text in zip(ids, marks, batch.column("text")):
                    own = np.unique(shingle_hashes(text.as_py(), words))
                    whole = majority(own)
                    found = parities(own, count) if len(own) <= SMALL else []
                    if SIMILAR[1] * len(own) >= SIMILAR[0] * SMALL:
                        found += [whole, *(majority(remixed(own, ODD[i])) for i in range(1, count))]
                    sign = _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                    first = prefix(own, shared.value).view(np.int64)
                    yield doc_id, mark, sign, len(own), _signed(whole), np.array(found, np.uint64).view(np.int64), first

        # A prefix holds a fifth of a text's shingles.
        yield from record_batches(rows(), schema, BATCH_BYTES)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("mark"),
        text_or_empty().cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, ", ".join([f"{c} long" for c in longs] + [f"{c} array<long>" for c in lists]))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (doc_id, mark, ...) with the sorted distinct shingles of those texts."""
    words = CORPUS["words"]
    others = [c for c in wanted.columns if c not in ("doc_id", "mark")]
    ddl = ", ".join(f"{c} {wanted.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                found = [np.unique(shingle_hashes(t.as_py(), words)).view(np.int64) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in others), pa.array(found, pa.list_(pa.int64()))], [*others, "shingles"]
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), text_or_empty().alias("text")).withColumn(
        "__mark", F.xxhash64("text")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark"))
    # Rows that repeat have one text and one set.
    return wanted.join(texts, same).select(*others, F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"{ddl}, shingles array<long>"
    ).dropDuplicates(["node"])


def _loose_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures, classes, edges): texts with one set of shingles are one class; edges connect, by chains, every two
    classes that the pigeonhole search links, and every two that share a shingle of their prefixes and may be similar by
    their sizes and bits. Prefixes that only classes of one group of the search share are not compared.

    Shingles in the prefixes of more than LARGE_BLOCK classes go to the end of the common order, which leaves them out of
    nearly all prefixes; only what LEVELS such turns leave together is compared as it is.
    """
    count = CORPUS["count"]
    common = np.zeros(0, dtype=np.uint64)
    for level in range(LEVELS + 1):
        prints = stage(_signatures(docs, common), "signatures")
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
        alike = [F.any_value(c).alias(c) for c in ("f0", "prints", "prefix")]
        classes = stage(prints.groupBy("sign", "n").agg(F.min(order).alias("first"), *alike), "shingle-classes").select(
            "*",
            F.shiftleft(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long"), 40)
            .bitwiseOR(F.col("_metadata.row_index")).alias("node"),
        )
        rows = classes.select("node", F.explode("prefix").alias("key"))
        sizes = stage(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "prefix-sizes")
        large = sizes.where(F.col("n") > LARGE_BLOCK).select("key").toArrow().column("key").to_numpy().view(np.uint64)
        fresh = np.setdiff1d(large, common)
        if level == LEVELS or not len(fresh):
            break
        common = np.union1d(common, fresh)
    found, joined = linked_prints(prints.select("f0", "doc_id"), 1, NEAR, NEAR)
    grouped = found.join(joined, "node", "left").select("f0", F.coalesce("root", "node").alias("near"))
    grouped = stage(classes.select("node", "f0").join(grouped, "f0").select("node", "near"), "near-groups")
    least = grouped.groupBy("near").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    searched = grouped.join(least, "near").where("node <> b").select(F.col("node").alias("a"), "b")
    met = rows.join(sizes.drop("n"), "key").join(classes.select("node", "n", "prints").join(grouped, "node"), "node")
    # Its parities, if it has them, come first.
    parts = F.when(F.size("prints") > count, F.array(F.lit(0), F.lit(count))).otherwise(F.array(F.lit(0)))
    met = met.withColumn("at", F.explode(parts)).select(
        "key", "node", F.when((F.col("at") > 0) | (F.col("n") > SMALL), -F.col("n")).otherwise(F.col("n")).alias("n"),
        *(F.get("prints", F.col("at") + i).alias(c) for i, c in enumerate(names(count))), "near",
    )
    dealt = met.repartition(F.col("key")).sortWithinPartitions("key")
    return prints, classes, searched.unionByName(_verify(dealt, count, CORPUS["keep"], sized=True))


def _in_order(members: DataFrame) -> DataFrame:
    """(node, leader) of members whose groups fit a task; a task holds the sets of one group's leaders."""
    num, den = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            root, held = None, []
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("root", "node", "doc_id")]
                for of, node, doc_id, own in zip(*columns, batch.column("shingles")):
                    own = own.values.to_numpy()
                    if of != root:
                        root, held = of, []
                    for theirs, leader in held:
                        if num * max(len(own), len(theirs)) > den * min(len(own), len(theirs)):
                            continue
                        both = len(np.intersect1d(own, theirs, assume_unique=True))
                        if den * both >= num * (len(own) + len(theirs) - both):
                            yield node, leader
                            break
                    else:
                        held.append((own, doc_id))
                        yield node, doc_id

        yield from record_batches(rows(), pa.schema([("node", pa.int64()), ("leader", pa.int64())]))

    dealt = members.repartition(F.col("root")).sortWithinPartitions("root", "first")
    return dealt.select("root", "node", "first.doc_id", "shingles").mapInArrow(run, "node long, leader long")


def leaders(members: DataFrame) -> DataFrame:
    """(node, leader) of members (root, node, first, shingles): each takes the doc_id of the least leader, by `first`, that it
    is similar to; who is similar to none is a leader itself. Only members of one root are compared.

    Groups of up to IN_TASK shingles are decided in one task each. Of larger ones a round compares all members with the
    least, wherever they lie, and goes on with those that are left; so a group of copies costs a comparison each.
    """
    num, den = SIMILAR
    out, rest = None, stage(members, "near-members")
    while True:
        sizes = rest.groupBy("root").agg(F.sum(F.size("shingles")).alias("n"), F.min(F.struct("first", "node")).alias("lead"))
        sizes = stage(sizes, "near-sizes")
        found = stage(_in_order(rest.join(sizes.where(F.col("n") <= IN_TASK).select("root"), "root")), "near-leaders")
        out = found if out is None else out.unionByName(found)
        least = sizes.where(F.col("n") > IN_TASK).select(
            F.col("root").alias("of"), F.col("lead.node").alias("node"), F.col("lead.first").alias("leader")
        )
        if least.isEmpty():
            return out
        lead = least.join(rest.select("node", F.col("shingles").alias("theirs")), "node").drop("node")
        both = F.size(F.array_intersect("shingles", "theirs"))
        judged = stage(
            rest.join(lead, F.col("root") == F.col("of")).withColumn(
                "similar", den * both >= num * (F.size("shingles") + F.size("theirs") - both)
            ).select("root", "node", "first", "leader", "similar", F.when(~F.col("similar"), F.col("shingles")).alias("shingles")),
            "near-judged",
        )
        out = out.unionByName(judged.where("similar").select("node", "leader.doc_id").toDF("node", "leader"))
        rest = judged.where("NOT similar").select("root", "node", "first", "shingles")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, component_id) of every row; component_id is the doc_id of the text that stays for it.

    Fingerprints within NEAR bits are found by the pigeonhole search of this module. What it leaves apart is searched to the
    end at any size: every two texts whose sets of shingles have a similarity of SIMILAR or more share a
    shingle of their prefixes. Their bits are a loose filter (see CORPUS), and the sets decide.
    """
    own = ["sign", "n"]
    with small_batches(docs.sparkSession, BATCH_BYTES):
        prints, classes, edges = _loose_links(docs)
        joined = classes.join(components(edges), "node").select("root", "node", "first", "first.doc_id", "first.mark")
        chosen = leaders(_sets(docs, joined)).select("node", "leader", F.lit(True).alias("met"))
    merged = classes.join(chosen, "node", "left").select(
        *own, F.when(F.col("met"), F.col("leader")).otherwise(F.col("first.doc_id")).alias("component_id")
    )
    return prints.join(merged, own).select("doc_id", "mark", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row, with all its columns, for each group of near copies: the one with the smallest doc_id.

    No two rows that stay are near copies, and each that goes is a near copy of one that stays. Rows that share the smallest
    id of a group all stay, and so do groups whose rows have no id.
    """
    gone = near_copies(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")
    ).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty()) == F.col("__mark"))
    return docs.join(gone, same, "left_anti")


def op3_pigeonhole_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over three-word shingles, linked at two or fewer differing bits."""
    groups = near_groups(fingerprints(table(spark, sf_dir, "documents"), words=3), 1, tau=2, keep=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
