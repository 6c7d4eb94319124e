import pyarrow as pa
import pytest
from cases import awkward, empty, frame

from revmill.llm import exact_dedup as X
from revmill.session import shared_dir


def test_directory_doubles_until_buckets_fit():
    counts = {i: 1 for i in range(0, 1 << 16, 64)} | {7: 50}
    d = X.build_directory(counts, 100)
    assert len(d.entries) == 1 << d.depth and d.buckets == max(d.entries) + 1
    sizes = [0] * d.buckets
    for prefix, n in counts.items():
        sizes[d.entries[prefix >> (X.MAX_DEPTH - d.depth)]] += n
    assert max(sizes) <= 100
    assert sum(1 << (d.depth - b) for b in d.local_depth) == 1 << d.depth


def test_one_hot_key_stays_in_one_bucket():
    d = X.build_directory({3: 10_000}, 100)
    assert d.depth == X.MAX_DEPTH


def test_collisions_are_chained_and_compared():
    schema = pa.schema([("bucket", pa.int32()), ("hash", pa.int64()), ("text", pa.binary()), ("max_id", pa.int64()), ("n", pa.int64())])
    rows = [(0, 5, b"a", 1, 2), (0, 5, b"b", 9, 1), (0, 5, b"a", 4, 1), (1, 6, b"a", None, 1)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i : i + 2]], schema=schema) for i in (0, 2)]
    got = [r for b in X._own(iter(batches)) for r in b.to_pylist()]
    assert [(r["hash"], r["chain"], r["text"], r["keep_id"], r["group_size"]) for r in got] == [
        (5, 0, b"a", 4, 3), (5, 1, b"b", 9, 1), (6, 0, b"a", None, 1),
    ]


def test_batches_are_small():
    """Tasks hand on some 4 MB at once, however much text they hold."""
    texts = [bytes([i]) * (1 << 20) for i in range(40)]
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "hash": list(range(40)), "text": texts})
    folded = list(X._fold(iter([rows])))
    assert sorted(r["text"] for b in folded for r in b.to_pylist()) == texts
    assert max(b.nbytes for b in folded) < 6 << 20
    owned = [b.append_column("bucket", pa.array([0] * b.num_rows, pa.int32())) for b in folded]
    entries = list(X._own(iter(owned)))
    assert sorted(r["text"] for b in entries for r in b.to_pylist()) == texts
    assert max(b.nbytes for b in entries) < 6 << 20


def test_folding_is_bounded(monkeypatch):
    monkeypatch.setattr(X, "COMBINE_BYTES", 300)
    ids = list(range(50))
    batch = pa.RecordBatch.from_pydict({"doc_id": ids, "hash": [i % 5 for i in ids], "text": [b"t%d" % (i % 5) for i in ids]})
    got = [r for b in X._fold(iter([batch])) for r in b.to_pylist()]
    assert sum(r["n"] for r in got) == 50 and len(got) > 5


def test_awkward_rows(spark):
    got = {(r.doc_id, r.text_sha256[:6]): r for r in X.exact_groups(awkward(spark)).collect()}
    rows = X.exact_groups(awkward(spark)).collect()
    assert len(rows) == 13
    plain = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.keep_id, r.group_size) for r in plain] == [(2, 3)] * 3
    assert sorted((r.doc_id, r.kept) for r in plain) == [(1, False), (2, True), (2, True)]
    void = [r for r in rows if r.doc_id in (3, 4)]
    assert {(r.keep_id, r.group_size) for r in void} == {(4, 3)}  # empty, null and the null id's null
    assert got[None, [r for r in rows if r.doc_id is None and r.keep_id is None][0].text_sha256[:6]].kept
    kept = X.drop_copies(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 4, 6, 7, 8, 9, 10]
    assert X.exact_groups(empty(spark)).count() == 0 and X.drop_copies(empty(spark)).count() == 0


@pytest.mark.parametrize("capacity", [1, 10_000])
def test_many_groups_at_any_bucket_size(spark, monkeypatch, capacity):
    monkeypatch.setattr(X, "BUCKET_KEYS", capacity)
    texts = [f"text {i % 37}" for i in range(300)]
    for r in X.exact_groups(frame(spark, texts).repartition(5)).collect():
        same = [i for i, t in enumerate(texts) if t == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))


def test_a_text_that_fills_a_third(spark):
    texts = ["hot"] * 1000 + [str(i) for i in range(2000)]
    got = X.exact_groups(frame(spark, texts).repartition(8)).where("group_size > 1").collect()
    assert len(got) == 1000 and {r.keep_id for r in got} == {999}


def test_dropping_copies_leaves_no_texts_in_the_shared_folder(spark, monkeypatch):
    paths, build = [], X.build_index

    def watched(docs):
        index = build(docs)
        paths.append(index.inputFiles()[0].rsplit("/hash-index-", 1)[1].split("/")[0])
        return index

    monkeypatch.setattr(X, "build_index", watched)
    kept = X.drop_copies(frame(spark, ["a", "b", "a", None, ""]))
    assert sorted(r.text or "" for r in kept.collect()) == ["", "a", "b"]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/hash-index-{paths[0]}")
    assert not path.getFileSystem(conf).exists(path)
