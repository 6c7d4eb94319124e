import json
import os
import time

from pyspark.sql import functions as F

from revmill import schemas
from revmill.operators import cleaning
from revmill.schemas import CORRUPT
from revmill.streaming import reviews as S


def write_files(folder):
    folder.mkdir()
    n = 0
    for part in range(3):
        lines = []
        for i in range(40):
            row = {"review_id": str(n), "business_id": f"b{n % 4}", "text": f"A fine review, number {n % 25}!",
                   "date": f"2024-01-{1 + part:02d} 10:00:00"}
            n += 1
            lines.append(json.dumps(row))
        lines += ["{broken", json.dumps({"review_id": "x", "business_id": "b1", "text": "no"})]
        path = folder / f"part{part}.json"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))  # the order of arrival


def run(df, tmp_path, name):
    out, ckpt = str(tmp_path / name), str(tmp_path / f"{name}-ckpt")
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
    q.trigger(availableNow=True).start().awaitTermination(240)
    return out


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    write_files(src)
    lines = spark.read.schema(schemas.with_corrupt(schemas.REVIEW_RAW)).json(str(src))
    states = cleaning.review_states(lines, "business_id", "text", F.col(CORRUPT).isNotNull())
    want = {(r.business_id, r.text) for r in cleaning.kept_reviews(states, "business_id", ["review_id"]).collect()}
    assert len(want) == 100

    rows = S.read_stream(spark, str(src), files_per_trigger=1)
    out = run(S.stream_clean(rows), tmp_path, "plain")
    got = [(r.business_id, r.text) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(want) and set(got) == want

    out = run(S.stream_clean(S.read_stream(spark, str(src), 1), keep_for="30 days"), tmp_path, "bounded")
    got = [(r.business_id, r.text) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(want) and set(got) == want


def test_quality_per_batch(spark, tmp_path):
    src = tmp_path / "in"
    write_files(src)
    out = str(tmp_path / "q")
    S.stream_quality(S.read_stream(spark, str(src), 1), out, str(tmp_path / "c")).awaitTermination(240)
    rows = spark.read.parquet(out).orderBy("batch_id").collect()
    assert len(rows) == 3
    assert all(r.dropped_malformed_json == 1 and r.dropped_empty_short == 1 for r in rows)
    assert all(r.records_written + r.dropped_duplicate == 40 for r in rows)
    assert [r.records_written for r in rows] == [40, 40, 20]


def arriving(folder, files):
    folder.mkdir()
    for n, rows in enumerate(files):
        lines = [json.dumps({"review_id": str(i), "business_id": b, "text": t, "date": d}) for i, b, t, d in rows]
        path = folder / f"part{n}.json"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def test_late_undated_and_repeated_reviews(spark, tmp_path):
    """Old reviews after new ones, reviews without a date, and copies in later batches."""
    src = tmp_path / "in"
    fine = "a review that is long enough, number"
    arriving(src, [
        [(1, "b", f"{fine} one", "2024-06-01 00:00:00"), (2, "b", f"{fine} two", None)],
        [(3, "b", f"{fine} three", "2004-01-01 00:00:00"), (4, "b", f"{fine} one", "2024-06-01 00:00:00")],
        [(5, "b", f"{fine} four", "no date"), (6, "b", f"{fine} ONE!", "1999-01-01 00:00:00")],
    ])
    out = run(S.stream_clean(S.read_stream(spark, str(src), 1)), tmp_path, "clean")
    written = spark.read.parquet(out).collect()
    assert sorted(r.review_id for r in written) == ["1", "2", "3", "5"]
    counted = str(tmp_path / "q")
    S.stream_quality(S.read_stream(spark, str(src), 1), counted, str(tmp_path / "c")).awaitTermination(240)
    rows = spark.read.parquet(counted).orderBy("batch_id").collect()
    assert [(r.records_written, r.dropped_duplicate) for r in rows] == [(2, 0), (1, 1), (1, 1)]


def one_wave(spark, src, tmp_path, name, rows, keep_for):
    """Let rows arrive as one more file and run the stream; what it wrote for them, and their counters."""
    src.mkdir(exist_ok=True)
    lines = [json.dumps({"review_id": str(i), "business_id": b, "text": t}) for i, b, t in rows]
    (src / f"{name}.json").write_text("\n".join(lines) + "\n")
    out, counters = str(tmp_path / "out"), str(tmp_path / "counters")
    before = 0 if not os.path.exists(counters) else len(os.listdir(counters))
    stream = S.read_stream(spark, str(src)).withColumn("id", F.col("review_id").cast("long"))
    S.stream_reviews(stream, out, counters, str(tmp_path / "ckpt"), ["id"], keep_for=keep_for).awaitTermination(120)
    assert len(os.listdir(counters)) == before + 1
    last = spark.read.parquet(counters).orderBy(F.desc("batch_id")).first()
    ids = [r.id for r in spark.read.parquet(out).filter(F.col("batch_id") == last.batch_id).collect()]
    return sorted(ids), (last.records_written, last.dropped_empty_short, last.dropped_duplicate)


FINE = "a review that is long enough"


def test_state_lives_through_restarts_and_expires(spark, tmp_path):
    src = tmp_path / "in"
    many = [(i, "b", FINE) for i in range(90, 40, -1)] + [(7, None, FINE), (8, "b", "short"), (9, "c", FINE)]
    assert one_wave(spark, src, tmp_path, "one", many, "5 seconds") == ([9, 41], (2, 2, 49))
    assert one_wave(spark, src, tmp_path, "two", [(1, "b", FINE), (2, "d", FINE)], "5 seconds")[0] in ([2], [1, 2])
    time.sleep(6)
    assert one_wave(spark, src, tmp_path, "three", [(3, "b", FINE), (4, "b", FINE)], "5 seconds") == ([3], (1, 0, 1))


def test_state_without_an_end(spark, tmp_path):
    src = tmp_path / "in"
    assert one_wave(spark, src, tmp_path, "one", [(1, "b", FINE), (2, "b", FINE)], None) == ([1], (1, 0, 1))
    assert one_wave(spark, src, tmp_path, "two", [(0, "b", FINE)], None) == ([], (0, 0, 1))


def test_no_batch_reads_what_another_wrote(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    src = tmp_path / "in"
    write_files(src)
    rows = S.read_stream(spark, str(src), 1)

    def refused(*args, **kwargs):
        raise AssertionError("a batch reads files")

    monkeypatch.setattr(DataFrameReader, "parquet", refused)
    query = S.stream_quality(rows, str(tmp_path / "q"), str(tmp_path / "c"))
    query.awaitTermination(120)
    assert query.exception() is None


def test_many_reviews_share_few_states(spark, tmp_path, monkeypatch):
    """Reviews of a group share a state, are read in portions, and expire one by one."""
    monkeypatch.setattr(S, "GROUPS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        src = tmp_path / "in"
        first = [(i, f"b{i % 40}", f"{FINE} {i % 80}") for i in range(199, -1, -1)] + [(300, "b", "short"), (301, None, FINE)]
        assert one_wave(spark, src, tmp_path, "one", first, "20 seconds") == (list(range(80)), (80, 2, 120))
        ended = time.time()
        time.sleep(11)
        second = [(i, f"b{i % 40}", f"{FINE} {i}") for i in range(70, 90)]
        assert one_wave(spark, src, tmp_path, "two", second, "20 seconds") == (list(range(80, 90)), (10, 0, 10))
        time.sleep(max(0, ended + 21 - time.time()))
        third = [(i, f"b{i % 40}", f"{FINE} {i}") for i in (5, 85)]
        assert one_wave(spark, src, tmp_path, "three", third, "20 seconds") == ([5], (1, 0, 1))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_call_for_a_group_not_for_a_review(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "GROUPS", 2)
    src = tmp_path / "in"
    arriving(src, [[(i, f"b{i}", f"{FINE} {i}", None) for i in range(60)]])
    query = S.stream_quality(S.read_stream(spark, str(src)), str(tmp_path / "q"), str(tmp_path / "c"))
    query.awaitTermination(120)
    assert sum(o["numRowsTotal"] for p in query.recentProgress[:1] for o in p["stateOperators"]) == 2
    assert spark.read.parquet(str(tmp_path / "q")).first().records_written == 60
