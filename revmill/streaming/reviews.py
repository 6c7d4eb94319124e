"""Cleaning of arriving review files, and running quality counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revmill.config import ReviewConfig
from revmill.operators.cleaning import review_states
from revmill.schemas import CORRUPT, REVIEW_RAW, with_corrupt


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(with_corrupt(REVIEW_RAW)).option(
        "columnNameOfCorruptRecord", CORRUPT
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


# How long a review is remembered after it has arrived, unless the caller says otherwise.
KEEP_FOR = "30 days"


def stream_clean(
    rows: DataFrame, cfg: ReviewConfig = ReviewConfig(), keep_for: str | None = KEEP_FOR
) -> DataFrame:
    """Clean, unique reviews of a stream.

    The state holds entity and digest, not the text, for keep_for after a review's arrival; None keeps it for ever.
    Time is that of arrival, never the review's own date, so no review is late and none is lost: old, undated and
    unordered ones are treated like all others, and only a copy that comes after keep_for is written again.
    """
    states = review_states(rows, "business_id", "text", F.col(CORRUPT).isNotNull(), cfg)
    clean = states.filter("state = 'clean'").drop("state", CORRUPT)
    if keep_for is None:
        unique = clean.dropDuplicates(["business_id", "digest"])
    else:
        unique = (
            clean.withColumn("arrived", F.current_timestamp())
            .withWatermark("arrived", keep_for)
            .dropDuplicatesWithinWatermark(["business_id", "digest"])
            .drop("arrived")
        )
    return unique.drop("digest")


FLAGS = T.StructType([T.StructField("state", T.StringType()), T.StructField("first", T.BooleanType())])


# Groups that share what has been seen. Each is one call of Python and one state a batch, however many reviews it remembers.
GROUPS = 8192


def first_seen(
    rows: DataFrame, order: list[str], cfg: ReviewConfig = ReviewConfig(), keep_for: str | None = KEEP_FOR
) -> DataFrame:
    """Every arriving row with its cleaned text, its state (clean, malformed, empty_short) and whether it is the first of its kind.

    The first clean row of an entity and text is true, of several in a batch the one that comes first in `order`; all other rows are
    false and keep their state only. A digest of entity and text is remembered in keyed state for keep_for after that row has
    arrived; None keeps it for ever. Digests are dealt to GROUPS groups by hash, and the state of a group is a list of them, as a
    call for each review costs more than all else. A batch writes the lists of the groups that it meets, so many small batches
    over a very long memory write more than a state for each review would. Rejected rows pass through a few groups that keep
    no state. Rows of a group are read in portions, and only the first ones found so far are held.
    """
    states = review_states(rows, "business_id", "text", F.col(CORRUPT).isNotNull(), cfg).drop(CORRUPT)
    clean = F.col("state") == "clean"
    one = F.unhex(F.sha2(F.concat(F.sha2("business_id", 256), "digest"), 256))
    dealt = F.pmod(F.xxhash64("business_id", "digest"), F.lit(GROUPS))
    spread = -1 - F.pmod(F.xxhash64(*order), F.lit(64))
    keyed = states.withColumns({"_g": F.when(clean, dealt).otherwise(spread).cast("int"), "_k": F.when(clean, one)}).drop("digest")
    kept = [f for f in keyed.schema.fields if f.name not in ("_g", "_k", "state")]
    names = [f.name for f in kept]
    # State expires by the time of arrival, which never runs ahead of itself: no row is late.
    timed = keyed.withColumn("_at", F.current_timestamp()).withColumn("_ms", F.unix_millis("_at"))
    if keep_for is not None:
        timed = timed.withWatermark("_at", "1 minute")
    wait = None if keep_for is None else _milliseconds(rows.sparkSession, keep_for)

    def flag(key, frames, state):
        import numpy as np
        import pandas as pd

        entry = np.dtype([("k", "V32"), ("expires", "<i8")])
        known = np.frombuffer(bytes(state.get[0]) if state.exists else b"", dtype=entry)
        if state.hasTimedOut:
            keep(state, known[known["expires"] > state.getCurrentWatermarkMs()])
            return
        if key[0] >= 0:
            expires = dict(zip((bytes(k) for k in known["k"]), known["expires"].tolist()))
        best, now = None, 0
        for frame in frames:
            now = int(frame["_ms"].max())
            out = pd.DataFrame({n: pd.Series([None] * len(frame), dtype=object) for n in names})
            out["state"], out["first"] = frame["state"].to_numpy(), False
            if key[0] >= 0:
                ids = [bytes(k) for k in frame["_k"]]
                until = [expires.get(k) for k in ids]
                new = [u is None or (wait is not None and u <= now) for u in until]
                if any(new):
                    top = frame[names].assign(_k=ids)[new]
                    both = top if best is None else pd.concat([best, top])
                    best = both.sort_values(order, kind="stable").drop_duplicates("_k")
            yield out
        if key[0] < 0:
            return
        if wait is not None:
            known = known[known["expires"] > now]
        if best is not None:
            # The firsts were passed on above as some of many; these rows take their places.
            out = best[names].reset_index(drop=True).astype(object)
            out["state"], out["first"] = "clean", True
            yield out
            more = np.zeros(len(best), dtype=entry)
            more["k"] = np.frombuffer(b"".join(best["_k"]), dtype="V32")
            more["expires"] = now + (wait or 0)
            known = np.concatenate([known, more])
        keep(state, known)  # also without new ones, as a call forgets when the state is to expire

    def keep(state, known):
        if len(known) == 0:
            state.remove()
            return
        state.update((bytearray(known.tobytes()),))
        if wait is not None:
            state.setTimeoutTimestamp(int(known["expires"].min()))

    out_schema = T.StructType([*kept, *FLAGS.fields])
    timeout = "NoTimeout" if keep_for is None else "EventTimeTimeout"
    return timed.groupBy("_g").applyInPandasWithState(flag, out_schema, "known binary", "update", timeout)


def _milliseconds(spark: SparkSession, interval: str) -> int:
    end = F.expr(f"timestamp'2000-01-01' + INTERVAL {interval}")
    start = F.expr("timestamp'2000-01-01'")
    return spark.range(1).select((F.unix_millis(end) - F.unix_millis(start)).alias("ms")).first()["ms"]


def stream_reviews(
    rows: DataFrame,
    out: str | None,
    counters: str,
    checkpoint: str,
    order: list[str],
    cfg: ReviewConfig = ReviewConfig(),
    keep_for: str | None = KEEP_FOR,
) -> StreamingQuery:
    """Write the clean, unique reviews of each micro-batch (unless out is None) and one row of counters.

    Both come from one pass: the state says which rows are the first of their kind, and the counters are observed while these
    are written. No batch reads what an earlier one has written. A batch that runs again overwrites its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        first, state = F.col("first"), F.col("state")
        # A first row stands beside the row that it was, so it counts as written and not as one more clean row.
        observed = batch.observe(
            seen, F.count_if(first).alias("written"), F.count_if(~first & (state == "clean")).alias("clean"),
            F.count_if(state == "malformed").alias("malformed"), F.count_if(state == "empty_short").alias("short"),
        )
        kept = observed.filter("first").drop("first", "state")
        if out is None:
            kept.write.format("noop").mode("overwrite").save()
        else:
            kept.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        n = seen.get
        row = (n["written"], n["malformed"], n["short"], n["clean"] - n["written"])
        if sum(row) == 0:  # a batch without rows, in which state may expire
            return
        batch.sparkSession.createDataFrame([row], COUNTERS).write.mode("overwrite").parquet(
            f"{counters}/batch_id={batch_id}"
        )

    flagged = first_seen(rows, order, cfg, keep_for)
    return (
        flagged.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


COUNTERS = "records_written long, dropped_malformed_json long, dropped_empty_short long, dropped_duplicate long"


def stream_quality(
    rows: DataFrame, out: str, checkpoint: str, cfg: ReviewConfig = ReviewConfig(), keep_for: str | None = KEEP_FOR
) -> StreamingQuery:
    """Write one counter row per micro-batch; a review is written in the first batch that holds it, and a duplicate later.

    What has been seen is in the state of the query, so the rows written, summed over the batches, are those of
    stream_clean, and no batch reads the folders of earlier ones.
    """
    return stream_reviews(rows, None, out, checkpoint, ["review_id"], cfg, keep_for)
