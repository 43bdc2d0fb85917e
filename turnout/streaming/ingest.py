"""Structured Streaming form of the live job (ST1-ST9).

The published job polls the broker, sleeps, reads each new offset range as a batch and keeps its
offsets in memory.  Here the same work is one streaming query: the source offsets live in the
checkpoint (a restart resumes, nothing is lost), each micro-batch is processed in
``foreachBatch`` keyed by ``batch_id`` (a replayed batch overwrites its own output), and the
trigger replaces the poll-and-sleep loop.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout import constants as C
from turnout.operators.features import ballot_features
from turnout.sources import cdc
from turnout.streaming import keyed, state
from turnout.streaming.metrics import MetricStore


def log_stream(spark: SparkSession, options: dict) -> DataFrame:
    """S3: the CDC log as a stream -- Kafka when ``kafka.bootstrap.servers`` is given, else a
    folder of Parquet log files (same columns) read ``maxFilesPerTrigger`` at a time."""
    if "kafka.bootstrap.servers" in options:
        return spark.readStream.format("kafka").options(**options).load()
    r = spark.readStream.schema(T.StructType(cdc.LOG_SCHEMA.fields + [T.StructField("day", T.LongType())]))
    if options.get("maxFilesPerTrigger"):
        r = r.option("maxFilesPerTrigger", int(options["maxFilesPerTrigger"]))
    return r.parquet(options["path"]).drop("day")


def decoded_ballots(log: DataFrame) -> DataFrame:
    """Decode and keep messages that carry a ballot (deletes, tombstones, garbage drop out)."""
    d = cdc.decode_cdc(log, keep=("offset", "timestamp"))
    return d.filter(F.col("area_l2").isNotNull() & F.col("log_ms").isNotNull())


def minute_count_stream(log: DataFrame, watermark: str | None = None) -> DataFrame:
    """ST4/ST5: per (area, minute) counts.

    Without a watermark the key is the published (area_l1, area_l2, 'HH:mm') and Spark keeps one
    state row per key (bounded by areas x 1440).  With a watermark the key is a one-minute
    event-time window; rows later than the watermark are dropped and old windows leave state.
    """
    b = decoded_ballots(log)
    feats = ballot_features(b.withColumn("event_time", F.timestamp_millis("log_ms")), keep=("event_time",))
    sums = [F.sum(c).cast("long").alias(c) for c in C.COUNTERS]
    if watermark is None:
        return feats.groupBy("area_l1", "area_l2", "minute").agg(*sums)
    return (feats.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 minute").alias("w"), "area_l1", "area_l2").agg(*sums)
            .select(F.col("w.start").alias("window_start"), "area_l1", "area_l2", *C.COUNTERS))


def run_minute_counts(spark: SparkSession, source: dict, table_path: str, checkpoint: str,
                      watermark: str | None = None, trigger: dict | None = None):
    """ST1/ST2/ST4/ST9: start (or resume from ``checkpoint``) the minute-count stream into a keyed table."""
    agg = minute_count_stream(log_stream(spark, source), watermark)
    keys = [c for c in agg.columns if c not in C.COUNTERS]
    w = (agg.writeStream.outputMode("update").foreachBatch(keyed.sink(table_path, keys))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def run_ingest_counts(spark: SparkSession, source: dict, out_path: str, checkpoint: str):
    """Per-batch message and ballot counts, measured by ``observe`` while the batch passes; the listener that is
    returned with the query stores them under ``out_path``.  One job a batch and no second aggregate."""
    name = f"ingest-{uuid.uuid4().hex[:12]}"
    decoded = cdc.decode_cdc(log_stream(spark, source)).observe(
        name, F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("area_l2").isNotNull() & F.col("log_ms").isNotNull()).alias("ballots"),
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    store = MetricStore(spark, name, out_path)
    spark.streams.addListener(store)
    q = (decoded.writeStream.queryName(name).format("noop").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    return q, store


def run_late_split(spark: SparkSession, source: dict, out_path: str, checkpoint: str, delay_ms: int):
    """ST5: rows older than the watermark go to a table of their own instead of being dropped.

    The watermark of a batch is the newest event time of the batches before it, less ``delay_ms``; it is kept as a
    versioned state.  Per batch, ``on_time`` has the counts by (area, minute) of the rows in time and ``late`` the
    late rows whole, with the watermark they missed: both together are all rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        ballots = decoded_ballots(batch).persist()
        try:
            last = state.version_before(spark, f"{out_path}/newest", batch_id)
            newest = None if last is None else spark.read.parquet(last).first()["newest_ms"]
            mark = F.lit(None if newest is None else newest - delay_ms).cast("long")
            late = F.coalesce(F.col("log_ms") < mark, F.lit(False))
            counts = ballot_features(ballots.filter(~late)).groupBy("area_l1", "area_l2", "minute").agg(F.count("*").alias("ballots"))
            counts.write.mode("overwrite").parquet(f"{out_path}/on_time/batch_id={batch_id}")
            ballots.filter(late).withColumn("watermark_ms", mark).write.mode("overwrite").parquet(f"{out_path}/late/batch_id={batch_id}")
            seen = ballots.agg(F.greatest(F.max("log_ms"), F.lit(newest).cast("long")).alias("newest_ms"))
            state.write_version(seen, f"{out_path}/newest", batch_id)
        finally:
            ballots.unpersist()
    return (log_stream(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def late_split_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """area_l1, area_l2, minute, on_time, late over all batches of ``run_late_split``."""
    on_time = spark.read.parquet(f"{out_path}/on_time").select("area_l1", "area_l2", "minute", F.col("ballots").alias("on_time"), F.lit(0).alias("late"))
    late = ballot_features(spark.read.parquet(f"{out_path}/late")).select("area_l1", "area_l2", "minute", F.lit(0).alias("on_time"), F.lit(1).alias("late"))
    return on_time.unionByName(late).groupBy("area_l1", "area_l2", "minute").agg(
        F.sum("on_time").cast("long").alias("on_time"), F.sum("late").cast("long").alias("late"))


MESSAGE_KEY = ["topic", "partition", "offset"]


def ingest_totals(counts: DataFrame) -> DataFrame:
    """Messages, ballots and offset range over all micro-batches."""
    return counts.agg(F.sum("messages").cast("long").alias("messages"), F.sum("ballots").cast("long").alias("ballots"),
                      F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))


def dedup_stream(log: DataFrame, delay: str | None = None) -> DataFrame:
    """ST6: a redelivered message (same topic, partition and offset) counts once.

    The result is that of the whole log, however it is cut into micro-batches; the state is one key per
    message (``intervals.dedup_by_intervals`` gives the same from a state that grows with the gaps of the log only).
    ``delay`` bounds the state by a watermark instead; Spark then also drops every message
    older than the watermark, and counts them as ``numRowsDroppedByWatermark`` in the query progress.
    """
    if delay is None:
        return log.dropDuplicates(MESSAGE_KEY)
    return log.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(MESSAGE_KEY)


def first_ballots(log: DataFrame) -> DataFrame:
    """ST6 by citizen: of all messages that carry a ballot, each citizen's first by offset, so an update
    event is no further ballot.  An aggregate (update mode), so neither the order in which messages
    arrive nor the cut into micro-batches changes the final table."""
    d = decoded_ballots(log).filter(F.col("citizen_id").isNotNull())
    image = F.struct("offset", *[c for _, _, c in cdc.AFTER_FIELDS if c != "citizen_id"])
    return d.groupBy("citizen_id").agg(F.min_by(image, F.col("offset")).alias("s")).select("citizen_id", "s.*")


def run_first_ballots(spark: SparkSession, source: dict, table_path: str, checkpoint: str):
    return (first_ballots(log_stream(spark, source)).writeStream.outputMode("update")
            .foreachBatch(keyed.sink(table_path, ["citizen_id"]))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_state(decoded: DataFrame) -> DataFrame:
    """ST7: net CDC state -- the newest image per citizen by (ts_ms, serial); deletes removed.

    ``max_by`` is an aggregate, so a citizen with very many changes is reduced map-side before
    the shuffle instead of being sorted in one task.
    """
    d = decoded.filter(F.col("key_citizen_id").isNotNull())
    order = F.struct(F.col("ts_ms"), F.col("serial"), F.col("offset"))
    img = F.struct("op", "offset", *[c for _, _, c in cdc.AFTER_FIELDS if c != "citizen_id"])
    last = d.groupBy("key_citizen_id").agg(F.max_by(img, order).alias("s"))
    return last.filter(F.col("s.op") != "d").select(F.col("key_citizen_id").alias("citizen_id"), "s.*").drop("op")


CHANGE_ORDER = ["ts_ms", "serial", "offset"]


def run_change_state(spark: SparkSession, source: dict, table_path: str, checkpoint: str, horizon_ms: int | None = None):
    """ST7 as a stream: the newest image per citizen in a keyed table, whatever the order and cut of the log.

    Each batch is reduced to the newest change per citizen and merged by (ts_ms, serial, offset), not by arrival.  A
    deletion stays as a tombstone, so a change that arrives after it but happened before does not revive the citizen;
    with ``horizon_ms`` tombstones go once they are that much older than the newest change so far.
    """
    images = ["op", *[c for _, _, c in cdc.AFTER_FIELDS if c != "citizen_id"]]

    def write(batch: DataFrame, batch_id: int) -> None:
        d = cdc.decode_state(batch).filter(F.col("key_citizen_id").isNotNull())
        order = F.struct(*CHANGE_ORDER)
        last = d.groupBy(F.col("key_citizen_id").alias("citizen_id")).agg(F.max_by(F.struct(*CHANGE_ORDER, *images), order).alias("s"))
        rows = last.select("citizen_id", "s.*")
        forget = None
        if horizon_ms is not None:
            before = state.version_before(spark, f"{table_path}/newest", batch_id)
            seen = d.agg(F.max("ts_ms").alias("ts_ms"))
            if before is not None:
                seen = seen.unionByName(spark.read.schema(seen.schema).parquet(before)).agg(F.max("ts_ms").alias("ts_ms"))
            newest = state.write_version(seen, f"{table_path}/newest", batch_id).first()["ts_ms"]
            forget = None if newest is None else f"ts_ms < {newest - horizon_ms}"
        keyed.upsert(rows, f"{table_path}/changes", ["citizen_id"], batch_id, order=CHANGE_ORDER, gone=F.col("op") == "d", forget=forget)
    return (log_stream(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def change_state(spark: SparkSession, table_path: str) -> DataFrame:
    """The net state of ``run_change_state``, as ``latest_state`` gives it."""
    return keyed.current(spark, f"{table_path}/changes").select("citizen_id", "offset", *[c for _, _, c in cdc.AFTER_FIELDS if c != "citizen_id"])
