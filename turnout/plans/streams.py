"""Streaming query builders: the CDC log is written as day files under the shared checkpoint
folder, streamed ``maxFilesPerTrigger`` at a time with ``availableNow``, and the sink read back
as a batch DataFrame (stream result = batch result is the correctness check)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.plans.inputs import Inputs
from turnout.session import scratch_path
from turnout.sources import cdc
from turnout.sources import proof_views as pv
from turnout.streaming import ingest as ST
from turnout.streaming import intervals as IV
from turnout.streaming import keyed, state
from turnout.streaming import pipeline as PL

FILES_PER_TRIGGER = 30
MESSAGES_PER_FILE = 1_000_000
LATE_FILES = 4


def write_log_files(raw: DataFrame, path: str, copies: int = 1) -> None:
    """Log records in one folder per day (``day=<n>``), each day dealt over files by stretches of MESSAGES_PER_FILE offsets
    and, within one, by odd and even offsets, so a day's tasks and files grow with its messages; ``copies`` > 1
    simulates redelivery."""
    day = F.floor(F.unix_seconds("timestamp") / 86400).cast("long")
    out = raw.withColumn("day", day)
    for _ in range(copies - 1):
        out = out.unionByName(raw.withColumn("day", day))
    stretch = F.expr(f"offset DIV {MESSAGES_PER_FILE}")
    out.repartition("day", stretch, F.pmod("offset", F.lit(2))).write.mode("overwrite").partitionBy("day").parquet(path)


def _source(spark, data_dir, copies: int = 1, files_per_trigger: int = FILES_PER_TRIGGER) -> dict:
    path = scratch_path(spark, "cdc-stream-in")
    write_log_files(pv.cdc_raw(spark, data_dir), path, copies)
    return {"path": path, "maxFilesPerTrigger": files_per_trigger}


def stream_minute_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    src = _source(spark, data_dir)
    table, ckpt = scratch_path(spark, "minute-counts"), scratch_path(spark, "minute-counts-ckpt")
    q = ST.run_minute_counts(spark, src, table, ckpt)
    q.awaitTermination()
    return keyed.current(spark, table)


def stream_ingest_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    src = _source(spark, data_dir)
    out, ckpt = scratch_path(spark, "ingest-counts"), scratch_path(spark, "ingest-counts-ckpt")
    q, store = ST.run_ingest_counts(spark, src, out, ckpt)
    q.awaitTermination()
    store.close()
    return ST.ingest_totals(store.read("messages long, ballots long, first_offset long, last_offset long"))


def stream_dedup(spark: SparkSession, data_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Every message delivered twice; the stream keeps one copy, then decodes."""
    src = _source(spark, data_dir, copies=2, files_per_trigger=files_per_trigger)
    out, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    d = cdc.decode_cdc(ST.dedup_stream(ST.log_stream(spark, src)))
    q = (d.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(d.schema).parquet(out)


def stream_dedup_citizen(spark: SparkSession, data_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Each citizen's first ballot, from a log in which every message is delivered twice."""
    src = _source(spark, data_dir, copies=2, files_per_trigger=files_per_trigger)
    table, ckpt = scratch_path(spark, "first-ballots"), scratch_path(spark, "first-ballots-ckpt")
    ST.run_first_ballots(spark, src, table, ckpt).awaitTermination()
    return keyed.current(spark, table)


def stream_dedup_intervals(spark: SparkSession, data_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """As ``stream_dedup``, from the intervals of offsets seen instead of a row of state per message."""
    src = _source(spark, data_dir, copies=2, files_per_trigger=files_per_trigger)
    return _dedup_by_intervals(spark, src, scratch_path(spark, "dedup-iv-ckpt"))


def _dedup_by_intervals(spark: SparkSession, src: dict, ckpt: str) -> DataFrame:
    out = scratch_path(spark, "dedup-iv-out")
    d = cdc.decode_cdc(IV.dedup_by_intervals(ST.log_stream(spark, src)))
    with IV.small_batches(spark):
        q = (d.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(d.schema).parquet(out)


def stream_cdc_state(spark: SparkSession, data_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """ST7 as a stream: the net state of ``cdc_latest_state``, merged batch by batch."""
    table, ckpt = scratch_path(spark, "change-state"), scratch_path(spark, "change-state-ckpt")
    src = _source(spark, data_dir, files_per_trigger=files_per_trigger)
    ST.run_change_state(spark, src, table, ckpt, horizon_ms=90 * 86_400_000).awaitTermination()
    return ST.change_state(spark, table)


def cdc_offset_gaps(spark: SparkSession, data_dir: str) -> DataFrame:
    """The ranges of offsets that a log with holes and repeats lacks, audited batch by batch."""
    path, table, ckpt = (scratch_path(spark, n) for n in ("holed-in", "islands", "islands-ckpt"))
    write_log_files(pv.cdc_raw_holed(spark, data_dir), path)
    IV.run_offset_audit(spark, {"path": path, "maxFilesPerTrigger": FILES_PER_TRIGGER}, table, ckpt).awaitTermination()
    return IV.gaps(state.current(spark, table))


def stream_late_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """ST5: ballots in time and late per area and minute.  The log arrives in five parts, written one after the
    other and read one a batch; every eleventh message comes a part late."""
    path, out, ckpt = (scratch_path(spark, n) for n in ("parts-in", "late-split", "late-split-ckpt"))
    parts = pv.cdc_raw_delayed(spark, data_dir)
    for k in range(pv.DELAYED_PARTS):
        parts.filter(F.col("part") == k).drop("part").repartition(LATE_FILES).write.parquet(f"{path}/day={k}")
    src = {"path": path, "maxFilesPerTrigger": LATE_FILES}
    ST.run_late_split(spark, src, out, ckpt, pv.LATE_AFTER_MS).awaitTermination()
    return ST.late_split_counts(spark, out)


def cdc_latest_state(spark: SparkSession, data_dir: str) -> DataFrame:
    return ST.latest_state(cdc.decode_state(pv.cdc_raw(spark, data_dir)))


def stream_forecast(spark: SparkSession, data_dir: str) -> DataFrame:
    """ST8: per-batch forecast (from the last clock hour of all ballots so far) and upsert; the table
    after the last batch.  (Publishing bundles per batch, ST9, is the same pipeline with
    ``publish=True``; see tests/test_streaming.py.)"""
    src = _source(spark, data_dir)
    folder, ckpt = scratch_path(spark, "live-state"), scratch_path(spark, "live-ckpt")
    q = PL.run_live_pipeline(spark, src, folder, ckpt, Inputs(spark, data_dir).dim, publish=False, forecast_from="running")
    q.awaitTermination()
    t = state.current(spark, f"{folder}/prediction")
    return t.withColumn("time_slot", F.date_format("time_slot", "yyyy-MM-dd HH:mm:ss"))
