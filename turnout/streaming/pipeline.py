"""The live job as one streaming query (ST8, ST9): every micro-batch counts its minutes,
forecasts the next hour per area, adds the running live totals, upserts the prediction table and
publishes every report bundle -- all inside ``foreachBatch``, all DataFrame work, nothing
collected.

State tables are versioned by ``batch_id``: batch ``n`` reads the version before it and writes
version ``n``, so a batch replayed after a failure rewrites the same version; older versions go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.operators.aggregate import SUMMARY_MEASURES, at_level, level_counts, rollup
from turnout.operators.features import ballot_features, minute_counts
from turnout.plans import forecast as FC
from turnout.plans import predictions as PR
from turnout.plans.charts import bundles, write_reports
from turnout.plans.inputs import Inputs
from turnout.sources import proof_views as pv
from turnout.streaming import state
from turnout.streaming.ingest import decoded_ballots, log_stream


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The state table as the batch found it, or None before the first batch."""
    last = state.version_before(spark, path, batch_id)
    return None if last is None else spark.read.parquet(last)


BASE_KEYS = ["area_l1", "area_l2", "hour"]


def batch_base(ballots: DataFrame) -> DataFrame:
    """This batch's sums per (area_l1, area_l2, hour) -- the finest summary grain."""
    s = level_counts(ballots, "l2_hour")
    return s.select(*BASE_KEYS, *SUMMARY_MEASURES)


def merge_base(prev: DataFrame | None, inc: DataFrame) -> DataFrame:
    """Running totals: previous version + this batch, by (area, hour); bounded by areas x 24."""
    if prev is None:
        return inc
    u = prev.select(*BASE_KEYS, *SUMMARY_MEASURES).unionByName(inc)
    return u.groupBy(*BASE_KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in SUMMARY_MEASURES])


MINUTE_KEYS = ["area_l1", "area_l2", "event_minute"]


def merge_minutes(prev: DataFrame | None, inc: DataFrame) -> DataFrame:
    """Running counts by (area, minute of event time) and the newest ballot of each.

    Only the last clock hour is ever forecast from, and the newest minute only moves forward, so
    minutes before that hour are let go: the state is bounded by areas x 60.
    """
    u = inc if prev is None else prev.select(*inc.columns).unionByName(inc)
    sums = u.groupBy(*MINUTE_KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in C.COUNTERS], F.max("newest_ms").alias("newest_ms"))
    return sums.filter(F.col("event_minute") > FC.newest_minute(u) - FC.STEPS)


def merge_ages(prev: DataFrame | None, ballots: DataFrame) -> DataFrame:
    """Running ballots per single year of age (R5 in live bundles)."""
    inc = ballots.filter("age IS NOT NULL").groupBy("age").agg(F.count("*").alias("n"))
    if prev is None:
        return inc
    return prev.unionByName(inc).groupBy("age").agg(F.sum("n").cast("long").alias("n"))


def process_batch(spark: SparkSession, state_dir: str, pairs: DataFrame, data_dir: str | None = None,
                  publish: bool = True, forecast_from: str = "batch", dims: dict | None = None):
    """foreachBatch body for the live pipeline.

    ``dims`` gives the registered voters, areas and age counts as ``Inputs`` takes them; what it lacks
    comes from ``data_dir``.  With ``publish`` the report bundles of the batch go to ``{state_dir}/reports/batch_id=<n>``.
    ``forecast_from="batch"`` forecasts from the first 60 clock minutes of the batch's own ballots
    (published behaviour); ``"running"`` forecasts every area from the last clock hour of all
    ballots so far, so the table after a batch does not depend on how ballots fell into batches.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if data_dir:
            pv.refresh(spark, data_dir)  # changed voter and area tables are seen
        ballots = decoded_ballots(batch)
        ballots.persist()
        try:
            base = merge_base(_before(spark, f"{state_dir}/summary", batch_id), batch_base(ballots))
            summary = rollup(state.write_version(base, f"{state_dir}/summary", batch_id))
            minutes = state.write_version(
                merge_minutes(_before(spark, f"{state_dir}/minutes", batch_id), FC.event_minute_counts(ballots)),
                f"{state_dir}/minutes", batch_id)
            if forecast_from == "running":
                # every area is forecast, so a silent one adds live totals of zero
                fc = FC.forecast_last_hour(minutes, pairs)
                live = at_level(summary, C.LEVEL_L2)
                live = pairs.select(F.col("area_l2").alias("area_id")).distinct().join(live, "area_id", "left").fillna(0)
            else:
                fc = FC.forecast(minute_counts(ballot_features(ballots)))
                live = at_level(summary, C.LEVEL_L2)
            updates = PR.add_live_totals(fc, live)
            # next full hour after the newest ballot so far, by epoch arithmetic (no session zone involved)
            slot = minutes.agg(F.expr("timestamp_millis((max(newest_ms) DIV 3600000 + 1) * 3600000)").alias("slot"))
            prev_pred = _before(spark, f"{state_dir}/prediction", batch_id)
            if prev_pred is None:
                empty = pairs.select("area_l1", "area_l2").limit(0).withColumn("time_slot", F.lit(None).cast("timestamp"))
                for c in C.PREDICTION_COUNTERS:
                    empty = empty.withColumn(c, F.lit(0).cast("long"))
                prev_pred = empty
            table = PR.seed_predictions(prev_pred, pairs, slot)
            pred = state.write_version(PR.upsert_predictions(table, updates, slot), f"{state_dir}/prediction", batch_id)
            if publish and (data_dir or dims):
                ages = state.write_version(merge_ages(_before(spark, f"{state_dir}/ages", batch_id), ballots),
                                           f"{state_dir}/ages", batch_id)
                inp = Inputs(spark, data_dir, summary=summary, prediction_table=pred, age_counts=ages, **(dims or {}))
                write_reports(bundles(inp, batch_id), f"{state_dir}/reports/batch_id={batch_id}")
        finally:
            ballots.unpersist()
    return run


def run_live_pipeline(spark: SparkSession, source: dict, state_dir: str, checkpoint: str, pairs: DataFrame,
                      trigger: dict | None = None, data_dir: str | None = None, publish: bool = True,
                      forecast_from: str = "batch", dims: dict | None = None):
    body = process_batch(spark, state_dir, pairs, data_dir, publish, forecast_from, dims)
    q = (log_stream(spark, source).writeStream.foreachBatch(body)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    return q.start()
