"""Query builders for history preparation, forecasting and the prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import timeofday as tod
from turnout.operators.features import ballot_features, minute_counts
from turnout.operators.windows import first_steps
from turnout.plans import forecast as FC
from turnout.plans import history as H
from turnout.plans import predictions as PR
from turnout.plans import ridge as RG
from turnout.plans.inputs import Inputs
from turnout.session import scratch_path
from turnout.sources import proof_views as pv
from turnout.sources.history import coerce_history, read_history, write_history


def _minute_counts(spark, data_dir) -> DataFrame:
    return minute_counts(ballot_features(pv.early_ballots(spark, data_dir)))


def history_load(spark: SparkSession, data_dir: str) -> DataFrame:
    path = scratch_path(spark, "history")
    b = pv.ballots(spark, data_dir).withColumn("dataset", (F.dayofmonth("ts") % 3).cast("long"))
    write_history(b, path)
    h = coerce_history(read_history(spark, path))
    return h.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def history_prepared(spark, data_dir) -> DataFrame:
    return H.prepared(spark, data_dir, "area_l2", split=True)


def minute_grid_dense(spark, data_dir) -> DataFrame:
    return H.prepared(spark, data_dir, "area_l1", split=False)


def iqr_bounds(spark, data_dir) -> DataFrame:
    return H.iqr_bounds(H.prepared(spark, data_dir, "area_l1", split=False))


def outlier_zeroed(spark, data_dir) -> DataFrame:
    return H.outliers_zeroed(H.prepared(spark, data_dir, "area_l1", split=False))


def minmax_scaled(spark, data_dir) -> DataFrame:
    """Min-max of the l2 grids with the dataset split: later datasets reuse the first one's scaler."""
    dense = H.prepared(spark, data_dir, "area_l2", split=True)
    return H.scale(H.with_own_minmax(dense))


def scaler_params(spark, data_dir) -> DataFrame:
    path = scratch_path(spark, "scaler")
    H.save_scaler(H.fit_minmax(H.outliers_zeroed(H.prepared(spark, data_dir, "area_l1", split=False))), path)
    return H.load_scaler(spark, path)


def history_scaled(spark, data_dir) -> DataFrame:
    return H.scaled(spark, data_dir)


def history_scaled_listed(spark, data_dir) -> DataFrame:
    """Three history files scaled by the first listed, which is not the first by name."""
    path = scratch_path(spark, "history")
    write_history(pv.ballots(spark, data_dir).withColumn("dataset", (F.dayofmonth("ts") % 3).cast("long")), path)
    dense = H.prepared_files(spark, [f"{path}/dataset={k}" for k in (2, 0, 1)], "area_l1")
    return H.scale(H.with_own_minmax(H.outliers_zeroed(dense)))


def supervised_windows(spark, data_dir) -> DataFrame:
    return H.windows(spark, data_dir)


def time_split(spark, data_dir) -> DataFrame:
    return H.split_windows(spark, data_dir)


def first_60_steps(spark, data_dir) -> DataFrame:
    return first_steps(_minute_counts(spark, data_dir), ["area_l2"], "minute", FC.STEPS)


def pad_to_60(spark, data_dir) -> DataFrame:
    return FC.model_steps(_minute_counts(spark, data_dir))


def forecast_minutes(spark, data_dir) -> DataFrame:
    return FC.forecast(_minute_counts(spark, data_dir))


def _last_hour(spark, data_dir) -> DataFrame:
    """Event-minute counts of the last clock hour; older ballots are left out before the citizen lookup."""
    newest = pv.ballot_events(spark, data_dir).agg(F.expr("(max(log_ms) + 30000) DIV 60000").alias("m")).select("m").scalar()
    ballots = pv.ballots(spark, data_dir).filter((F.col("log_ms") + 30000) >= (newest - FC.STEPS + 1) * 60000)
    return FC.event_minute_counts(ballots)


def forecast_last_hour(spark, data_dir) -> DataFrame:
    """Forecast of every area from the last clock hour of event time."""
    return FC.forecast_last_hour(_last_hour(spark, data_dir), Inputs(spark, data_dir).dim)


def forecast_stored_scaler(spark, data_dir) -> DataFrame:
    """As ``forecast_minutes``, scaled by parameters that were fitted on the history, stored and loaded (K4)."""
    path = scratch_path(spark, "scaler")
    H.save_scaler(H.fit_minmax(H.outliers_zeroed(H.prepared(spark, data_dir, "area_l2", split=True))), path)
    return FC.forecast(_minute_counts(spark, data_dir), params=H.load_scaler(spark, path))


def forecast_trend_sql(spark, data_dir) -> DataFrame:
    return FC.trend_forecast_sql(_minute_counts(spark, data_dir))


def forecast_eval(spark, data_dir) -> DataFrame:
    z = H.with_own_minmax(H.outliers_zeroed(H.prepared(spark, data_dir, "area_l1", split=False)))
    return FC.evaluate(H.scale(z, keep=tuple(f"{e}_{c}" for c in C.COUNTERS for e in ("lo", "hi"))))


def ridge_models(spark, data_dir) -> DataFrame:
    """The fitted coefficients of every area and counter, as the table that forecasts read."""
    path = scratch_path(spark, "models")
    H.save_scaler(RG.fit_ridge(minmax_scaled(spark, data_dir)), path)
    m = H.load_scaler(spark, path)
    return m.select("area_id", "feature", "n_rows", "intercept", *[F.element_at("weights", i + 1).alias(f"w{i + 1}") for i in range(RG.LAGS)])


def _stored(spark, data_dir) -> tuple[DataFrame, DataFrame]:
    """Models and scaler parameters, each fitted on the history, stored and loaded."""
    models, params = scratch_path(spark, "models"), scratch_path(spark, "scaler")
    dense = H.prepared(spark, data_dir, "area_l2", split=True)  # whole: most minutes of a small area are empty, so a fence would clear it
    H.save_scaler(H.fit_minmax(dense), params)
    H.save_scaler(RG.fit_ridge(H.apply_minmax(dense, H.load_scaler(spark, params))), models)
    return H.load_scaler(spark, models), H.load_scaler(spark, params)


def forecast_ridge(spark, data_dir) -> DataFrame:
    """The next hour of every area by its own fitted model, scaled by its stored parameters."""
    models, params = _stored(spark, data_dir)
    return RG.forecast_area_models(FC.model_steps(_minute_counts(spark, data_dir)), models, params)


def forecast_area_models(spark, data_dir) -> DataFrame:
    """Areas with different kinds of model in one job: fitted, trend, last value, and areas without a model."""
    models, params = _stored(spark, data_dir)
    kind = F.expr(f"CASE area_id % 4 WHEN 0 THEN '{RG.RIDGE}' WHEN 1 THEN '{RG.TREND}' WHEN 2 THEN '{RG.LAST}' END")
    kinds = models.withColumn("kind", kind).filter("kind IS NOT NULL")
    return RG.forecast_area_models(FC.model_steps(_minute_counts(spark, data_dir)), kinds, params)


def forecast_ridge_eval(spark, data_dir) -> DataFrame:
    """Errors of the fitted models and of the trend per region, split in time; the fit sees no test target."""
    series = H.scaled(spark, data_dir)
    n = C.POLL_LAST_MINUTE - C.POLL_FIRST_MINUTE + 1
    return RG.evaluate_area_models(series, RG.fit_ridge(series, upto=RG.training_cut(n)))


def forecast_plus_live(spark, data_dir) -> DataFrame:
    inp = Inputs(spark, data_dir)
    return PR.add_live_totals(FC.forecast(_minute_counts(spark, data_dir)), inp.level(C.LEVEL_L2))


def batch_slot(spark: SparkSession, data_dir: str) -> DataFrame:
    """F16: the next full hour after the newest ballot (a one-row frame).  The newest per citizen is found
    first, so the citizen lookup (a ballot needs a known citizen) does not move ballots."""
    last = pv.ballot_events(spark, data_dir).groupBy("user_id").agg(F.max("ts").alias("ts"))
    known = last.join(pv.citizen_areas(spark, data_dir).select(F.col("citizen_id").alias("user_id")), "user_id", "left_semi")
    return known.agg(tod.next_hour_slot(F.max("ts")).alias("slot"))


def _fmt(df: DataFrame) -> DataFrame:
    return df.withColumn("time_slot", F.date_format("time_slot", "yyyy-MM-dd HH:mm:ss"))


def prediction_seed(spark, data_dir) -> DataFrame:
    inp = Inputs(spark, data_dir)
    return _fmt(PR.seed_predictions(inp.prediction, inp.dim, batch_slot(spark, data_dir)))


def prediction_upsert(spark, data_dir) -> DataFrame:
    """Seed, upsert forecast + live totals, write the new table version, read it back."""
    inp = Inputs(spark, data_dir)
    slot = batch_slot(spark, data_dir)
    table = PR.seed_predictions(inp.prediction, inp.dim, slot)
    minutes = minute_counts(ballot_features(pv.forecast_ballots(spark, data_dir)))
    updates = PR.add_live_totals(FC.forecast(minutes), inp.level(C.LEVEL_L2))
    path = scratch_path(spark, "prediction")
    PR.upsert_predictions(table, updates, slot).write.mode("overwrite").parquet(path)
    return _fmt(spark.read.parquet(path))
