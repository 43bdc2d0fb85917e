"""Per-area forecast of the next hour (M5, M6, M8, UD1, UD2).

The published job sends each area's last minutes through a neural network inside a grouped-map
pandas UDF.  Here the model is a pluggable callable ``model(x) -> y`` on scaled ``(60, k)``
matrices (one, or a stack of them) returning the next ``(60, k)`` steps; it runs in ``applyInPandas`` grouped by
area (one group = 60 rows, whatever the ballot volume).  The built-in model is a least-squares
trend per column; it also exists as plain aggregates (``trend_forecast_sql``) so the Python path
can be checked against SQL.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout import constants as C
from turnout.functions import flags
from turnout.operators.windows import first_steps, pad_steps
from turnout.session import ship_package

STEPS = C.WINDOW_IN
# sum of the forecast step indices n+1 .. 2n for n = 60
FUTURE_STEP_SUM = sum(range(STEPS + 1, 2 * STEPS + 1))
SNAP_DECIMALS = 6

FORECAST_SCHEMA = T.StructType([T.StructField("area_l1", T.LongType()), T.StructField("area_l2", T.LongType())]
                               + [T.StructField(c, T.LongType()) for c in C.COUNTERS])


def trend_model(x: np.ndarray) -> np.ndarray:
    """Least-squares line per column over steps 1..n, extended to steps n+1..2n.  Works on one
    (n, k) matrix and on any stack of them."""
    n = x.shape[-2]
    t = np.arange(1, n + 1, dtype=float)
    tc = t - t.mean()
    mean = x.mean(axis=-2, keepdims=True)
    b = (tc[:, None] * (x - mean)).sum(axis=-2, keepdims=True) / (tc ** 2).sum()
    future = np.arange(n + 1, 2 * n + 1, dtype=float)
    return mean + (future - t.mean())[:, None] * b


def model_steps(minute_counts: DataFrame, n: int = STEPS) -> DataFrame:
    """W3 + W4: each area's first ``n`` minutes in time order, padded with zero rows up to ``n``."""
    picked = first_steps(minute_counts, ["area_l2"], "minute", n)
    return pad_steps(picked.select("area_l1", "area_l2", "step", *C.COUNTERS), ["area_l2"], n, C.COUNTERS,
                     carry_cols=["area_l1"])


def event_minute_counts(ballots: DataFrame) -> DataFrame:
    """A1 by minute of event time (rounded, whole days apart), with the newest ballot of each minute."""
    rows = ballots.select("area_l1", "area_l2", F.expr("(log_ms + 30000) DIV 60000").alias("event_minute"), "log_ms",
                          flags.male_flag("sex").alias("male"), flags.female_flag("sex").alias("female"),
                          *flags.age_flags("age", C.LIVE_BINS))
    return rows.groupBy("area_l1", "area_l2", "event_minute").agg(
        *[F.sum(c).cast("long").alias(c) for c in C.COUNTERS], F.max("log_ms").alias("newest_ms"))


def newest_minute(minutes: DataFrame) -> "F.Column":
    """The newest minute of a frame as a scalar subquery."""
    return minutes.agg(F.max("event_minute").alias("m")).select("m").scalar()


def last_hour_steps(minutes: DataFrame, pairs: DataFrame, n: int = STEPS) -> DataFrame:
    """W3 + W4 by the clock: the ``n`` minutes up to the newest one, for every area pair; a minute without
    ballots is a zero row, whether it is a gap or an area that was silent."""
    grid = pairs.select("area_l1", "area_l2").distinct().select(
        "area_l1", "area_l2", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))).alias("step"))
    grid = grid.withColumn("event_minute", newest_minute(minutes) - n + F.col("step"))
    j = grid.join(minutes, ["area_l1", "area_l2", "event_minute"], "left")
    return j.select("area_l1", "area_l2", "step", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in C.COUNTERS])


def group_forecaster(model: Callable[[np.ndarray], np.ndarray]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("step")
        x = pdf[C.COUNTERS].to_numpy(dtype=float)
        lo, hi = x.min(axis=0), x.max(axis=0)
        if "lo_male" in pdf and pdf["lo_male"].notna().all():
            lo, hi = (pdf[[f"{e}_{c}" for c in C.COUNTERS]].to_numpy(dtype=float)[0] for e in ("lo", "hi"))
        span = np.where(hi == lo, 1.0, hi - lo)
        y = np.asarray(model((x - lo) / span), dtype=float)
        total = y.sum(axis=0) * span + lo          # inverse of a sum: lo added once (published rule)
        counts = np.trunc(np.round(total, SNAP_DECIMALS)).astype("int64")
        row = {"area_l1": int(pdf["area_l1"].iloc[0]), "area_l2": int(pdf["area_l2"].iloc[0])}
        row.update({c: int(v) for c, v in zip(C.COUNTERS, counts)})
        return pd.DataFrame([row])
    return run


def with_bounds(steps: DataFrame, params: DataFrame) -> DataFrame:
    """Steps with the stored bounds (K4: area_id, lo_*, hi_*) of their area, null where it has none."""
    bounds = [f"{e}_{c}" for c in C.COUNTERS for e in ("lo", "hi")]
    return steps.join(params.select(F.col("area_id").alias("area_l2"), *[F.col(b).cast("double").alias(b) for b in bounds]), "area_l2", "left")


def forecast_steps(steps: DataFrame, model: Callable[[np.ndarray], np.ndarray] = trend_model,
                   params: DataFrame | None = None) -> DataFrame:
    """M5: one forecast row per area_l2 -- scale, model, sum the predicted steps, invert, cut to integers
    (negative forecasts are kept).  Scaled by the group's own min/max (published behaviour), or by the
    stored ``params`` (K4: area_id, lo_*, hi_*) of areas that have any."""
    ship_package(steps.sparkSession)
    if params is not None:
        steps = with_bounds(steps, params)
    return steps.groupBy("area_l2").applyInPandas(group_forecaster(model), FORECAST_SCHEMA)


def forecast(minute_counts: DataFrame, model: Callable[[np.ndarray], np.ndarray] = trend_model,
             params: DataFrame | None = None) -> DataFrame:
    """M5 from each area's first 60 minutes (published behaviour)."""
    return forecast_steps(model_steps(minute_counts), model, params)


def forecast_last_hour(minutes: DataFrame, pairs: DataFrame, model: Callable[[np.ndarray], np.ndarray] = trend_model,
                       params: DataFrame | None = None) -> DataFrame:
    """M5 from the last clock hour of event time, for every area pair."""
    return forecast_steps(last_hour_steps(minutes, pairs), model, params)


def trend_forecast_sql(minute_counts: DataFrame) -> DataFrame:
    """The built-in trend model as plain aggregates (regr_slope / regr_intercept per column)."""
    steps = model_steps(minute_counts)
    long = steps.unpivot(["area_l1", "area_l2", "step"], C.COUNTERS, "feature", "x")
    stats = long.groupBy("area_l1", "area_l2", "feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    j = long.join(stats, ["area_l1", "area_l2", "feature"])
    span = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise((F.col("hi") - F.col("lo")).cast("double"))
    j = j.withColumn("y", (F.col("x") - F.col("lo")) / span).withColumn("span", span)
    fit = j.groupBy("area_l1", "area_l2", "feature").agg(
        F.regr_slope("y", F.col("step").cast("double")).alias("b"),
        F.regr_intercept("y", F.col("step").cast("double")).alias("a"),
        F.first("span").alias("span"), F.first("lo").alias("lo"))
    total = (F.lit(float(STEPS)) * F.col("a") + F.lit(float(FUTURE_STEP_SUM)) * F.col("b")) * F.col("span") + F.col("lo")
    fit = fit.withColumn("v", F.round(total, SNAP_DECIMALS).cast("long"))
    return fit.groupBy("area_l1", "area_l2").pivot("feature", C.COUNTERS).agg(F.first("v")).select(
        "area_l1", "area_l2", *[F.col(c).cast("long") for c in C.COUNTERS])


# ---- evaluation (M8) -------------------------------------------------------------------------

EVAL_SCHEMA = T.StructType([T.StructField("dataset", T.LongType()), T.StructField("area_id", T.LongType()),
                            T.StructField("split", T.StringType()), T.StructField("n_windows", T.LongType()),
                            T.StructField("mse", T.DoubleType()),
                            T.StructField("last_counts", T.ArrayType(T.LongType()))])


def windows_of(grid: pd.DataFrame) -> np.ndarray:
    """(window, step, counter): every stretch of 60 inputs and 60 targets of a scaled grid in minute order."""
    x = grid.sort_values("minute")[C.COUNTERS].to_numpy(dtype=float)
    n = C.WINDOW_IN + C.WINDOW_OUT
    if len(x) < n:
        return np.zeros((0, n, len(C.COUNTERS)))
    return np.lib.stride_tricks.sliding_window_view(x, n, axis=0).transpose(0, 2, 1)


def split_parts(n: int) -> list[tuple[str, slice]]:
    """The chronological split (W9) of ``n`` windows."""
    n_test = math.ceil(C.TEST_FRACTION * n)
    return [("train", slice(0, n - n_test)), ("test", slice(n - n_test, n))]


def window_errors(grid: pd.DataFrame, model: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Mean squared error of the model on each window of a series."""
    cut = windows_of(grid)
    return ((np.asarray(model(cut[:, :C.WINDOW_IN]), dtype=float) - cut[:, C.WINDOW_IN:]) ** 2).mean(axis=(1, 2))


def evaluate(series: DataFrame, model: Callable[[np.ndarray], np.ndarray] = trend_model) -> DataFrame:
    """Mean squared error of the model on each window's targets, per series and split,
    and the last window's forecast back in counts (summed steps, inverse-scaled with the
    series' ``lo_*``/``hi_*`` parameters, rounded half-even).

    ``series`` is the scaled grid (at most 720 rows per series); the windows are cut in the task.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = (pdf[[f"{e}_{c}" for c in C.COUNTERS]].to_numpy(dtype=float)[0] for e in ("lo", "hi"))
        span = np.where(hi == lo, 1.0, hi - lo)
        cut = windows_of(pdf)
        predicted = np.asarray(model(cut[:, :C.WINDOW_IN]), dtype=float)
        errors = ((predicted - cut[:, C.WINDOW_IN:]) ** 2).mean(axis=(1, 2))
        total = np.rint(np.round(predicted.sum(axis=1) * span + lo, SNAP_DECIMALS)).astype("int64")
        rows = []
        for split, part in split_parts(len(cut)):
            if len(errors[part]):
                rows.append({"dataset": int(pdf["dataset"].iloc[0]), "area_id": int(pdf["area_id"].iloc[0]), "split": split,
                             "n_windows": len(errors[part]), "mse": round(float(errors[part].mean()), SNAP_DECIMALS),
                             "last_counts": total[part][-1].tolist()})
        return pd.DataFrame(rows, columns=[f.name for f in EVAL_SCHEMA.fields])
    ship_package(series.sparkSession)
    return series.groupBy("dataset", "area_id").applyInPandas(run, EVAL_SCHEMA)
