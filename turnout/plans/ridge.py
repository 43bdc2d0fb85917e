"""Models fitted per area from its history: a ridge autoregression per counter (M4, M5, M8, UD2).

The next minute of a scaled counter is predicted from its last ``LAGS`` minutes.  What a least-squares fit needs of the
rows are sums of products, so the fit is one aggregate over all areas, counters and datasets, combined map-side; the
small systems that it leaves (one per area and counter) are solved in batches.  The coefficients are a table, which
forecasts and evaluations join or cogroup with their series, so that each area is forecast by its own model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout import constants as C
from turnout.plans import forecast as FC
from turnout.plans.history import KEYS
from turnout.session import ship_package

LAGS = 3
PENALTY = 0.001   # per row, on centred products
DECIMALS = 6
TREND, RIDGE, LAST = "trend", "ridge", "last"

MODEL_SCHEMA = T.StructType([T.StructField("area_id", T.LongType()), T.StructField("feature", T.StringType()),
                             T.StructField("n_rows", T.LongType()), T.StructField("intercept", T.DoubleType()),
                             T.StructField("weights", T.ArrayType(T.DoubleType()))])


def training_cut(n_minutes: int) -> int:
    """Minutes of a series that may teach: those before the first target of its test windows."""
    n_windows = n_minutes - C.WINDOW_IN - C.WINDOW_OUT + 1
    return n_windows - math.ceil(C.TEST_FRACTION * n_windows) + C.WINDOW_IN


def lagged(series: DataFrame, lags: int = LAGS) -> DataFrame:
    """(dataset, area_id, feature, k, y, x1..xp): every minute of a scaled grid with its ``lags`` minutes before, the
    latest first; k counts the minutes from 0."""
    long = series.unpivot([*KEYS, "minute"], [F.col(c) for c in C.COUNTERS], "feature", "y")
    w = Window.partitionBy(*KEYS, "feature").orderBy("minute")  # at most 720 rows
    rows = long.select(*KEYS, "feature", (F.row_number().over(w) - 1).alias("k"), "y", *[F.lag("y", i).over(w).alias(f"x{i}") for i in range(1, lags + 1)])
    return rows.filter(F.col("k") >= lags)


def normal_sums(rows: DataFrame, lags: int = LAGS) -> DataFrame:
    """Per (area, feature): n and the sums of y, of the lags, and of their products, as arrays."""
    x = [f"x{i}" for i in range(1, lags + 1)]
    return rows.groupBy("area_id", "feature").agg(
        F.count("*").alias("n"), F.sum("y").alias("sy"), F.array(*[F.sum(a) for a in x]).alias("sx"),
        F.array(*[F.sum(F.col(a) * F.col("y")) for a in x]).alias("sxy"),
        F.array(*[F.sum(F.col(a) * F.col(b)) for a in x for b in x]).alias("sxx"))


def solve_ridge(n, sy, sx, sxy, sxx, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts and weights of a batch of systems, from uncentred sums; the intercept is not penalised."""
    p = sx.shape[1]
    mean = sx / n[:, None]
    gram = sxx.reshape(-1, p, p) - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    right = sxy - mean * sy[:, None]
    weights = np.linalg.solve(gram + (penalty * n)[:, None, None] * np.eye(p), right[:, :, None])[:, :, 0]
    return sy / n - (weights * mean).sum(axis=1), weights


def _solver(penalty: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            stack = [np.stack(f[c].to_list()) for c in ("sx", "sxy", "sxx")]
            intercept, weights = solve_ridge(f["n"].to_numpy(float), f["sy"].to_numpy(float), *stack, penalty)
            yield pd.DataFrame({"area_id": f["area_id"], "feature": f["feature"], "n_rows": f["n"], "intercept": np.round(intercept, DECIMALS),
                                "weights": list(np.round(weights, DECIMALS))})
    return run


def fit_ridge(series: DataFrame, lags: int = LAGS, penalty: float = PENALTY, upto: int | None = None) -> DataFrame:
    """One model per (area_id, feature) from all datasets of the area: intercept and weights of the last ``lags`` minutes,
    the latest first.  ``upto`` leaves out rows from that minute of each series on (they are for testing)."""
    ship_package(series.sparkSession)
    rows = lagged(series, lags)
    if upto is not None:
        rows = rows.filter(F.col("k") < upto)
    return normal_sums(rows, lags).mapInPandas(_solver(penalty), MODEL_SCHEMA)


def roll_forward(x: np.ndarray, intercept: np.ndarray, weights: np.ndarray, n_out: int) -> np.ndarray:
    """Next ``n_out`` steps of (..., n, k) series by an autoregression per column, each step fed by those before it."""
    p = weights.shape[1]
    last = [x[..., -i, :] for i in range(1, p + 1)]
    out = []
    for _ in range(n_out):
        step = intercept + sum(weights[:, i] * last[i] for i in range(p))
        out.append(step)
        last = [step, *last[:-1]]
    return np.stack(out, axis=-2)


def area_model(rows: pd.DataFrame):
    """The callable that the model rows of an area name, one per counter; an area without rows has the trend."""
    kinds = set(rows["kind"]) if "kind" in rows and len(rows) else {RIDGE} if len(rows) else {TREND}
    if kinds == {TREND}:
        return FC.trend_model
    if kinds == {LAST}:
        return lambda x: np.repeat(x[..., -1:, :], C.WINDOW_OUT, axis=-2)
    if kinds != {RIDGE}:
        raise ValueError(f"an area has one kind of model: {sorted(kinds)}")
    rows = rows.set_index("feature").loc[C.COUNTERS]
    intercept, weights = rows["intercept"].to_numpy(float), np.stack(rows["weights"].to_list()).astype(float)
    return lambda x: roll_forward(x, intercept, weights, C.WINDOW_OUT)


def forecast_area_models(steps: DataFrame, models: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """UD2: one forecast row per area_l2, each by its own model.  ``models`` has (area_id, feature, intercept, weights) and
    may have ``kind``; an area without a model is forecast by the trend.  Series and models of an area meet in a cogroup:
    60 rows and nine."""
    if params is not None:
        steps = FC.with_bounds(steps, params)
    ship_package(steps.sparkSession)

    def run(series: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(series):  # a model of an area without a series
            return pd.DataFrame([], columns=[f.name for f in FC.FORECAST_SCHEMA.fields])
        return FC.group_forecaster(area_model(model))(series)

    return steps.groupBy("area_l2").cogroup(models.groupBy("area_id")).applyInPandas(run, FC.FORECAST_SCHEMA)


EVAL_SCHEMA = T.StructType([*FC.EVAL_SCHEMA.fields[:4], T.StructField("mse", T.DoubleType()), T.StructField("mse_trend", T.DoubleType())])


def evaluate_area_models(series: DataFrame, models: DataFrame) -> DataFrame:
    """M8 with a model per area: mean squared error of each area's own model, and of the trend, per series and split."""
    ship_package(series.sparkSession)
    names = [f.name for f in EVAL_SCHEMA.fields]

    def run(grid: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for (dataset, area), one in grid.groupby(KEYS):
            own, trend = (FC.window_errors(one, m) for m in (area_model(model), FC.trend_model))
            for split, part in FC.split_parts(len(own)):
                if len(own[part]):
                    rows.append((dataset, area, split, len(own[part]), round(float(own[part].mean()), FC.SNAP_DECIMALS),
                                 round(float(trend[part].mean()), FC.SNAP_DECIMALS)))
        return pd.DataFrame(rows, columns=names)

    return series.groupBy("area_id").cogroup(models.groupBy("area_id")).applyInPandas(run, EVAL_SCHEMA)
