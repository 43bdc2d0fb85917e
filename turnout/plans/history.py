"""History preparation (M1, M2, M4): dense per-minute series, IQR outlier fence, min-max scaling,
sliding supervised windows and a chronological split -- for all areas and datasets in one job.

Series are keyed by (dataset, area_id); each group is bounded by the 720-minute polling day, so
window functions and exact quartiles never hold more than 720 rows per group, however many
ballots there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import flags
from turnout.functions.scaling import minmax_sql, zero_outliers_sql
from turnout.operators.joins import densify
from turnout.operators.windows import supervised_windows, time_split
from turnout.sources import proof_views as pv
from turnout.sources.history import coerce_history, read_history_files

KEYS = ["dataset", "area_id"]


def history_features(hist: DataFrame, area_col: str = "area_l2", split: bool = True) -> DataFrame:
    """History gender rule (not 1 -> female), history age classes, minute of day (cut)."""
    return hist.selectExpr(
        f"CAST({'dataset' if split else '0'} AS BIGINT) AS dataset",
        f"CAST({area_col} AS BIGINT) AS area_id",
        "CAST(substring(time, 1, 2) AS BIGINT) * 60 + CAST(substring(time, 4, 2) AS BIGINT) AS minute",
        f"{flags.male_sql('sex')} AS male",
        f"{flags.female_sql('sex', other_is_female=True)} AS female",
        *flags.age_flags_sql("age", C.HISTORY_BINS),
    )


def minute_series(feat: DataFrame) -> DataFrame:
    """Per (dataset, area, minute) sums."""
    return feat.groupBy(*KEYS, "minute").agg(*[F.expr(f"CAST(sum({c}) AS BIGINT) AS {c}") for c in C.COUNTERS])


def dense_grid(series: DataFrame) -> DataFrame:
    """Every (dataset, area) x 720 polling minutes, missing minutes 0."""
    return densify(series, KEYS, "minute", C.POLL_FIRST_MINUTE, C.POLL_LAST_MINUTE, C.COUNTERS)


def prepared(spark: SparkSession, data_dir: str, area_col: str = "area_l2", split: bool = True) -> DataFrame:
    """M1: history -> features -> per-minute sums -> dense 720-minute grid."""
    return dense_grid(minute_series(history_features(pv.history(spark, data_dir), area_col, split)))


def prepared_files(spark: SparkSession, paths: list[str], area_col: str = "area_l2") -> DataFrame:
    """M1 from history files in list order: each file is a dataset, and the first listed fits the scalers."""
    rows = coerce_history(read_history_files(spark, paths)).withColumn("time", F.date_format("ts", "HH:mm"))
    kept = rows.filter(F.col("time").between(C.POLL_START, C.POLL_END))
    return dense_grid(minute_series(history_features(kept, area_col, split=True)))


def iqr_bounds(dense: DataFrame, cols=C.COUNTERS) -> DataFrame:
    """Exact quartiles (linear interpolation) per (dataset, area) and column."""
    aggs = [F.expr(f"percentile(CAST({c} AS DOUBLE), array(0.25, 0.75)) AS _q_{c}") for c in cols]
    q = dense.groupBy(*KEYS).agg(*aggs)
    return q.selectExpr(*KEYS, *[x for c in cols for x in (f"_q_{c}[0] AS q1_{c}", f"_q_{c}[1] AS q3_{c}")])


def outliers_zeroed(dense: DataFrame, cols=C.COUNTERS) -> DataFrame:
    """values outside the strict 1.5 x IQR fence of their own series become 0."""
    # over each series' own rows (720 at most), so the grid is built once and not joined with itself
    w = Window.partitionBy(*KEYS)
    q = dense.select(*KEYS, "minute", *cols, *[
        F.expr(f"percentile(CAST({c} AS DOUBLE), array(0.25, 0.75))").over(w).alias(f"_q_{c}") for c in cols])
    return q.selectExpr(*KEYS, "minute", *[f"{zero_outliers_sql(c, f'_q_{c}[0]', f'_q_{c}[1]')} AS {c}" for c in cols])


def fit_minmax(zeroed: DataFrame, cols=C.COUNTERS) -> DataFrame:
    """Min and max per area, fitted on the first dataset in which the area appears.

    Min/max per (dataset, area) first, then ``min_by`` picks the first dataset's row per area:
    two small aggregates instead of a window sort over every grid row.
    """
    names = [x for c in cols for x in (f"lo_{c}", f"hi_{c}")]
    per = zeroed.groupBy(*KEYS).agg(*[F.expr(e) for c in cols for e in (f"min({c}) AS lo_{c}", f"max({c}) AS hi_{c}")])
    fit = per.groupBy("area_id").agg(F.min_by(F.struct(*names), F.col("dataset")).alias("_p"))
    return fit.select("area_id", *[F.col(f"_p.{n}").alias(n) for n in names])


def with_own_minmax(zeroed: DataFrame, cols=C.COUNTERS) -> DataFrame:
    """Every grid row with ``lo_*``/``hi_*`` of the first dataset of its area: ``fit_minmax`` as windows over
    the series and over the area's datasets, so a fit and its use share one pass."""
    names = [x for c in cols for x in (f"lo_{c}", f"hi_{c}")]
    series, area = Window.partitionBy(*KEYS), Window.partitionBy("area_id")
    own = F.struct(*[f(c).over(series).alias(f"{e}_{c}") for c in cols for e, f in (("lo", F.min), ("hi", F.max))])
    j = zeroed.select(*KEYS, "minute", *cols, own.alias("_own"))
    j = j.withColumn("_p", F.min_by("_own", "dataset").over(area))
    return j.select(*KEYS, "minute", *cols, *[F.col(f"_p.{n}").alias(n) for n in names])


def scale(bounded: DataFrame, cols=C.COUNTERS, keep: tuple = ()) -> DataFrame:
    """F18 on rows that carry their ``lo_*``/``hi_*``."""
    return bounded.selectExpr(*KEYS, "minute", *[f"{minmax_sql(c, f'lo_{c}', f'hi_{c}')} AS {c}" for c in cols], *keep)


def apply_minmax(zeroed: DataFrame, params: DataFrame, cols=C.COUNTERS) -> DataFrame:
    """F18 with stored parameters: later datasets reuse the scaler of the first."""
    return scale(zeroed.join(params, "area_id"), cols)


def scaled(spark: SparkSession, data_dir: str, area_col: str = "area_l1", split: bool = False) -> DataFrame:
    """M2: outliers zeroed, then min-max scaled with per-area parameters."""
    return scale(with_own_minmax(outliers_zeroed(prepared(spark, data_dir, area_col, split))))


def save_scaler(params: DataFrame, path: str) -> None:
    """K4: parameters as a table (one row per area); reused by later runs instead of pickles."""
    params.write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def windows(spark: SparkSession, data_dir: str, area_col: str = "area_l1", split: bool = False) -> DataFrame:
    """60-minute inputs and the next 60 minutes as targets, per series."""
    return supervised_windows(scaled(spark, data_dir, area_col, split), KEYS, "minute", C.COUNTERS,
                              C.WINDOW_IN, C.WINDOW_OUT)


def split_windows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Chronological split of the windows, the last 10 % (rounded up) per series as test."""
    w = windows(spark, data_dir)
    return time_split(w.select(*KEYS, "start"), KEYS, "start", C.TEST_FRACTION)
