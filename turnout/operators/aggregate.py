"""Live summaries (A2-A5, A17): counts per area level and hour, from one pass over ballots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import flags
from turnout.functions.timeofday import hour_of

SUMMARY_MEASURES = (["total", "male", "female"] + [b[0] for b in C.SUMMARY_BINS]
                    + [f"ry_{y}" for y in C.REG_YEARS])

# level -> grouping columns (a subset of area_l1, area_l2, hour)
LEVEL_KEYS = {
    "nation": [],
    "l1": ["area_l1"],
    "l2": ["area_l1", "area_l2"],
    "hour": ["hour"],
    "l1_hour": ["area_l1", "hour"],
    "l2_hour": ["area_l1", "area_l2", "hour"],
}
_ALL_KEYS = ["area_l1", "area_l2", "hour"]


def ballot_measures(ballots: DataFrame) -> list[Column]:
    """Per-ballot 0/1 measure expressions (live gender rule, closed summary age intervals)."""
    out = ["1 AS total", f"{flags.male_sql('sex')} AS male", f"{flags.female_sql('sex')} AS female"]
    out += flags.age_flags_sql("age", C.SUMMARY_BINS, closed=True)
    out += [f"CAST(CASE WHEN reg_year = {y} THEN 1 ELSE 0 END AS BIGINT) AS ry_{y}" for y in C.REG_YEARS]
    return [F.expr(e) for e in out]


def _measure_rows(ballots: DataFrame) -> DataFrame:
    return ballots.select("area_l1", "area_l2", hour_of(F.col("log_ms")).alias("hour"), *ballot_measures(ballots))


def _sums(cols=SUMMARY_MEASURES) -> list[Column]:
    return [F.expr(f"CAST(sum({m}) AS BIGINT) AS {m}") for m in cols]


def _shape(df: DataFrame, level: str) -> DataFrame:
    keys = LEVEL_KEYS[level]
    area = ("area_l2" if "area_l2" in keys else "area_l1" if "area_l1" in keys else None)
    return df.select(
        F.lit(level).alias("level"),
        (F.col(area) if area else F.lit(0)).cast("long").alias("area_id"),
        *[(F.col(k) if k in keys else F.lit(None)).cast("long").alias(k) for k in _ALL_KEYS],
        *SUMMARY_MEASURES,
    )


def level_counts(ballots: DataFrame, level: str) -> DataFrame:
    """One summary level straight from ballots: a single partial+final hash aggregate."""
    rows = _measure_rows(ballots)
    keys = LEVEL_KEYS[level]
    agg = rows.groupBy(*keys).agg(*_sums()) if keys else rows.agg(*_sums())
    return _shape(agg, level)


ALL_LEVELS = ("nation", "l1", "l2", "hour", "l1_hour", "l2_hour")


def summaries(ballots: DataFrame, levels=ALL_LEVELS) -> DataFrame:
    """Every requested level at once.

    Ballots are first reduced to (area_l1, area_l2, hour) -- one pass, combined map-side -- and
    the grouping sets run over that small result, so raw rows are never expanded per level.
    Output rows carry ``level`` and ``area_id`` (0 at nation level).
    """
    return rollup(_measure_rows(ballots).groupBy(*_ALL_KEYS).agg(*_sums()), levels)


def summaries_eager(events: DataFrame, citizens: DataFrame, levels=ALL_LEVELS) -> DataFrame:
    """A17 when ballots still need the citizen -> area lookup: aggregate first, look up after.

    Measures depend only on the event row, and the area is a function of the citizen, so the
    events are summed per (citizen, hour) before the join.  The partial aggregate runs map-side,
    so a citizen holding a third of all events becomes one row per hour before any shuffle, and
    the join moves per-citizen rows instead of ballots.
    """
    rows = events.select("user_id", hour_of(F.col("log_ms")).alias("hour"), *ballot_measures(events))
    per_citizen = rows.groupBy("user_id", "hour").agg(*_sums())
    j = per_citizen.join(citizens, per_citizen.user_id == citizens.citizen_id)
    return rollup(j.groupBy(*_ALL_KEYS).agg(*_sums()), levels)


def rollup(base: DataFrame, levels=ALL_LEVELS) -> DataFrame:
    """Grouping sets over per-(area_l1, area_l2, hour) sums."""
    sets = [LEVEL_KEYS[lv] for lv in levels]
    rolled = base.groupingSets(sets, *_ALL_KEYS).agg(*_sums(), F.grouping_id().alias("_gid"))
    gid_of = {lv: sum(1 << (2 - i) for i, k in enumerate(_ALL_KEYS) if k not in LEVEL_KEYS[lv]) for lv in levels}
    level_col = F.lit(None).cast("string")
    for lv, g in gid_of.items():
        level_col = F.when(F.col("_gid") == g, F.lit(lv)).otherwise(level_col)
    rolled = rolled.withColumn("level", level_col)
    area = (F.when(F.col("level").isin("l2", "l2_hour"), F.col("area_l2"))
             .when(F.col("level").isin("l1", "l1_hour"), F.col("area_l1")).otherwise(F.lit(0)))
    return rolled.select("level", area.cast("long").alias("area_id"),
                         *[F.col(k).cast("long") for k in _ALL_KEYS], *SUMMARY_MEASURES)


def at_level(summary: DataFrame, level: str) -> DataFrame:
    return summary.filter(F.col("level") == level)
