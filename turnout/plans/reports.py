"""The twenty turnout reports (R1-R20) and two helpers (H1, H2), for every area at once.

Each report returns long rows ``(level, area_id, area_name, series, x, x_ord, y)``: ``level`` and
``area_id`` name the chart owner (nation reports: level "nation", id 0), ``x``/``x_ord`` the
axis label and its order, ``series`` the inner key of stacked charts, ``y`` the value.
Percentages follow the published rounding (E = half-even, U = half-up) and the zero/missing
denominator rule of each report.  A report for all areas is one query: summaries are grouped
once, denominators are one-row-per-area lookups (broadcast when Spark measures them small), and
no per-area loop exists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import percent as P
from turnout.functions.timeofday import ampm_hour, hour_12h
from turnout.operators.joins import overlay_last, with_national, with_registered, with_registered_levels
from turnout.operators.reshape import columns_with_suffix, strip_suffix, unpivot_measures
from turnout.operators.windows import cumulative, last_per, top_k, top_per_group
from turnout.plans.inputs import Inputs
from turnout.sources.dims import with_area_name

OUT = ["level", "area_id", "area_name", "series", "x", "x_ord", "y"]
AREA_LEVELS = [C.LEVEL_L1, C.LEVEL_L2]
AGE_COLS = [b[0] for b in C.SUMMARY_BINS]


def _finish(df: DataFrame, inp: Inputs, nation: bool = False) -> DataFrame:
    """Attach area names and the common column types.  Nation charts have one owner, so their
    name is a constant rather than a join on constant keys (which would plan as a nested loop)."""
    named = df.withColumn("area_name", F.lit(C.LEVEL_NATION)) if nation else with_area_name(df, inp.names)
    return named.selectExpr("level", "CAST(area_id AS BIGINT) AS area_id", "area_name", "CAST(series AS STRING) AS series",
                            "CAST(x AS STRING) AS x", "CAST(x_ord AS BIGINT) AS x_ord", "y")


def _nation(df: DataFrame) -> DataFrame:
    return df.withColumn("level", F.lit(C.LEVEL_NATION)).withColumn("area_id", F.lit(0).cast("long"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _pairs(df: DataFrame, pairs: list[tuple[str, Column]], keys: list[str], series: str | None = None) -> DataFrame:
    """Wide (one column per label) -> long (x, x_ord, y) in the listed order: one select and one
    unpivot, so the input is read once whatever the number of labels."""
    cols = [f"_v{i}" for i in range(len(pairs))]
    wide = df.select(*keys, *[val.alias(c) for c, (_, val) in zip(cols, pairs)])
    long = unpivot_measures(wide, keys, cols, "x", "y", labels={c: lbl for c, (lbl, _) in zip(cols, pairs)})
    return long.select(*keys, "x", F.col("x_ord"), "y", F.lit(series or C.STATS).alias("series"))


# ---- forecast table helpers ------------------------------------------------------------------

def prediction_level(inp: Inputs, level: str) -> DataFrame:
    p = inp.prediction
    if level == C.LEVEL_NATION:
        return p.withColumn("area_id", F.lit(0).cast("long"))
    return p.withColumn("area_id", F.col("area_l1" if level == C.LEVEL_L1 else "area_l2").cast("long"))


def forecast_by_slot(inp: Inputs, level: str = C.LEVEL_NATION) -> DataFrame:
    """SUM(male + female) per time slot (and area)."""
    return (prediction_level(inp, level).groupBy("area_id", "time_slot")
            .agg(F.sum(F.col("male") + F.col("female")).cast("long").alias("total"))
            .withColumn("level", F.lit(level)).withColumn("hour", F.hour("time_slot").cast("long")))


def _strict(inp: Inputs, num: str, den: str, rounding: str = P.EVEN) -> Column:
    """A percentage whose zero denominator raises in the published code: null, or an error that names the area."""
    return P.percent(num, den, rounding, inp.on_zero, what=("area_id",))


# ---- nation reports --------------------------------------------------------------------------

def r1_forecast_by_hour(inp: Inputs, cumulative_total: bool = False) -> DataFrame:
    """Forecast turnout per hour slot; same hour: the later slot wins; null -> 0.

    Not cumulative, as published (the area version R17 is); ``cumulative_total=True`` runs a
    total over the hours like R17.
    """
    s = forecast_by_slot(inp)
    if cumulative_total:
        s = cumulative(s, [], [F.col("hour"), F.col("time_slot")], "total", "cum").withColumn("total", F.col("cum"))
    s = last_per(s, ["hour"], ["time_slot"])
    s = with_national(s, inp.reg_nat)
    y = F.coalesce(P.percent("total", "reg_voters", P.EVEN, P.ZERO_NULL), F.lit(0).cast("long"))
    return _finish(s.select("level", "area_id", F.lit(C.FORECASTED).alias("series"),
                            F.col("hour").cast("string").alias("x"), F.col("hour").alias("x_ord"), y.alias("y")), inp, nation=True)


def time_summary(inp: Inputs) -> DataFrame:
    """Hourly national turnout summary: cumulative ballots up to each hour / registered voters."""
    h = inp.level("hour").select("area_id", "hour", "total")
    # national running total over at most 24 aggregated rows: one window partition is the right size
    h = cumulative(h, [], [F.col("hour")], "total", "cum_total")
    h = with_national(h, inp.reg_nat)
    return h.select("hour", hour_12h("hour").alias("v_time"),
                    P.percent("cum_total", "reg_voters", P.NONE, P.ZERO_NULL).alias("percentage"))


def r2_hour_summary(inp: Inputs, legacy_ampm_order: bool = True) -> DataFrame:
    t = _nation(time_summary(inp))
    return _finish(t.select("level", "area_id", F.lit(C.STATS).alias("series"), F.col("v_time").alias("x"),
                            ampm_hour("v_time", legacy=legacy_ampm_order).alias("x_ord"),
                            P.round_pct(F.col("percentage"), P.EVEN).alias("y")), inp, nation=True)


def _with_forecast(stats: DataFrame, fc: DataFrame, keep_live: bool) -> DataFrame:
    o = overlay_last(stats, fc, ["level", "area_id"], "x", "y", "fo", keep_stats_without_forecast=keep_live)
    return o.select("level", "area_id", F.when(F.col("source") == "forecast", F.lit(C.FORECASTED))
                    .otherwise(F.lit(C.STATS)).alias("series"), "x",
                    ampm_hour("x").alias("x_ord"), "y")


def r3_turnout_with_forecast(inp: Inputs, keep_live: bool = True) -> DataFrame:
    stats = r2_hour_summary(inp).select("level", "area_id", "x", "y")
    fc = r1_forecast_by_hour(inp).select("level", "area_id", hour_12h("x_ord").alias("x"), "y",
                                         F.col("x_ord").alias("fo"))
    return _finish(_with_forecast(stats, fc, keep_live), inp, nation=True)


def r4_gender_turnout(inp: Inputs) -> DataFrame:
    n = with_national(inp.level(C.LEVEL_NATION), inp.reg_nat)
    pairs = [("M", _strict(inp, "male", "reg_male_count")), ("F", _strict(inp, "female", "reg_female_count"))]
    return _finish(_pairs(n, pairs, ["level", "area_id"]), inp, nation=True)


def top_ages_summary(inp: Inputs) -> DataFrame:
    """Per single year of age: ballots / registered voters of that age (unrounded percentage).

    The counts are those of the frames' caller (a live job passes its running counts).
    """
    j = inp.ages.join(inp.reg_ages.withColumnRenamed("n", "den"), "age", "left")
    return j.select("age", P.percent("n", "den", P.NONE, P.ZERO_NULL).alias("percentage"))


def r5_top_ages(inp: Inputs, k: int = 10) -> DataFrame:
    """TOP 10 ages by percentage (ties: younger first); values as stored, no rounding."""
    t = top_ages_summary(inp).filter(F.col("percentage").isNotNull())
    t = top_k(t, [F.col("percentage").desc(), F.col("age")], k)
    return _finish(_nation(t).select("level", "area_id", F.lit(C.STATS).alias("series"),
                                     F.concat(F.lit("Age_"), F.col("age").cast("string")).alias("x"),
                                     "x_ord", F.col("percentage").alias("y")), inp, nation=True)


def _prediction_totals(inp: Inputs, level: str, cols: list[str]) -> DataFrame:
    p = prediction_level(inp, level)
    return p.groupBy("area_id").agg(*[F.sum(c).cast("long").alias(c) for c in cols]).withColumn("level", F.lit(level))


def r6_gender_forecast(inp: Inputs) -> DataFrame:
    n = with_national(_prediction_totals(inp, C.LEVEL_NATION, ["male", "female"]), inp.reg_nat)
    pairs = [("Male", _strict(inp, "male", "reg_male_count")), ("Female", _strict(inp, "female", "reg_female_count"))]
    return _finish(_pairs(n, pairs, ["level", "area_id"], C.FORECASTED), inp, nation=True)


def registered_age_fold(inp: Inputs) -> DataFrame:
    """Single-age registered counts folded into the six forecast age classes (21..30, ..., 61..70, 71+)."""
    a = inp.reg_ages
    classes = [(lbl, lo, hi) for lbl, (_, lo, hi) in zip(C.FORECAST_AGE_LABELS, C.SUMMARY_BINS)]
    sums = [F.sum(F.when((F.col("age") >= lo) & ((F.col("age") <= hi) if hi else F.lit(True)), F.col("n"))
                  .otherwise(0)).cast("long").alias(f"d{i}") for i, (_, lo, hi) in enumerate(classes)]
    labels = F.array(*[F.struct(F.lit(lbl).alias("label"), F.lit(i + 1).cast("long").alias("label_ord"), F.col(f"d{i}").alias("n"))
                       for i, (lbl, _, _) in enumerate(classes)])
    return a.agg(*sums).select(F.inline(labels))


def r7_age_forecast(inp: Inputs) -> DataFrame:
    cols = [f"col_{i}" for i in range(1, 7)]
    t = _prediction_totals(inp, C.LEVEL_NATION, cols)
    long = unpivot_measures(t, ["level", "area_id"], cols, "col", "n")
    fold = registered_age_fold(inp).withColumnRenamed("n", "den")
    j = long.join(fold, long.col_ord == fold.label_ord)
    return _finish(j.select("level", "area_id", F.lit(C.FORECASTED).alias("series"), F.col("label").alias("x"),
                            F.col("label_ord").alias("x_ord"),
                            P.percent("n", "den", P.EVEN, P.ZERO_ZERO).alias("y")), inp, nation=True)


def _area_axis(df: DataFrame, level: str, inp: Inputs) -> DataFrame:
    """Nation chart whose x axis is the areas of one level: x = area name, x_ord = area id."""
    named = with_area_name(df.withColumn("level", F.lit(level)), inp.names, out="x")
    return named.withColumn("x_ord", F.col("area_id")).withColumn("level", F.lit(C.LEVEL_NATION)).withColumn(
        "area_id", F.lit(0).cast("long"))


def _series(df: DataFrame, pairs: list) -> DataFrame:
    """One row per area and (label, value) pair, from one pass over ``df``."""
    return df.select("area_id", F.inline(F.array(*[F.struct(F.lit(lbl).alias("series"), y.alias("y")) for lbl, y in pairs])))


def r8_region_gender_turnout(inp: Inputs) -> DataFrame:
    s = with_registered(inp.level(C.LEVEL_L1), inp.reg_l1)
    pct = lambda n, d: P.percent(n, d, P.EVEN, P.ZERO_NULL, P.MISSING_PCT_ZERO)
    long = _series(s, [("MalePercentage", pct("male", "reg_male_count")), ("FemalePercentage", pct("female", "reg_female_count"))])
    return _finish(_area_axis(long, C.LEVEL_L1, inp), inp, nation=True)


def r9_wilayat_gender_top10(inp: Inputs, k: int = 10) -> DataFrame:
    s = top_k(inp.level(C.LEVEL_L2), [(F.col("male") + F.col("female")).desc(), F.col("area_id")], k).drop("x_ord")
    s = with_registered(s, inp.reg_l2)
    pct = lambda n, d: P.percent(n, d, P.EVEN, P.ZERO_NULL, P.MISSING_PCT_ZERO)
    long = _series(s, [("M", pct("male", "reg_male_count")), ("F", pct("female", "reg_female_count"))])
    return _finish(_area_axis(long, C.LEVEL_L2, inp), inp, nation=True)


def r10_age_turnout(inp: Inputs) -> DataFrame:
    n = with_national(inp.level(C.LEVEL_NATION), inp.reg_nat)
    pairs = [(lbl, _strict(inp, c, "reg_" + c)) for lbl, c in zip(C.SUMMARY_LABELS, AGE_COLS)]
    return _finish(_pairs(n, pairs, ["level", "area_id"]), inp, nation=True)


def r11_regyear_turnout(inp: Inputs) -> DataFrame:
    n = with_national(inp.level(C.LEVEL_NATION), inp.reg_nat)
    pairs = [(f"RY_{y}", _strict(inp, f"ry_{y}", f"reg_ry_{y}", P.UP)) for y in C.REG_YEARS]
    return _finish(_pairs(n, pairs, ["level", "area_id"]), inp, nation=True)


def r12_region_turnout(inp: Inputs) -> DataFrame:
    s = with_registered(inp.level(C.LEVEL_L1), inp.reg_l1)
    long = s.select("area_id", F.lit(C.STATS).alias("series"),
                    _strict(inp, "total", "reg_voters").alias("y"))
    return _finish(_area_axis(long, C.LEVEL_L1, inp), inp, nation=True)


def area_age_percent(inp: Inputs, level: str) -> DataFrame:
    """Six age percentages per area; a zero or missing denominator gives 1 (published rule)."""
    s = with_registered(inp.level(level), inp.registered(level))
    wide = s.select("area_id", *[P.percent(c, "reg_" + c, P.EVEN, P.ZERO_ONE).alias(c) for c in AGE_COLS])
    return unpivot_measures(wide, ["area_id"], AGE_COLS, "label", "pct",
                            labels=dict(zip(AGE_COLS, C.SUMMARY_LABELS)))


def _age_top2(inp: Inputs, level: str, n_areas: int = 10, n_labels: int = 2) -> DataFrame:
    long = area_age_percent(inp, level)
    named = with_area_name(long.withColumn("level", F.lit(level)), inp.names)
    means = named.groupBy("area_id", "area_name").agg(F.avg("pct").alias("m"))
    top = top_k(means, [F.col("m").desc(), F.col("area_name")], n_areas)
    kept = named.join(top.select("area_id"), "area_id", "left_semi")
    best = top_per_group(kept, ["area_id"], [F.col("pct").desc(), F.col("label_ord")], n_labels)
    out = best.select("area_id", F.col("label").alias("series"), F.col("pct").alias("y"))
    return _finish(_area_axis(out, level, inp), inp, nation=True)


def r13_region_age_top2(inp: Inputs) -> DataFrame:
    return _age_top2(inp, C.LEVEL_L1)


def r14_wilayat_age_top2(inp: Inputs) -> DataFrame:
    return _age_top2(inp, C.LEVEL_L2)


# ---- area reports (every l1 and l2 area in one query) ----------------------------------------

def _areas(inp: Inputs) -> dict[str, DataFrame]:
    return {lv: inp.registered(lv) for lv in AREA_LEVELS}


KEYS = ["level", "area_id"]


def _hourly_cumulative(inp: Inputs) -> DataFrame:
    h = inp.levels(*[f"{lv}_hour" for lv in AREA_LEVELS]).select(
        F.expr("replace(level, '_hour', '') AS level"), "area_id", "hour", "total")
    h = cumulative(h, KEYS, [F.col("hour")], "total", "cum_total")
    h = with_registered_levels(h, _areas(inp), how="inner")
    return h.select(*KEYS, F.lit(C.STATS).alias("series"), F.col("hour").cast("string").alias("x"), F.col("hour").alias("x_ord"),
                    _strict(inp, "cum_total", "reg_voters").alias("y"))


def r15_area_cumulative_turnout(inp: Inputs) -> DataFrame:
    return _finish(_hourly_cumulative(inp), inp)


def r16_area_gender_turnout(inp: Inputs) -> DataFrame:
    s = with_registered_levels(inp.levels(*AREA_LEVELS), _areas(inp), how="inner")
    pairs = [("M", P.percent("male", "reg_male_count", P.EVEN, P.ZERO_ZERO)),
             ("F", P.percent("female", "reg_female_count", P.EVEN, P.ZERO_ZERO))]
    return _finish(_pairs(s, pairs, KEYS), inp)


def _prediction_areas(inp: Inputs, *columns: str) -> DataFrame:
    """Prediction rows as rows of both area levels: each is listed for its region and for its wilayat."""
    areas = F.inline(F.array(*[F.struct(F.lit(lv).alias("level"), F.col(c).cast("long").alias("area_id"))
                               for lv, c in ((C.LEVEL_L1, "area_l1"), (C.LEVEL_L2, "area_l2"))]))
    return inp.prediction.select(areas, *columns)


def _forecast_cumulative(inp: Inputs, cumulative_total: bool = True) -> DataFrame:
    s = _prediction_areas(inp, "time_slot", "male", "female").groupBy(*KEYS, "time_slot").agg(
        F.sum(F.col("male") + F.col("female")).cast("long").alias("total")).withColumn("hour", F.hour("time_slot").cast("long"))
    if cumulative_total:
        s = cumulative(s, KEYS, [F.col("hour"), F.col("time_slot")], "total", "cum_total")
    else:
        s = s.withColumn("cum_total", F.col("total"))
    s = last_per(s, [*KEYS, "hour"], ["time_slot"])
    s = with_registered_levels(s, _areas(inp), how="inner")
    y = F.coalesce(P.percent("cum_total", "reg_voters", P.EVEN, P.ZERO_ZERO), F.lit(0).cast("long"))
    return s.select(*KEYS, F.lit(C.FORECASTED).alias("series"), F.col("hour").cast("string").alias("x"), F.col("hour").alias("x_ord"), y.alias("y"))


def r17_area_forecast_cumulative(inp: Inputs, cumulative_total: bool = True) -> DataFrame:
    """Area forecast per hour slot as a running total (published rule, although the forecast
    already contains the live totals); ``cumulative_total=False`` gives per-slot values."""
    return _finish(_forecast_cumulative(inp, cumulative_total), inp)


def r18_area_turnout_with_forecast(inp: Inputs, keep_live: bool = True) -> DataFrame:
    stats = _hourly_cumulative(inp).select(*KEYS, hour_12h("x_ord").alias("x"), "y")
    fc = _forecast_cumulative(inp).select(*KEYS, hour_12h("x_ord").alias("x"), "y", F.col("x_ord").alias("fo"))
    return _finish(_with_forecast(stats, fc, keep_live), inp)


def r19_area_gender_forecast(inp: Inputs) -> DataFrame:
    t = _prediction_areas(inp, "male", "female").groupBy(*KEYS).agg(F.expr("CAST(sum(male) AS BIGINT) AS male"), F.expr("CAST(sum(female) AS BIGINT) AS female"))
    t = with_registered_levels(t, _areas(inp), how="inner")
    pairs = [("Male", _strict(inp, "male", "reg_male_count", P.UP)), ("Female", _strict(inp, "female", "reg_female_count", P.UP))]
    return _finish(_pairs(t, pairs, KEYS, C.FORECASTED), inp)


def r20_area_age_turnout(inp: Inputs) -> DataFrame:
    """Six age percentages of each area: missing area divides by 1, zero denominator gives null.

    The percentage columns are named ``<interval>_Percentage``, picked by that suffix (U7) and
    unpivoted with the suffix stripped from the label (F21).
    """
    suffix = "_Percentage"
    s = with_registered_levels(inp.levels(*AREA_LEVELS), _areas(inp))
    wide = s.selectExpr(*KEYS, *[f"cast({P.percent_sql(c, 'reg_' + c, P.EVEN, P.ZERO_NULL, P.MISSING_DEN_ONE)} as double) AS {lbl}{suffix}"
                                 for lbl, c in zip(C.SUMMARY_LABELS, AGE_COLS)])
    long = unpivot_measures(wide, KEYS, columns_with_suffix(wide, suffix), "x", "y")
    return _finish(long.select(*KEYS, strip_suffix(F.col("x"), suffix).alias("x"), "x_ord", "y", F.lit(C.STATS).alias("series")), inp)


# ---- helpers H1, H2 --------------------------------------------------------------------------

def h1_area_names(inp: Inputs) -> DataFrame:
    """Names of every area that has ballots, at both levels; an unknown id shows as text."""
    ids = inp.level(C.LEVEL_L1).select("level", "area_id").unionByName(inp.level(C.LEVEL_L2).select("level", "area_id"))
    return with_area_name(ids, inp.names)


def h2_hour_12h(inp: Inputs) -> DataFrame:
    """12-hour labels of every hour that has ballots."""
    return inp.level("hour").select("hour", hour_12h("hour").alias("label"))


REPORTS = {
    "forecast_by_hour": r1_forecast_by_hour,
    "hour_summary": r2_hour_summary,
    "turnout_with_forecast": r3_turnout_with_forecast,
    "gender_turnout": r4_gender_turnout,
    "top_ages": r5_top_ages,
    "gender_forecast": r6_gender_forecast,
    "age_forecast": r7_age_forecast,
    "region_gender_turnout": r8_region_gender_turnout,
    "wilayat_gender_top10": r9_wilayat_gender_top10,
    "age_turnout": r10_age_turnout,
    "regyear_turnout": r11_regyear_turnout,
    "region_turnout": r12_region_turnout,
    "region_age_top2": r13_region_age_top2,
    "wilayat_age_top2": r14_wilayat_age_top2,
    "area_cumulative_turnout": r15_area_cumulative_turnout,
    "area_gender_turnout": r16_area_gender_turnout,
    "area_forecast_cumulative": r17_area_forecast_cumulative,
    "area_turnout_with_forecast": r18_area_turnout_with_forecast,
    "area_gender_forecast": r19_area_gender_forecast,
    "area_age_turnout": r20_area_age_turnout,
}
