"""Chart documents and report bundles.

Report rows become one JSON chart per (report, level, area); bundles are JSON lines, one per
area and endpoint, written with ``partitionBy("endpoint")``.  Each chart gathers only its own
axis points (hours, labels, top-k entries), so no group grows with the ballot count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions.jsontext import json_object, json_value
from turnout.plans import reports as R
from turnout.plans.inputs import Inputs

# Chart descriptors per report: (type, graph, info, x label, y label, sub-info).  "{name}" is replaced
# by the name of the area, the nation's too.
CHART_SPECS = {
    "forecast_by_hour": (C.FORECASTED, "LineGraph", "{name}: expected turnout by hour", "Hour", "Polling Percentage", None),
    "hour_summary": (C.STATS, "LineGraph", "{name}: turnout by hour", "Hours", "Polling Percentage", None),
    "turnout_with_forecast": (C.FORECASTED, "LineGraph", "{name}: expected turnout by hour", "Hour", "Polling Percentage", None),
    "gender_turnout": (C.STATS, "radial", "{name}: turnout of men and women so far", "", "", None),
    "top_ages": (C.STATS, "BarGraph", "{name}: ages with the highest turnout", "Age", "Polling Percentage", None),
    "gender_forecast": (C.FORECASTED, "BarGraph", "{name}: expected turnout of men and women", "Gender", "Polling Percentage", None),
    "age_forecast": (C.FORECASTED, "BarGraph", "{name}: expected turnout by age class", "Age", "Polling Percentage", None),
    "region_gender_turnout": (C.STATS, "ColumnStackedChart", "{name}: turnout of men and women by region", "Region",
                              "percentage of polling", "Gender"),
    "wilayat_gender_top10": (C.STATS, "ColumnStackedChart", "{name}: turnout of men and women in the largest wilayats", "Wilayat",
                             "percentage of polling", "Gender"),
    "age_turnout": (C.STATS, "BarGraph", "{name}: turnout by age class", "Age interval", "Percentage", None),
    "regyear_turnout": (C.STATS, "BarGraph", "{name}: turnout by year of registration", "RY_YEAR", "Percentage", None),
    "region_turnout": (C.STATS, "BarGraph", "{name}: turnout by region", "Region", "Percentage of polling", None),
    "region_age_top2": (C.STATS, "ColumnStackedChart", "{name}: the two strongest age classes by region", "Region",
                        "Percentage of polling", "Age"),
    "wilayat_age_top2": (C.STATS, "ColumnStackedChart", "{name}: the two strongest age classes in ten wilayats",
                         "Wilayat", "Percentage of polling", "Age"),
    "area_cumulative_turnout": (C.STATS, "LineGraph", "{name}: turnout by hour", "Time", "Percentage of Total", None),
    "area_gender_turnout": (C.STATS, "radial", "{name}: turnout of men and women", "Gender", "percentage of polling", None),
    "area_forecast_cumulative": (C.FORECASTED, "LineGraph", "{name}: expected turnout by hour", "Hour", "Polling Percentage", None),
    "area_turnout_with_forecast": (C.FORECASTED, "LineGraph", "{name}: expected turnout by hour", "Hour", "Polling Percentage", None),
    "area_gender_forecast": (C.FORECASTED, "radial", "{name}: expected turnout of men and women", "Gender", "Percentage of polling", None),
    "area_age_turnout": (C.STATS, "BarGraph", "{name}: turnout by age class", "Age interval", "Percentage of polling", None),
}

NATION_ALWAYS = ["hour_summary", "gender_turnout", "turnout_with_forecast"]
NATION_PICK_1 = ["top_ages", "region_gender_turnout", "wilayat_gender_top10", "age_turnout", "regyear_turnout",
                 "region_turnout", "region_age_top2", "wilayat_age_top2"]
NATION_PICK_2 = ["gender_forecast", "age_forecast"]
AREA_BUNDLE = ["area_cumulative_turnout", "area_gender_turnout", "area_turnout_with_forecast", "area_gender_forecast",
               "area_age_turnout"]
LANG_ENDPOINTS = ["nation", "nation_en", "nation_cn", "nation_ru", "nation_fr", "nation_es"]
# reports whose values are published as floats (fixed values)
FLOATS = {"region_gender_turnout", "wilayat_gender_top10", "regyear_turnout", "area_gender_forecast", "area_age_turnout"}
STACKED = {k for k, v in CHART_SPECS.items() if v[1] == "ColumnStackedChart"}


def report_rows(inp: Inputs, names: list[str]) -> DataFrame:
    """Long rows of several reports with a ``report`` column; y as its JSON text: whole numbers, but for
    the reports that publish floats."""
    def text(name: str) -> Column:
        return json_value(F.col("y").cast("double") if name in FLOATS else F.col("y"))
    frames = [R.REPORTS[n](inp).withColumn("report", F.lit(n)).withColumn("y", text(n)) for n in names]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _spec_col(idx: int) -> Column:
    m = F.create_map(*[x for k, v in CHART_SPECS.items() for x in (F.lit(k), F.lit(v[idx]))])
    return m[F.col("report")]


def charts(rows: DataFrame) -> DataFrame:
    """One JSON chart per (report, level, area_id) ordered by ``x_ord``."""
    keys = ["report", "level", "area_id", "area_name"]
    flat = rows.filter(~F.col("report").isin(*STACKED))
    ordered = lambda: F.array_sort(F.collect_list(F.struct("x_ord", "x", "y"))).alias("p")
    nested = rows.filter(F.col("report").isin(*STACKED)).groupBy(*keys, "x", "x_ord").agg(
        F.array_sort(F.collect_list(F.struct(F.col("series").alias("x"), "y"))).alias("p")).select(
        *keys, "x", "x_ord", json_object(F.col("p")).alias("y"))
    plots = flat.select(*keys, "x", "x_ord", "y").unionByName(nested).groupBy(*keys).agg(ordered()).select(
        *keys, json_object(F.col("p")).alias("plots"))
    info = F.regexp_replace(_spec_col(2), r"\{name\}", F.coalesce(F.col("area_name"), F.lit("")))
    doc = F.struct(_spec_col(0).alias("type"), _spec_col(1).alias("graph"), info.alias("info"),
                   _spec_col(5).alias("suinfo"), F.array(_spec_col(3), _spec_col(4)).alias("xandy"))
    # plots are already JSON text; splice them into the document text
    chart = F.concat(F.expr("substring(to_json(doc), 1, length(to_json(doc)) - 1)"), F.lit(',"plots":'), F.col("plots"), F.lit("}"))
    return plots.withColumn("doc", doc).select(*keys, chart.alias("chart"))


def pick_u(batch_id: Column, name: Column) -> Column:
    """Uniform (0, 1) draw that repeats for the same (batch, name): the first 52 bits of
    md5("<batch>:<name>"), so any engine with md5 draws the same numbers."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", batch_id.cast("string"), name)), 1, 13), 16, 10).cast("double")
    return (h + F.lit(0.5)) / F.lit(float(1 << 52))


def weighted_pick(candidates: list[tuple[int, str, float]], batches: DataFrame, k: int = 1) -> DataFrame:
    """weighted choice of ``k`` names per (batch, group) without replacement.

    Exponential keys ``-ln(u) / w`` (smallest first) give the weighted draw; the draw is a
    hash of (batch, name), so replaying a batch picks the same charts.  The candidates are a
    fixed list of ten, attached to each batch row by exploding a literal array.
    """
    from pyspark.sql import Window
    lit_rows = F.array(*[F.struct(F.lit(g).alias("grp"), F.lit(n).alias("name"), F.lit(w).alias("weight"))
                         for g, n, w in candidates])
    j = batches.select("batch_id", F.explode(lit_rows).alias("c")).select("batch_id", "c.*")
    j = j.withColumn("key", -F.log(pick_u(F.col("batch_id"), F.col("name"))) / F.col("weight"))
    w = Window.partitionBy("batch_id", "grp").orderBy("key", "name")
    return (j.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)
             .select("batch_id", "grp", "name", "rank"))


PICK_ROWS = ([(1, n, float(w)) for n, w in zip(NATION_PICK_1, C.NATION_PICK_WEIGHTS)]
                              + [(2, n, float(w)) for n, w in zip(NATION_PICK_2, C.FORECAST_PICK_WEIGHTS)])




def bundles(inp: Inputs, batch_id: int = 0) -> DataFrame:
    """(endpoint, area_key, charts JSON array) -- nation bundle for every language endpoint,
    and one line per area for the region and wilayat endpoints."""
    spark = inp.spark
    picks = weighted_pick(PICK_ROWS, spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")))
    chosen = [r["name"] for r in picks.collect()]          # two names: the pick itself, not data
    nation_names = NATION_ALWAYS + chosen
    pos = {n: i for i, n in enumerate(nation_names + AREA_BUNDLE)}
    ch = charts(report_rows(inp, nation_names + AREA_BUNDLE))
    ch = ch.withColumn("pos", F.create_map(*[x for n, i in pos.items() for x in (F.lit(n), F.lit(i))])[F.col("report")])
    grouped = ch.groupBy("level", "area_id").agg(F.array_sort(F.collect_list(F.struct("pos", "chart"))).alias("c"))
    arr = F.concat(F.lit("["), F.array_join(F.col("c.chart"), ","), F.lit("]"))
    per_area = grouped.select("level", F.col("area_id").cast("string").alias("area_key"), arr.alias("charts"),
                              F.size("c").alias("n_charts"))
    nation = per_area.filter(F.col("level") == C.LEVEL_NATION)
    langs = F.explode(F.array(*[F.lit(e) for e in LANG_ENDPOINTS])).alias("endpoint")
    nation_out = nation.select(langs, "area_key", "charts", "n_charts")
    area_out = per_area.filter(F.col("level") != C.LEVEL_NATION).select(
        F.when(F.col("level") == C.LEVEL_L1, F.lit("region")).otherwise(F.lit("wilayat")).alias("endpoint"),
        "area_key", "charts", "n_charts")
    return nation_out.unionByName(area_out)


def write_reports(b: DataFrame, path: str) -> None:
    """K3: JSON lines per endpoint folder; an HTTP forwarder can stream them line by line."""
    b.write.mode("overwrite").partitionBy("endpoint").json(path)
