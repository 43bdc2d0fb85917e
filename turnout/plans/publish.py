"""Query builders for chart documents, weighted chart picks and report bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.operators.reshape import plots_json
from turnout.plans import charts as CH
from turnout.plans import reports as R
from turnout.plans.inputs import Inputs
from turnout.session import scratch_path
from turnout.sources import proof_views as pv


def chart_plots_json(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ordered ``{hour: percentage}`` maps of the area running-turnout report, one per area."""
    rows = R.r15_area_cumulative_turnout(Inputs(spark, data_dir))
    return plots_json(rows, ["level", "area_id"])


def weighted_pick(spark: SparkSession, data_dir: str) -> DataFrame:
    """One pick from each weighted list for every day of ballots (a day = one batch, id = day number)."""
    days = pv.ballot_events(spark, data_dir).select(
        "user_id", F.datediff(F.to_date("ts"), F.lit("1970-01-01")).cast("long").alias("batch_id")).distinct()
    known = pv.citizen_areas(spark, data_dir).select(F.col("citizen_id").alias("user_id"))
    batches = days.join(known, "user_id", "left_semi").select("batch_id").distinct()
    return CH.weighted_pick(CH.PICK_ROWS, batches)


def report_bundle_json(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bundles written as JSON lines per endpoint, read back and taken apart: one row per plotted value."""
    path = scratch_path(spark, "bundles")
    CH.write_reports(CH.bundles(Inputs(spark, data_dir)), path)
    lines = spark.read.schema("area_key string, charts string, n_charts int, endpoint string").json(path)
    chart = "array<struct<type: string, graph: string, info: string, plots: map<string, string>>>"
    each = lines.select("endpoint", "area_key", F.posexplode(F.from_json("charts", chart)).alias("position", "c"))
    plots = each.select("endpoint", "area_key", F.col("position").cast("long").alias("position"), "c.type", "c.graph", "c.info",
                        F.explode("c.plots").alias("x", "y"))
    # a stacked chart has an object of series at each label, others one value
    series = F.when(F.col("y").startswith("{"), F.from_json("y", "map<string, double>")).otherwise(
        F.create_map(F.lit(""), F.col("y").cast("double")))
    return plots.select(*[c for c in plots.columns if c != "y"], F.explode(series).alias("series", "y"))
