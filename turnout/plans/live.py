"""Live path query builders: CDC log -> decoded ballots -> features -> minute counts, plus the
smaller operator checks on ballots (flags, rounding, filters, policies, dimensions)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import flags
from turnout.functions import percent as P
from turnout.functions import timeofday as tod
from turnout.operators.features import ballot_features, drop_incomplete, minute_counts
from turnout.operators.joins import with_national, with_registered
from turnout.operators.reshape import pivot_series, unpivot_measures
from turnout.plans.inputs import Inputs
from turnout.session import scratch_path
from turnout.sources import cdc
from turnout.sources import proof_views as pv
from turnout.sources.dims import read_registered, write_registered_doc
from turnout.sources.tables import save_bucketed, table


def latest_offsets(log: DataFrame) -> dict[int, int]:
    """Next offset per log partition (one row per partition reaches the driver)."""
    return {r["partition"]: r["next"] for r in
            log.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()}


def cdc_range_read(spark: SparkSession, data_dir: str) -> DataFrame:
    """Write the change log as a Parquet log, then read the middle half of its offsets back."""
    path = scratch_path(spark, "cdc-log")
    pv.cdc_raw(spark, data_dir).write.mode("overwrite").parquet(path)
    log = spark.read.schema(cdc.LOG_SCHEMA).parquet(path)
    latest = latest_offsets(log)
    start, end = {p: n // 4 for p, n in latest.items()}, {p: n - n // 4 for p, n in latest.items()}
    batch = cdc.read_cdc_batch(spark, {"path": path}, start, end)
    return batch.select("topic", "partition", "offset", F.col("value").isNotNull().cast("long").alias("has_value"))


def cdc_decode(spark: SparkSession, data_dir: str) -> DataFrame:
    return cdc.decode_cdc(pv.cdc_raw(spark, data_dir))


def features(spark: SparkSession, data_dir: str, carry: bool = True) -> DataFrame:
    return ballot_features(pv.ballots(spark, data_dir), carry=carry)


def live_minute_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    return minute_counts(features(spark, data_dir))


def gender_flags(spark, data_dir, history_rule: bool = False) -> DataFrame:
    b = pv.ballots(spark, data_dir)
    return b.select("event_id", "sex", flags.male_flag("sex").alias("male"),
                    flags.female_flag("sex", other_is_female=history_rule).alias("female"))


def age_flag_rows(spark, data_dir, bins, closed: bool = False) -> DataFrame:
    b = pv.ballots(spark, data_dir)
    return b.select("event_id", "age", *flags.age_flags("age", bins, closed))


def drop_incomplete_rows(spark, data_dir) -> DataFrame:
    return drop_incomplete(pv.ballots(spark, data_dir).select("event_id", "age", "sex"))


def minute_round(spark, data_dir, carry: bool = True) -> DataFrame:
    b = pv.ballots(spark, data_dir)
    return b.select("event_id", "log_ms", tod.minute_key(b.log_ms, carry=carry).alias("minute"))


def time_of_day(spark, data_dir) -> DataFrame:
    b = pv.ballots(spark, data_dir)
    return b.select("event_id", tod.time_of_day(b.log_ms).alias("time_of_day"))


def minute_truncate(spark, data_dir) -> DataFrame:
    b = pv.ballots(spark, data_dir)
    return b.select("event_id", tod.truncated_minute_key(b.log_ms).alias("minute"))


def within_hours(df: DataFrame, col: str = "minute", lo: str = C.POLL_START, hi: str = C.POLL_END) -> DataFrame:
    """P10: inclusive time-of-day filter on ``HH:mm`` strings (a null time drops out)."""
    return df.filter(F.col(col).between(lo, hi))


def polling_hours_filter(spark, data_dir) -> DataFrame:
    return within_hours(minute_truncate(spark, data_dir))


def for_areas(df: DataFrame, level_col: str, areas: DataFrame, area_col: str = "area_id") -> DataFrame:
    """Keep rows of the given areas (a semi join, so any number of areas runs as one query)."""
    return df.join(areas.select(F.col(area_col).alias(level_col)).distinct(), level_col, "left_semi")


def area_filter(spark, data_dir) -> DataFrame:
    b = pv.ballots(spark, data_dir)
    return for_areas(b.select("event_id", "area_l2"), "area_l2", pv.registered_l2(spark, data_dir))


def area_rollup(spark, data_dir) -> DataFrame:
    inp = Inputs(spark, data_dir)
    inp.level("nation")
    return inp.summary


def summary_scan(spark, data_dir) -> DataFrame:
    """The written l2 summary as a catalog view; projection and filter reach its scan."""
    path = scratch_path(spark, "l2-summary")
    Inputs(spark, data_dir).level("l2").write.mode("overwrite").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("l2_summary")
    return table(spark, "l2_summary", ["area_id", "total", "male", "female"], F.col("total") > 0)


SUMMARY_BUCKETS = 8


def summary_area_tables(spark, data_dir) -> tuple[str, str, str]:
    """Names of the written summary (partitioned by level), registered voters and forecast totals, all in buckets by area."""
    inp = Inputs(spark, data_dir)
    inp.level("nation")
    names = tuple(f"{n}_{uuid.uuid4().hex[:12]}" for n in ("summary", "registered", "predicted"))
    save_bucketed(inp.summary, names[0], scratch_path(spark, "summary"), "area_id", SUMMARY_BUCKETS, partition_by="level")
    save_bucketed(inp.reg_l2, names[1], scratch_path(spark, "registered"), "area_id", SUMMARY_BUCKETS)
    predicted = inp.prediction.groupBy(F.col("area_l2").alias("area_id")).agg(F.sum(F.col("male") + F.col("female")).cast("long").alias("predicted"))
    save_bucketed(predicted, names[2], scratch_path(spark, "predicted"), "area_id", SUMMARY_BUCKETS)
    return names


def summary_area_rows(spark, names: tuple[str, str, str], areas: list[int] | None = None) -> DataFrame:
    """Turnout and forecast totals of l2 areas (all, or those named) from the bucketed tables: the level prunes partitions,
    the areas prune buckets, and the joins need no exchange."""
    where = F.col("level") == C.LEVEL_L2
    if areas is not None:
        where = where & F.col("area_id").isin(areas)
    s = with_registered(table(spark, names[0], ["area_id", "total"], where), table(spark, names[1], ["area_id", "voters"]))
    s = s.join(table(spark, names[2]), "area_id", "left")
    return s.select("area_id", "total", F.col("reg_voters").alias("voters"), P.percent("total", "reg_voters").alias("pct"), "predicted")


def summary_area_scan(spark, data_dir) -> DataFrame:
    return summary_area_rows(spark, summary_area_tables(spark, data_dir))


def registered_dim(spark, data_dir, level: str = C.LEVEL_L2) -> DataFrame:
    """The registered voters of a level as documents, written and read back."""
    path = scratch_path(spark, f"registered-{level}")
    write_registered_doc(Inputs(spark, data_dir).registered(level), path, level)
    return read_registered(spark, path, level)


def area_dim_rows(spark, data_dir) -> DataFrame:
    return Inputs(spark, data_dir).dim


def coerce_bad_values(spark, data_dir) -> DataFrame:
    """History text columns coerced -- an unparsable date or number becomes null."""
    b = pv.ballots(spark, data_dir)
    raw = b.select(
        "event_id",
        F.when(b.event_id % 59 == 0, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_text"),
        F.coalesce(b.age.cast("string"), F.lit("unknown")).alias("age_text"),
    )
    return raw.select(
        "event_id",
        F.date_format(F.try_to_timestamp("ts_text", F.lit("yyyy-MM-dd HH:mm:ss")), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.col("age_text").try_cast("long").alias("age"),
    )


def pct_rounding(spark, data_dir, rounding: str) -> DataFrame:
    inp = Inputs(spark, data_dir)
    s = with_registered(inp.level("l2"), pv.registered_l2_full(spark, data_dir))
    return s.select("area_id", P.percent("male", "reg_male_count", rounding).alias("pct"))


def zero_denominator_policy(spark, data_dir) -> DataFrame:
    inp = Inputs(spark, data_dir)
    s = with_registered(inp.level("l2"), inp.reg_l2)
    f, d = "female", "reg_female_count"
    return s.select(
        "area_id",
        P.percent(f, d, P.EVEN, P.ZERO_NULL).alias("p_error"),
        P.percent(f, d, P.EVEN, P.ZERO_ZERO).alias("p_zero"),
        P.percent(f, d, P.EVEN, P.ZERO_ONE).alias("p_one"),
        P.percent(f, d, P.EVEN, P.ZERO_NULL, P.MISSING_PCT_ZERO).alias("p_missing_zero"),
        P.percent(f, d, P.EVEN, P.ZERO_NULL, P.MISSING_DEN_ONE).alias("p_missing_one"),
    )


def national_turnout(spark, data_dir) -> DataFrame:
    inp = Inputs(spark, data_dir)
    n = with_national(inp.level("nation"), inp.reg_nat)
    return n.select("total", F.col("reg_voters").alias("voters"),
                    P.percent("total", "reg_voters").alias("pct"))


def region_age_turnout(spark, data_dir) -> DataFrame:
    from turnout.plans.reports import area_age_percent
    return area_age_percent(Inputs(spark, data_dir), "l1")


def area_lookup_strict(spark, data_dir, raise_on_unknown: bool = False) -> DataFrame:
    """Inner lookup; ``raise_on_unknown`` makes an area without registered voters fail the query."""
    inp = Inputs(spark, data_dir)
    j = with_registered(inp.level("l2"), inp.reg_l2, how="strict" if raise_on_unknown else "inner")
    return j.select("area_id", "total", F.col("reg_voters").alias("voters"))


def forecast_by_slot_rows(spark, data_dir) -> DataFrame:
    from turnout.plans.reports import forecast_by_slot
    inp = Inputs(spark, data_dir)
    frames = [forecast_by_slot(inp, lv) for lv in (C.LEVEL_NATION, C.LEVEL_L1, C.LEVEL_L2)]
    out = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return out.select("level", "area_id", F.date_format("time_slot", "yyyy-MM-dd HH:mm:ss").alias("time_slot"), "total")


def next_hour_slot(spark, data_dir) -> DataFrame:
    per = pv.ballot_events(spark, data_dir).groupBy("user_id").agg(F.max("ts").alias("ts"))
    areas = pv.citizen_areas(spark, data_dir)
    last = per.join(areas, per.user_id == areas.citizen_id).groupBy("area_l2").agg(F.max("ts").alias("as_of"))
    return last.select("area_l2", F.date_format(tod.next_hour_slot(F.col("as_of")), "yyyy-MM-dd HH:mm:ss").alias("slot"))


def area_hourly(spark, data_dir) -> DataFrame:
    inp = Inputs(spark, data_dir)
    s = inp.level("l1_hour").unionByName(inp.level("l2_hour"))
    return s.select("level", "area_id", "hour", "total")


def age_unpivot(spark, data_dir) -> DataFrame:
    s = Inputs(spark, data_dir).level("l1")
    cols = [b[0] for b in C.SUMMARY_BINS]
    return unpivot_measures(s, ["area_id"], cols, "label", "n", labels=dict(zip(cols, C.SUMMARY_LABELS)))


def gender_pivot(spark, data_dir) -> DataFrame:
    from turnout.plans.reports import r8_region_gender_turnout
    rows = r8_region_gender_turnout(Inputs(spark, data_dir))
    return pivot_series(rows, ["x"], "series", "y", ["MalePercentage", "FemalePercentage"]).withColumnRenamed("x", "area_name")


def ampm_order(spark, data_dir) -> DataFrame:
    from turnout.plans.reports import time_summary
    t = time_summary(Inputs(spark, data_dir))
    return t.select(F.col("v_time").alias("label"), tod.ampm_hour("v_time", legacy=True).alias("legacy_ord"),
                    tod.ampm_hour("v_time").alias("hour_ord"))
