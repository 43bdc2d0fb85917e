"""Joins in meaning (J1-J11): denominator lookups, gap filling, overlays, seeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.percent import failing


def with_registered(df: DataFrame, reg: DataFrame, on: str = "area_id", prefix: str = "reg_",
                    how: str = "left") -> DataFrame:
    """Attach registered counts by area.

    ``how="left"`` keeps areas missing from the dimension (their counts are null and the
    percentage policy decides); ``how="inner"`` is the lookup where an unknown area has
    no result; ``how="strict"`` fails the query at the first unknown area and names it, in the plan
    and without a job of its own.  The dimension has one row per area; Spark broadcasts it when its measured size
    is under the broadcast threshold (AQE re-plans on runtime statistics), else sort-merges.
    """
    r = reg.selectExpr(f"{on} AS _rk", *[f"{c} AS {prefix}{c}" for c in reg.columns if c != on])
    if how != "strict":
        return df.join(r, df[on] == r["_rk"], how).drop("_rk")
    j = df.join(r, df[on] == r["_rk"], "left")
    return j.filter(F.expr(f"CASE WHEN _rk IS NULL THEN {failing('no registered voters:', on)} ELSE true END")).drop("_rk")


def with_registered_levels(df: DataFrame, registered: dict[str, DataFrame], how: str = "left", prefix: str = "reg_") -> DataFrame:
    """``with_registered`` for rows of several levels at once: one dimension keyed by (level, area_id), one join."""
    parts = [r.selectExpr(f"'{lv}' AS _rl", "area_id AS _rk", *[f"{c} AS {prefix}{c}" for c in r.columns if c != "area_id"])
             for lv, r in registered.items()]
    r = reduce(lambda a, b: a.unionByName(b), parts)
    return df.join(r, (df["level"] == r["_rl"]) & (df["area_id"] == r["_rk"]), how).drop("_rl", "_rk")


def with_national(df: DataFrame, nat: DataFrame, prefix: str = "reg_") -> DataFrame:
    """National denominators against national rows.  Nation-level rows carry ``area_id = 0``
    like the one-row national dimension, so this is an equi-join on that key, not a product."""
    return with_registered(df, nat, on="area_id", prefix=prefix)


def densify(df: DataFrame, keys: list[str], step_col: str, lo: int, hi: int, fill_cols: list[str]) -> DataFrame:
    """Every key combination present x every step in [lo, hi]; missing counters -> 0.

    One pass: a key's rows (one per step, so at most hi - lo + 1) become a map from step to counters,
    and the steps are looked up in it.  No self-join, and the input is read once.
    """
    row = F.struct(*[F.col(c).cast("long").alias(c) for c in fill_cols])
    per_key = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(step_col).cast("long"), row))).alias("_at"))
    steps = per_key.select(*keys, "_at", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"))).alias(step_col))
    found = steps.select(*keys, step_col, F.try_element_at("_at", F.col(step_col)).alias("_row"))
    return found.selectExpr(*keys, step_col, *[f"coalesce(_row.{c}, 0L) AS {c}" for c in fill_cols])


def overlay_last(stats: DataFrame, fc: DataFrame, keys: list[str], x: str, y: str, order: str,
                 keep_stats_without_forecast: bool = True) -> DataFrame:
    """Live points plus the *last* forecast point per key; on the same x the forecast wins.

    ``keep_stats_without_forecast=False`` reproduces the published behaviour where an empty
    forecast drops the live points as well.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    last = (fc.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
              .select(*keys, F.col(x), F.col(y).alias("_fy"), F.col(order).alias("_fo")))
    st = stats if keep_stats_without_forecast else stats.join(last.select(*keys), keys, "left_semi")
    j = st.select(*keys, F.col(x), F.col(y).alias("_sy")).join(last, keys + [x], "full")
    return j.select(*keys, F.col(x),
                    F.coalesce(F.col("_fy"), F.col("_sy")).alias(y),
                    F.when(F.col("_fy").isNotNull(), F.lit("forecast")).otherwise(F.lit("stats")).alias("source"))
