"""Prediction table (K1, K2, J5, J7, M7, P17, F16): seed, add live totals, upsert.

The table is keyed by (area_l1, area_l2).  Plain Parquet has no MERGE, so an upsert is a left
join of the table with the batch's updates followed by writing a new version; the update sets
absolute values, so replaying a batch gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout import constants as C

KEYS = ["area_l1", "area_l2"]


def seed_predictions(pred: DataFrame, pairs: DataFrame, slot: DataFrame) -> DataFrame:
    """One zero row for every hierarchy pair not yet in the table.

    ``slot`` is a one-row frame with column ``slot`` (the next full hour of the batch); it enters
    as a scalar subquery.
    """
    missing = pairs.select(*KEYS).distinct().join(pred.select(*KEYS), KEYS, "left_anti")
    zeros = missing.select(*KEYS, slot.select("slot").scalar().alias("time_slot"),
                           *[F.lit(0).cast("long").alias(c) for c in C.PREDICTION_COUNTERS])
    return pred.select(*KEYS, "time_slot", *C.PREDICTION_COUNTERS).unionByName(zeros)


def add_live_totals(fc: DataFrame, live_l2: DataFrame) -> DataFrame:
    """J5 + P17: forecast + live wilayat totals; the two oldest forecast classes and the live 71+
    total fold into ``col_6``.  An area without a live summary row gets no update (inner join)."""
    live = live_l2.select(F.col("area_id").alias("area_l2"), F.col("male").alias("l_male"),
                          F.col("female").alias("l_female"),
                          *[F.col(b[0]).alias(f"l_{i + 1}") for i, b in enumerate(C.SUMMARY_BINS)])
    j = fc.join(live, "area_l2")
    return j.select(
        "area_l1", "area_l2",
        (F.col("male") + F.col("l_male")).alias("male"),
        (F.col("female") + F.col("l_female")).alias("female"),
        *[(F.col(f"col_{i}") + F.col(f"l_{i}")).alias(f"col_{i}") for i in range(1, 6)],
        (F.col("col_6") + F.col("col_7") + F.col("l_6")).alias("col_6"),
    )


def upsert_predictions(pred: DataFrame, updates: DataFrame, slot: DataFrame) -> DataFrame:
    """K2: matching (area_l1, area_l2) rows take the update and the new slot; others are unchanged."""
    u = updates.select(*KEYS, *[F.col(c).alias(f"u_{c}") for c in C.PREDICTION_COUNTERS]).withColumn("_hit", F.lit(True))
    u = u.withColumn("slot", slot.select("slot").scalar())
    j = pred.join(u, KEYS, "left")
    hit = F.col("_hit").isNotNull()
    return j.select(
        *KEYS,
        F.when(hit, F.col("slot")).otherwise(F.col("time_slot")).alias("time_slot"),
        *[F.when(hit, F.col(f"u_{c}")).otherwise(F.col(c)).cast("long").alias(c) for c in C.PREDICTION_COUNTERS],
    )
