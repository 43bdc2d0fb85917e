"""Ballot feature rows (P2-P9, F2-F6) and per-minute counts (A1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import flags
from turnout.functions import timeofday as tod


def ballot_features(ballots: DataFrame, carry: bool = True, bins=C.LIVE_BINS,
                    other_is_female: bool = False, keep: tuple = ()) -> DataFrame:
    """time of day, rounded minute, area ids, gender and age one-hots; one row per ballot."""
    return ballots.select(
        *keep,
        tod.time_of_day(F.col("log_ms")).alias("time_of_day"),
        tod.minute_key(F.col("log_ms"), carry=carry).alias("minute"),
        F.col("area_l1"), F.col("area_l2"),
        flags.male_flag("sex").alias("male"),
        flags.female_flag("sex", other_is_female).alias("female"),
        *flags.age_flags("age", bins),
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """A null anywhere drops the row."""
    return df.na.drop("any")


def minute_counts(features: DataFrame, counters=C.COUNTERS, colocate: int | None = None) -> DataFrame:
    """A1: nine sums per (area_l1, area_l2, minute), then incomplete rows dropped.

    Default: no repartition by area before the aggregate.  The hash aggregate combines map-side,
    so only (area, minute) partials cross the shuffle and a hot area cannot overload one task.

    ``colocate=n`` is T7, the published plan: hash-partition raw rows into ``n`` partitions by
    area_l2 first.  That one exchange then serves both this aggregate and a later per-area step,
    at the price of shuffling every raw row with no map-side combining.  Use it only when areas
    are many and even.
    """
    if colocate:
        features = features.repartition(int(colocate), "area_l2")
    agg = features.groupBy("area_l1", "area_l2", "minute").agg(
        *[F.sum(c).cast("long").alias(c) for c in counters])
    return drop_incomplete(agg)
