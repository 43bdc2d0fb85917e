"""The frames every report reads, built lazily from one data directory."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import percent as P
from turnout.operators.aggregate import at_level, summaries_eager
from turnout.sources import proof_views as pv
from turnout.sources.dims import area_dim, area_names


@dataclass
class Inputs:
    """What the reports read.  Frames that are given are used; those that are not come from the proof views
    of ``data_dir`` (None: everything a report needs must be given)."""

    spark: SparkSession
    data_dir: str | None = None
    summary: DataFrame | None = None            # all levels, shared when many reports run together
    prediction_table: DataFrame | None = None   # the live prediction table, when reports follow an upsert
    registered_tables: dict[str, DataFrame] | None = None  # level -> registered voters (dims.read_registered)
    area_table: DataFrame | None = None         # (area_l1, l1_name, area_l2, l2_name)
    age_counts: DataFrame | None = None         # ballots per single year of age: (age, n)
    registered_age_counts: DataFrame | None = None  # registered voters per single year of age: (age, n)
    on_zero: str = P.ZERO_NULL                  # a zero denominator of R4, R6, R10-R12, R15, R19: null, or "error" as published

    @cached_property
    def reg_l2(self) -> DataFrame:
        return self.registered(C.LEVEL_L2)

    @cached_property
    def reg_l1(self) -> DataFrame:
        return self.registered(C.LEVEL_L1)

    @cached_property
    def reg_nat(self) -> DataFrame:
        return self.registered(C.LEVEL_NATION)

    @cached_property
    def reg_ages(self) -> DataFrame:
        if self.registered_age_counts is not None:
            return self.registered_age_counts
        return pv.registered_single_ages(self.spark, self.data_dir)

    @cached_property
    def ages(self) -> DataFrame:
        return self.age_counts if self.age_counts is not None else pv.ballot_ages(self.spark, self.data_dir)

    @cached_property
    def dim(self) -> DataFrame:
        return self.area_table if self.area_table is not None else area_dim(self.spark, self.data_dir)

    @cached_property
    def names(self) -> DataFrame:
        nation = self.spark.range(1).select(F.lit(C.LEVEL_NATION).alias("level"), F.lit(0).cast("long").alias("area_id"),
                                            F.lit(C.LEVEL_NATION).alias("area_name"))
        return area_names(self.dim).unionByName(nation)

    @cached_property
    def prediction(self) -> DataFrame:
        if self.prediction_table is not None:
            return self.prediction_table
        return pv.prediction(self.spark, self.data_dir)

    def level(self, lv: str) -> DataFrame:
        """One summary level, always cut from the same all-levels summary frame, so every level a
        query uses comes from one pass over ballots (Spark reuses the identical exchange)."""
        if self.summary is None:
            self.summary = summaries_eager(pv.ballot_events(self.spark, self.data_dir), pv.citizen_areas(self.spark, self.data_dir))
        return at_level(self.summary, lv)

    def levels(self, *names: str) -> DataFrame:
        """Several summary levels as one frame."""
        self.level(names[0])
        return self.summary.filter(F.col("level").isin(*names))

    def registered(self, lv: str) -> DataFrame:
        if self.registered_tables is not None:
            return self.registered_tables[lv]
        view = {C.LEVEL_L1: pv.registered_l1, C.LEVEL_L2: pv.registered_l2, C.LEVEL_NATION: pv.registered_nat}[lv]
        return view(self.spark, self.data_dir)
