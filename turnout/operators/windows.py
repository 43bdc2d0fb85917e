"""Window-style operators.

Every window here is partitioned by an area key and runs over per-area series whose length is
bounded by the time grid (hours, minutes of a day), not by the number of ballots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cumulative(df: DataFrame, keys: list[str], order: list, col: str, out: str) -> DataFrame:
    """Running total within each key, in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(col).over(w))


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First ``n`` rows per group under a total order (ties need a tie-break column in ``order``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_k(df: DataFrame, order: list, k: int, rank: str = "x_ord") -> DataFrame:
    """Global top ``k`` under a total order, numbered 1..k.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every partition keeps its own top k and
    only those k rows per partition meet in the final step, so no task sees the whole input.
    """
    top = df.orderBy(*order).limit(k)
    # numbering runs over the k rows left after the limit, so an unpartitioned window is bounded by k
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long"))


def last_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row per key in ``order`` (the later row wins)."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc() if isinstance(o, Column) else F.col(o).desc() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_steps(df: DataFrame, keys: list[str], order: str, n: int, step: str = "step") -> DataFrame:
    """The first ``n`` rows of each group in time order, numbered 1..n."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(step, F.row_number().over(w).cast("long")).filter(F.col(step) <= n)


def pad_steps(df: DataFrame, keys: list[str], n: int, fill_cols: list[str], step: str = "step",
              carry_cols: list[str] = ()) -> DataFrame:
    """Groups shorter than ``n`` steps get zero rows appended up to ``n``."""
    # what a group carries comes from its first step
    carried = [F.min_by(c, step).alias(c) for c in carry_cols]
    groups = df.groupBy(*keys).agg(*carried) if carried else df.select(*keys).distinct()
    grid = groups.select(*keys, *carry_cols, F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))).alias(step))
    j = grid.join(df.drop(*carry_cols), keys + [step], "left")
    return j.select(*keys, *carry_cols, step, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in fill_cols])


def supervised_windows(df: DataFrame, keys: list[str], order: str, features: list[str],
                       n_in: int = 60, n_out: int = 60) -> DataFrame:
    """Sliding input/target windows, step 1; only full windows are kept (n - n_in - n_out + 1 per group).

    Each step is one ``array`` of the features; the frames are fixed-size row ranges, so the
    memory per row is bounded by ``n_in + n_out`` steps.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    framed = df.select(
        *keys, F.col(order).alias("start"),
        F.collect_list(vec).over(w.rowsBetween(0, n_in - 1)).alias("inputs"),
        F.collect_list(vec).over(w.rowsBetween(n_in, n_in + n_out - 1)).alias("targets"),
    )
    return framed.filter((F.size("inputs") == n_in) & (F.size("targets") == n_out))


def time_split(df: DataFrame, keys: list[str], order: str, test_fraction: float = 0.1) -> DataFrame:
    """Chronological split; the last ceil(fraction * n) rows of each group are the test part."""
    w_all = Window.partitionBy(*keys)
    w = Window.partitionBy(*keys).orderBy(order)
    n = F.count(F.lit(1)).over(w_all)
    n_test = F.ceil(F.lit(test_fraction) * n)
    rn = F.row_number().over(w)
    return df.withColumn("split", F.when(rn > n - n_test, F.lit("test")).otherwise(F.lit("train")))
