"""Reshaping (U1, U4-U7, A11): unpivot, pivot, label maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.jsontext import json_object, json_value


def unpivot_measures(df: DataFrame, ids: list[str], measures: list[str], label: str, value: str,
                     labels: dict | None = None) -> DataFrame:
    """Wide -> long; ``labels`` renames measure names to display labels.

    The position of a measure in ``measures`` is kept as ``{label}_ord`` so charts keep order.
    """
    long = df.unpivot(ids, measures, label, value)
    q = lambda v: "'" + str(v).replace("'", "''") + "'"
    pos = "CASE `{0}` ".format(label) + " ".join(f"WHEN {q(m)} THEN {i + 1}" for i, m in enumerate(measures)) + " END"
    cols = [F.expr(f"cast({pos} as bigint)").alias(f"{label}_ord")]
    if labels:
        name = "CASE `{0}` ".format(label) + " ".join(f"WHEN {q(m)} THEN {q(labels.get(m, m))}" for m in measures) + " END"
        return long.select(*[c for c in long.columns if c != label], F.expr(name).alias(label), *cols)
    return long.select(*long.columns, *cols)


def columns_with_suffix(df: DataFrame, suffix: str) -> list[str]:
    """Columns by suffix pattern."""
    return [c for c in df.columns if c.endswith(suffix)]


def strip_suffix(c, suffix: str):
    """suffix removed from a label."""
    return F.regexp_replace(c, f"{suffix}$", "")


def pivot_series(df: DataFrame, keys: list[str], series: str, value: str, values: list[str]) -> DataFrame:
    """Long (key, series, value) -> one row per key, one column per series (values as double)."""
    return df.groupBy(*keys).pivot(series, values).agg(F.first(F.col(value).cast("double")))


def plots_json(rows: DataFrame, keys: list[str], x: str = "x", y: str = "y", order: str = "x_ord") -> DataFrame:
    """Per key, the ordered ``{x: y}`` map as JSON text.

    Each group is one chart (bounded by its x axis: hours, labels, top-k entries), so
    ``collect_list`` here gathers tens of points, never ballots.
    """
    pts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(x).cast("string").alias("x"), json_value(F.col(y)).alias("y"))))
    return rows.groupBy(*keys).agg(pts.alias("_p")).select(*keys, json_object(F.col("_p")).alias("plots"))
