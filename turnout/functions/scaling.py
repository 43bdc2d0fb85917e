"""Outlier fence and min-max scaling as SQL text over column names.

Min-max is written out because Spark ML's scaler maps a constant column to 0.5,
while the published preparation maps it to 0 (scale 1 on a zero range).
"""

from __future__ import annotations

from turnout.constants import IQR_FENCE


def zero_outliers_sql(x: str, q1: str, q3: str, k: float = IQR_FENCE) -> str:
    """strict IQR fence; values outside become 0."""
    return (f"CASE WHEN {x} < {q1} - {k} * ({q3} - {q1}) OR {x} > {q3} + {k} * ({q3} - {q1}) "
            f"THEN CAST(0 AS DOUBLE) ELSE CAST({x} AS DOUBLE) END")


def minmax_sql(x: str, lo: str, hi: str) -> str:
    """(x - lo) / (hi - lo); a zero range divides by 1."""
    return f"({x} - {lo}) / CASE WHEN {hi} = {lo} THEN CAST(1 AS DOUBLE) ELSE CAST({hi} - {lo} AS DOUBLE) END"
