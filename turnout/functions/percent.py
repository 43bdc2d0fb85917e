"""Percentages with explicit rounding and zero / missing denominator policies.

ANSI mode makes ``x / 0`` raise, so every percentage states what a zero or a
missing denominator gives instead of failing a distributed job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVEN = "even"   # half-even, like Python round / pandas .round
UP = "up"       # half-up, like SQL ROUND
NONE = None

ZERO_NULL = "null"   # the default where the published code raises
ZERO_ERROR = "error"  # the query fails and names the row (the published behaviour)
ZERO_ZERO = "zero"
ZERO_ONE = "one"

MISSING_AS_ZERO_DEN = "zero_den"   # missing denominator row behaves like a zero denominator
MISSING_PCT_ZERO = "pct_zero"      # missing row -> 0 %
MISSING_DEN_ONE = "den_one"        # missing key -> divide by 1


def round_pct(x: Column, rounding: str | None) -> Column:
    if rounding == EVEN:
        return F.rint(x).cast("long")
    if rounding == UP:
        return F.round(x, 0).cast("long")
    return x


def failing(message: str, *names: str) -> str:
    """SQL that fails the query with ``message`` and the values of the columns ``names``."""
    return f"raise_error(concat('{message}'" + "".join(f", ' {n} ', coalesce(cast({n} as string), 'null')" for n in names) + "))"


def percent_sql(num: str, den: str, rounding: str | None = EVEN, on_zero: str = ZERO_NULL,
                on_missing: str = MISSING_AS_ZERO_DEN, what: tuple[str, ...] = ()) -> str:
    """``percent`` as a Spark SQL expression (one JVM call to build)."""
    d = {MISSING_DEN_ONE: f"coalesce({den}, 1)", MISSING_AS_ZERO_DEN: f"coalesce({den}, 0)"}.get(on_missing, den)
    raw = f"try_divide({num} * 100, cast({d} as double))"
    if rounding == EVEN:
        raw = f"cast(rint({raw}) as bigint)"
    elif rounding == UP:
        raw = f"cast(round({raw}, 0) as bigint)"
    zero = failing(f"zero denominator {den}:", *what) if on_zero == ZERO_ERROR else {ZERO_NULL: "NULL", ZERO_ZERO: "0", ZERO_ONE: "1"}[on_zero]
    out = f"CASE WHEN {d} = 0 THEN {zero} ELSE {raw} END"
    if on_missing == MISSING_PCT_ZERO:
        out = f"CASE WHEN {den} IS NULL THEN 0 ELSE {out} END"
    return f"cast({out} as {'bigint' if rounding else 'double'})"


def percent(num: str, den: str, rounding: str | None = EVEN, on_zero: str = ZERO_NULL,
            on_missing: str = MISSING_AS_ZERO_DEN, what: tuple[str, ...] = ()) -> Column:
    """``num * 100 / den`` (integer product, double quotient) of two columns by name, then rounding and policies;
    ``what`` names the columns that an error of ``on_zero="error"`` shows."""
    return F.expr(percent_sql(num, den, rounding, on_zero, on_missing, what))
