"""One-hot gender and age classes (P3-P7), as SQL text over column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def male_sql(sex: str) -> str:
    return f"CAST(CASE WHEN {sex} = 1 THEN 1 ELSE 0 END AS BIGINT)"


def female_sql(sex: str, other_is_female: bool = False) -> str:
    """Live rule: SEX == 2.  History rule: anything but 1 (unknown counts as female)."""
    if other_is_female:
        return f"CAST(CASE WHEN {sex} <=> 1 THEN 0 ELSE 1 END AS BIGINT)"
    return f"CAST(CASE WHEN {sex} = 2 THEN 1 ELSE 0 END AS BIGINT)"


def in_bin_sql(age: str, lo: int, hi: int | None, closed: bool = False) -> str:
    """1 when ``age`` falls in the bin, else 0 (null age gives 0, never null)."""
    cond = f"{age} >= {lo}"
    if hi is not None:
        cond += f" AND {age} {'<=' if closed else '<'} {hi}"
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS BIGINT)"


def age_flags_sql(age: str, bins, closed: bool = False) -> list[str]:
    """Generated flag list for a named bin set, aliased by the bin names."""
    return [f"{in_bin_sql(age, lo, hi, closed)} AS {name}" for name, lo, hi in bins]


def age_flags(age: str, bins, closed: bool = False) -> list[Column]:
    return [F.expr(e) for e in age_flags_sql(age, bins, closed)]


def male_flag(sex: str) -> Column:
    return F.expr(male_sql(sex))


def female_flag(sex: str, other_is_female: bool = False) -> Column:
    return F.expr(female_sql(sex, other_is_female))
