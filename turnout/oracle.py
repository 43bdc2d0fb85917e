"""Oracle SQL (DuckDB dialect) for every registered query, written from the rule text.

The proof views of FIXTURES.md section 4 are common table expressions over the driver's tables
(region nation customer events ...), so each oracle statement is self-contained.  Spark code is
never translated here; the statements restate the rules in plain SQL.
"""

from __future__ import annotations

import hashlib
import math


class C:
    """Literal values of its own, so that a wrong constant of the engine shows."""

    LIVE_BINS = [("col_1", 20, 30), ("col_2", 31, 40), ("col_3", 41, 50), ("col_4", 51, 60), ("col_5", 61, 70), ("col_6", 71, 80), ("col_7", 81, 90)]
    HISTORY_BINS = [("col_1", 20, 30), ("col_2", 30, 40), ("col_3", 40, 50), ("col_4", 50, 60), ("col_5", 60, 70), ("col_6", 70, 80), ("col_7", 80, None)]
    SUMMARY_BINS = [("age_21_30", 21, 30), ("age_31_40", 31, 40), ("age_41_50", 41, 50), ("age_51_60", 51, 60), ("age_61_70", 61, 70), ("age_71_p", 71, None)]
    SUMMARY_LABELS = ["Age_21_30", "Age_31_40", "Age_41_50", "Age_51_60", "Age_61_70", "Age_71_P"]
    FORECAST_AGE_LABELS = ["20-30", "30-40", "40-50", "50-60", "60-70", "70+"]
    REG_YEARS = [2003, 2007, 2011, 2012, 2015, 2016, 2019, 2020, 2022, 2023]
    COUNTERS = ["male", "female", "col_1", "col_2", "col_3", "col_4", "col_5", "col_6", "col_7"]
    PREDICTION_COUNTERS = ["male", "female", "col_1", "col_2", "col_3", "col_4", "col_5", "col_6"]
    POLL_FIRST_MINUTE, POLL_LAST_MINUTE = 420, 1139
    STATS, FORECASTED = "stats", "forcasted"
    # weighted picks: list, report, weight
    PICKS = [(1, "top_ages", 0.1), (1, "region_gender_turnout", 0.2), (1, "wilayat_gender_top10", 0.2), (1, "age_turnout", 0.2),
             (1, "regyear_turnout", 0.1), (1, "region_turnout", 0.1), (1, "region_age_top2", 0.05), (1, "wilayat_age_top2", 0.05),
             (2, "gender_forecast", 0.5), (2, "age_forecast", 0.5)]


YEARS_LIST = "[" + ", ".join(str(y) for y in C.REG_YEARS) + "]"
AGE_COLS = [b[0] for b in C.SUMMARY_BINS]
MEASURES = ["total", "male", "female"] + AGE_COLS + [f"ry_{y}" for y in C.REG_YEARS]
REG_MEASURES = ["voters", "male_count", "female_count"] + AGE_COLS + [f"ry_{y}" for y in C.REG_YEARS]


def flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def closed(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" + (f" AND {col} <= {hi}" if hi is not None else "")


def half_open(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" + (f" AND {col} < {hi}" if hi is not None else "")


def pct(num: str, den: str, rnd: str | None = "E", zero: str = "null", missing: str = "zero_den") -> str:
    if missing == "den_one":
        den = f"coalesce({den}, 1)"
    elif missing == "zero_den":
        den = f"coalesce({den}, 0)"
    raw = f"(({num}) * 100 / ({den})::DOUBLE)"
    if rnd == "E":
        raw = f"round_even({raw}, 0)"
    elif rnd == "U":
        raw = f"round({raw}, 0)"
    z = {"null": "NULL", "zero": "0", "one": "1"}[zero]
    out = f"CASE WHEN ({den}) = 0 THEN {z} ELSE {raw} END"
    if missing == "pct_zero":
        out = f"CASE WHEN ({den}) IS NULL THEN 0 ELSE {out} END"
    return f"({out})::BIGINT" if rnd else f"({out})::DOUBLE"


def label12(h: str) -> str:
    return (f"printf('%02d %s', CASE WHEN ({h}) % 12 = 0 THEN 12 ELSE ({h}) % 12 END, "
            f"CASE WHEN ({h}) < 12 THEN 'AM' ELSE 'PM' END)")


def ampm_ord(label: str, legacy: bool = False) -> str:
    n = f"TRY_CAST(split_part({label}, ' ', 1) AS BIGINT)"
    if legacy:
        return (f"(CASE WHEN strpos({label}, ' AM') > 0 THEN {n} WHEN strpos({label}, ' PM') > 0 THEN {n} + 12 "
                f"ELSE 0 END)::BIGINT")
    return (f"(CASE WHEN strpos({label}, ' AM') > 0 THEN {n} % 12 WHEN strpos({label}, ' PM') > 0 THEN {n} % 12 + 12 "
            f"ELSE 0 END)::BIGINT")


def sums(cols, prefix: str = "") -> str:
    return ", ".join(f"sum({prefix}{c})::BIGINT AS {c}" for c in cols)


# ---- proof views -------------------------------------------------------------------------------

V: dict[str, tuple[str, list[str]]] = {}


def view(name: str, body: str, deps: list[str] = ()) -> None:
    V[name] = (body, list(deps))


view("ballots", f"""
  SELECT e.event_id::BIGINT AS event_id, e.ts AS ts, e.user_id::BIGINT AS citizen_id,
         (CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE 18 + e.event_id % 80 END)::BIGINT AS age,
         (CASE WHEN e.event_id % 53 = 0 THEN NULL WHEN e.event_id % 50 = 0 THEN 0
               ELSE 1 + (e.event_id // 7) % 2 END)::BIGINT AS sex,
         ({YEARS_LIST})[e.event_id % 10 + 1]::BIGINT AS reg_year,
         (epoch_us(e.ts) // 1000)::BIGINT AS log_ms,
         n.n_regionkey::BIGINT AS area_l1, n.n_nationkey::BIGINT AS area_l2
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")

view("bm", "SELECT area_l1, area_l2, ((log_ms // 3600000) % 24)::BIGINT AS hour, 1 AS total, "
     + f"{flag('sex = 1')} AS male, {flag('sex = 2')} AS female, "
     + ", ".join(f"{flag(closed('age', lo, hi))} AS {n}" for n, lo, hi in C.SUMMARY_BINS) + ", "
     + ", ".join(f"{flag(f'reg_year = {y}')} AS ry_{y}" for y in C.REG_YEARS)
     + " FROM ballots", ["ballots"])

view("reg_l2_full", "SELECT c_nationkey::BIGINT AS area_id, 20 * count(*) AS voters, "
     "20 * count(*) FILTER (WHERE c_custkey % 2 = 0) AS male_count, "
     "20 * count(*) FILTER (WHERE c_custkey % 2 = 1) AS female_count, "
     + ", ".join(f"20 * count(*) FILTER (WHERE {closed('(18 + c_custkey % 80)', lo, hi)}) AS {n}"
                 for n, lo, hi in C.SUMMARY_BINS) + ", "
     + ", ".join(f"20 * count(*) FILTER (WHERE c_custkey % 10 = {i}) AS ry_{y}" for i, y in enumerate(C.REG_YEARS))
     + " FROM customer GROUP BY c_nationkey")
view("reg_l2", "SELECT * REPLACE (CASE WHEN area_id = 3 THEN 0 ELSE female_count END AS female_count) "
     "FROM reg_l2_full WHERE area_id <> 24", ["reg_l2_full"])
view("reg_l1", "SELECT n.n_regionkey::BIGINT AS area_id, " + sums(REG_MEASURES, "r.")
     + " FROM reg_l2_full r JOIN nation n ON r.area_id = n.n_nationkey GROUP BY n.n_regionkey", ["reg_l2_full"])
view("reg_nat", "SELECT 0::BIGINT AS area_id, " + sums(REG_MEASURES) + " FROM reg_l2_full", ["reg_l2_full"])
view("reg_ages", "SELECT (18 + c_custkey % 80)::BIGINT AS age, (20 * count(*))::BIGINT AS n FROM customer GROUP BY 1")
view("names", "SELECT 'l1' AS level, r_regionkey::BIGINT AS area_id, trim(r_name) AS area_name FROM region "
     "WHERE r_regionkey IN (SELECT n_regionkey FROM nation) "
     "UNION ALL SELECT 'l2', n_nationkey::BIGINT, trim(n_name) FROM nation "
     "UNION ALL SELECT 'nation', 0::BIGINT, 'nation'")
view("prediction", "SELECT area_l1, area_l2, "
     "TIMESTAMP '2024-01-31 00:00:00' + to_days(CASE WHEN area_l2 % 3 = 0 THEN 1 ELSE 0 END) + to_hours((8 + area_l2 % 4)::BIGINT) AS time_slot, "
     f"(2 * sum({flag('sex = 1')}))::BIGINT AS male, (2 * sum({flag('sex = 2')}))::BIGINT AS female, "
     + ", ".join(f"(2 * sum({flag(half_open('age', lo, hi))}))::BIGINT AS {n}"
                 for n, lo, hi in [("col_1", 20, 30), ("col_2", 30, 40), ("col_3", 40, 50), ("col_4", 50, 60),
                                   ("col_5", 60, 70), ("col_6", 70, None)])
     + " FROM ballots WHERE area_l2 <> 13 GROUP BY area_l1, area_l2", ["ballots"])

LEVEL_SQL = {
    "nation": ("0::BIGINT AS area_id", ""),
    "l1": ("area_l1 AS area_id", "GROUP BY area_l1"),
    "l2": ("area_l2 AS area_id", "GROUP BY area_l1, area_l2"),
    "hour": ("0::BIGINT AS area_id, hour", "GROUP BY hour"),
    "l1_hour": ("area_l1 AS area_id, hour", "GROUP BY area_l1, hour"),
    "l2_hour": ("area_l2 AS area_id, hour", "GROUP BY area_l1, area_l2, hour"),
}
for _lv, (_sel, _grp) in LEVEL_SQL.items():
    view(f"s_{_lv}", f"SELECT {_sel}, {sums(MEASURES)} FROM bm {_grp}", ["bm"])


def with_views(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in V[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({V[n][0]})" for n in order) + "\n" + body


def finish(body: str) -> str:
    """Attach area names like the Spark reports do (unknown id -> its text)."""
    return ("SELECT q.level, q.area_id, coalesce(nm.area_name, q.area_id::VARCHAR) AS area_name, "
            "q.series::VARCHAR AS series, q.x::VARCHAR AS x, q.x_ord::BIGINT AS x_ord, q.y AS y FROM (" + body
            + ") q LEFT JOIN names nm ON nm.level = q.level AND nm.area_id = q.area_id")


def rows_of(src: str, keys: str, pairs: list[tuple[str, str]], series: str = C.STATS) -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{series}' AS series, '{lbl}' AS x, {i + 1} AS x_ord, {val} AS y FROM {src}"
                              for i, (lbl, val) in enumerate(pairs))


NAT = "'nation' AS level, 0::BIGINT AS area_id"


# ---- reports ---------------------------------------------------------------------------------

def _r1() -> str:
    body = (f"SELECT {NAT}, 'forcasted' AS series, hour::VARCHAR AS x, hour AS x_ord, "
            f"coalesce({pct('l.total', 'r.voters')}, 0) AS y "
            "FROM (SELECT time_slot, sum(male + female)::BIGINT AS total, hour(time_slot)::BIGINT AS hour "
            "      FROM prediction GROUP BY time_slot "
            "      QUALIFY row_number() OVER (PARTITION BY hour(time_slot) ORDER BY time_slot DESC) = 1) l, reg_nat r")
    return finish(body)


TSUM = ("SELECT hour, " + label12("hour") + " AS v_time, "
        + pct("c.cum", "r.voters", None) + " AS percentage FROM "
        "(SELECT hour, (sum(total) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS cum "
        " FROM s_hour) c, reg_nat r")


def _r2_body(legacy: bool = True) -> str:
    return (f"SELECT {NAT}, 'stats' AS series, v_time AS x, {ampm_ord('v_time', legacy)} AS x_ord, "
            f"round_even(percentage, 0)::BIGINT AS y FROM ({TSUM}) t")


def _r3() -> str:
    fc = (f"SELECT {NAT}, {label12('hour')} AS x, coalesce({pct('l.total', 'r.voters')}, 0) AS y, hour AS fo "
          "FROM (SELECT time_slot, sum(male + female)::BIGINT AS total, hour(time_slot)::BIGINT AS hour "
          "      FROM prediction GROUP BY time_slot "
          "      QUALIFY row_number() OVER (PARTITION BY hour(time_slot) ORDER BY time_slot DESC) = 1) l, reg_nat r "
          "QUALIFY row_number() OVER (ORDER BY hour DESC) = 1")
    return finish(overlay(_r2_body(), fc))


def overlay(stats: str, fc_last: str) -> str:
    return ("SELECT coalesce(f.level, s.level) AS level, coalesce(f.area_id, s.area_id) AS area_id, "
            "CASE WHEN f.y IS NOT NULL THEN 'forcasted' ELSE 'stats' END AS series, coalesce(f.x, s.x) AS x, "
            + ampm_ord("coalesce(f.x, s.x)") + " AS x_ord, coalesce(f.y, s.y) AS y "
            f"FROM ({stats}) s FULL JOIN ({fc_last}) f ON s.level = f.level AND s.area_id = f.area_id AND s.x = f.x")


def _r4() -> str:
    return finish(rows_of("s_nation s, reg_nat r", NAT, [("M", pct("s.male", "r.male_count")),
                                                         ("F", pct("s.female", "r.female_count"))]))


def _r5() -> str:
    body = (f"SELECT {NAT}, 'stats' AS series, 'Age_' || age::VARCHAR AS x, "
            "row_number() OVER (ORDER BY percentage DESC, age) AS x_ord, percentage AS y FROM ("
            f"SELECT l.age, {pct('l.n', 'a.n', None)} AS percentage FROM "
            "(SELECT age, count(*) AS n FROM ballots WHERE age IS NOT NULL GROUP BY age) l "
            "LEFT JOIN reg_ages a ON a.age = l.age) t WHERE percentage IS NOT NULL "
            "QUALIFY row_number() OVER (ORDER BY percentage DESC, age) <= 10")
    return finish(body)


PRED_NAT = "(SELECT " + sums(C.PREDICTION_COUNTERS) + " FROM prediction)"


def _r6() -> str:
    return finish(rows_of(f"{PRED_NAT} p, reg_nat r", NAT, [("Male", pct("p.male", "r.male_count")),
                                                             ("Female", pct("p.female", "r.female_count"))],
                          C.FORECASTED))


FOLD = ("(SELECT " + ", ".join(
    f"sum(n) FILTER (WHERE {closed('age', lo, hi)})::BIGINT AS d{i}"
    for i, (_, lo, hi) in enumerate(C.SUMMARY_BINS)) + " FROM reg_ages)")


def _r7() -> str:
    pairs = [(lbl, pct(f"p.col_{i + 1}", f"coalesce(f.d{i}, 0)", "E", "zero")) for i, lbl in enumerate(C.FORECAST_AGE_LABELS)]
    return finish(rows_of(f"{PRED_NAT} p, {FOLD} f", NAT, pairs, C.FORECASTED))


def area_axis(inner: str, level: str) -> str:
    """inner has area_id, series, y -> nation chart with x = area name, x_ord = area id."""
    return (f"SELECT {NAT}, i.series, coalesce(nm.area_name, i.area_id::VARCHAR) AS x, i.area_id AS x_ord, i.y "
            f"FROM ({inner}) i LEFT JOIN names nm ON nm.level = '{level}' AND nm.area_id = i.area_id")


def _r8() -> str:
    inner = " UNION ALL ".join(
        f"SELECT s.area_id, '{lbl}' AS series, {pct('s.' + n, 'r.' + d, 'E', 'null', 'pct_zero')} AS y "
        "FROM s_l1 s LEFT JOIN reg_l1 r ON r.area_id = s.area_id"
        for lbl, n, d in [("MalePercentage", "male", "male_count"), ("FemalePercentage", "female", "female_count")])
    return finish(area_axis(inner, "l1"))


def _r9() -> str:
    top = "(SELECT * FROM s_l2 ORDER BY male + female DESC, area_id LIMIT 10)"
    inner = " UNION ALL ".join(
        f"SELECT s.area_id, '{lbl}' AS series, {pct('s.' + n, 'r.' + d, 'E', 'null', 'pct_zero')} AS y "
        f"FROM {top} s LEFT JOIN reg_l2 r ON r.area_id = s.area_id"
        for lbl, n, d in [("M", "male", "male_count"), ("F", "female", "female_count")])
    return finish(area_axis(inner, "l2"))


def _r10() -> str:
    pairs = [(lbl, pct("s." + c, "r." + c)) for lbl, c in zip(C.SUMMARY_LABELS, AGE_COLS)]
    return finish(rows_of("s_nation s, reg_nat r", NAT, pairs))


def _r11() -> str:
    pairs = [(f"RY_{y}", pct(f"s.ry_{y}", f"r.ry_{y}", "U")) for y in C.REG_YEARS]
    return finish(rows_of("s_nation s, reg_nat r", NAT, pairs))


def _r12() -> str:
    inner = (f"SELECT s.area_id, 'stats' AS series, {pct('s.total', 'r.voters')} AS y "
             "FROM s_l1 s LEFT JOIN reg_l1 r ON r.area_id = s.area_id")
    return finish(area_axis(inner, "l1"))


def age_pct_long(level: str) -> str:
    return " UNION ALL ".join(
        f"SELECT s.area_id, '{lbl}' AS label, {i + 1} AS label_ord, {pct('s.' + c, 'r.' + c, 'E', 'one')} AS pct "
        f"FROM s_{level} s LEFT JOIN reg_{level} r ON r.area_id = s.area_id"
        for i, (lbl, c) in enumerate(zip(C.SUMMARY_LABELS, AGE_COLS)))


def _age_top2(level: str) -> str:
    long = ("SELECT a.*, coalesce(nm.area_name, a.area_id::VARCHAR) AS area_name FROM (" + age_pct_long(level)
            + f") a LEFT JOIN names nm ON nm.level = '{level}' AND nm.area_id = a.area_id")
    top = (f"SELECT area_id FROM (SELECT area_id, area_name, avg(pct) AS m FROM ({long}) GROUP BY area_id, area_name) "
           "ORDER BY m DESC, area_name LIMIT 10")
    inner = (f"SELECT area_id, label AS series, pct AS y FROM ({long}) WHERE area_id IN ({top}) "
             "QUALIFY row_number() OVER (PARTITION BY area_id ORDER BY pct DESC, label_ord) <= 2")
    return finish(area_axis(inner, level))


def hourly_cum(level: str) -> str:
    return (f"SELECT '{level}' AS level, c.area_id, 'stats' AS series, c.hour::VARCHAR AS x, c.hour AS x_ord, "
            f"{pct('c.cum', 'r.voters')} AS y FROM "
            "(SELECT area_id, hour, (sum(total) OVER (PARTITION BY area_id ORDER BY hour "
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS cum FROM s_{level}_hour) c "
            f"JOIN reg_{level} r ON r.area_id = c.area_id")


def _r15() -> str:
    return finish(hourly_cum("l1") + " UNION ALL " + hourly_cum("l2"))


def _r16() -> str:
    parts = []
    for lv in ("l1", "l2"):
        src = f"s_{lv} s JOIN reg_{lv} r ON r.area_id = s.area_id"
        parts.append(rows_of(src, f"'{lv}' AS level, s.area_id", [
            ("M", pct("s.male", "r.male_count", "E", "zero")), ("F", pct("s.female", "r.female_count", "E", "zero"))]))
    return finish(" UNION ALL ".join(parts))


def pred_area(level: str) -> str:
    col = "area_l1" if level == "l1" else "area_l2"
    return f"(SELECT {col}::BIGINT AS area_id, * EXCLUDE (area_l1, area_l2) FROM prediction)"


def fc_cum(level: str) -> str:
    return (f"SELECT '{level}' AS level, c.area_id, 'forcasted' AS series, c.hour::VARCHAR AS x, c.hour AS x_ord, "
            f"coalesce({pct('c.cum', 'r.voters', 'E', 'zero')}, 0) AS y FROM "
            "(SELECT area_id, time_slot, hour, (sum(total) OVER (PARTITION BY area_id ORDER BY hour, time_slot "
            "  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS cum FROM "
            "  (SELECT area_id, time_slot, hour(time_slot)::BIGINT AS hour, sum(male + female)::BIGINT AS total "
            f"   FROM {pred_area(level)} GROUP BY area_id, time_slot) "
            " QUALIFY row_number() OVER (PARTITION BY area_id, hour ORDER BY time_slot DESC) = 1) c "
            f"JOIN reg_{level} r ON r.area_id = c.area_id")


def _r17() -> str:
    return finish(fc_cum("l1") + " UNION ALL " + fc_cum("l2"))


def _r18() -> str:
    stats = " UNION ALL ".join(f"SELECT level, area_id, {label12('x_ord')} AS x, y FROM ({hourly_cum(lv)})"
                               for lv in ("l1", "l2"))
    fc = " UNION ALL ".join(f"SELECT level, area_id, {label12('x_ord')} AS x, y, x_ord AS fo FROM ({fc_cum(lv)})"
                            for lv in ("l1", "l2"))
    fc_last = f"SELECT * FROM ({fc}) QUALIFY row_number() OVER (PARTITION BY level, area_id ORDER BY fo DESC) = 1"
    return finish(overlay(stats, fc_last))


def _r19() -> str:
    parts = []
    for lv in ("l1", "l2"):
        src = (f"(SELECT area_id, sum(male)::BIGINT AS male, sum(female)::BIGINT AS female FROM {pred_area(lv)} "
               f"GROUP BY area_id) p JOIN reg_{lv} r ON r.area_id = p.area_id")
        parts.append(rows_of(src, f"'{lv}' AS level, p.area_id", [
            ("Male", pct("p.male", "r.male_count", "U")), ("Female", pct("p.female", "r.female_count", "U"))],
            C.FORECASTED))
    return finish(" UNION ALL ".join(parts))


def _r20() -> str:
    parts = []
    for lv in ("l1", "l2"):
        src = f"s_{lv} s LEFT JOIN reg_{lv} r ON r.area_id = s.area_id"
        pairs = [(lbl, f"({pct('s.' + c, 'r.' + c, 'E', 'null', 'den_one')})::DOUBLE")
                 for lbl, c in zip(C.SUMMARY_LABELS, AGE_COLS)]
        parts.append(rows_of(src, f"'{lv}' AS level, s.area_id", pairs))
    return finish(" UNION ALL ".join(parts))


ALL_VIEWS = ["ballots", "bm", "reg_l2_full", "reg_l2", "reg_l1", "reg_nat", "reg_ages", "names", "prediction"] + [
    f"s_{lv}" for lv in LEVEL_SQL]


def report_sql() -> dict[str, str]:
    raw = {
        "forecast_by_hour": _r1(),
        "hour_summary": finish(_r2_body()),
        "turnout_with_forecast": _r3(),
        "gender_turnout": _r4(),
        "top_ages": _r5(),
        "gender_forecast": _r6(),
        "age_forecast": _r7(),
        "region_gender_turnout": _r8(),
        "wilayat_gender_top10": _r9(),
        "age_turnout": _r10(),
        "regyear_turnout": _r11(),
        "region_turnout": _r12(),
        "region_age_top2": _age_top2("l1"),
        "wilayat_age_top2": _age_top2("l2"),
        "area_cumulative_turnout": _r15(),
        "area_gender_turnout": _r16(),
        "area_forecast_cumulative": _r17(),
        "area_turnout_with_forecast": _r18(),
        "area_gender_forecast": _r19(),
        "area_age_turnout": _r20(),
    }
    return {k: with_views(v, *ALL_VIEWS) for k, v in raw.items()}




# ---- live path and operator checks ------------------------------------------------------------

SOD = "((log_ms // 1000) % 86400)"
TOD = f"printf('%02d:%02d:%02d', {SOD} // 3600, ({SOD} // 60) % 60, {SOD} % 60)"
MIN_CARRY = f"least({SOD} // 60 + CASE WHEN {SOD} % 60 >= 30 THEN 1 ELSE 0 END, 1439)"
MINUTE = f"printf('%02d:%02d', {MIN_CARRY} // 60, {MIN_CARRY} % 60)"
MINUTE_NOCARRY = f"printf('%02d:%02d', {SOD} // 3600, ({SOD} // 60) % 60 + CASE WHEN {SOD} % 60 >= 30 THEN 1 ELSE 0 END)"
MINUTE_CUT = f"printf('%02d:%02d', {SOD} // 3600, ({SOD} // 60) % 60)"
LIVE_FLAGS = ", ".join(f"{flag(half_open('age', lo, hi))}::BIGINT AS {n}" for n, lo, hi in C.LIVE_BINS)
HIST_FLAGS = ", ".join(f"{flag(half_open('age', lo, hi))}::BIGINT AS {n}" for n, lo, hi in C.HISTORY_BINS)
SUMM_FLAGS = ", ".join(f"{flag(closed('age', lo, hi))}::BIGINT AS {n}" for n, lo, hi in C.SUMMARY_BINS)
MALE = f"{flag('sex = 1')}::BIGINT"
FEMALE = f"{flag('sex = 2')}::BIGINT"
FEMALE_H = f"{flag('sex IS DISTINCT FROM 1')}::BIGINT"
OP = ("CASE WHEN event_id % 103 = 0 OR event_id % 101 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'u' "
      "WHEN event_id % 97 = 0 THEN 'd' ELSE 'c' END")
BALLOT_FIELDS = ["citizen_id", "age", "sex", "reg_year", "log_ms", "area_l1", "area_l2"]
FEATURES = f"SELECT {TOD} AS time_of_day, {MINUTE} AS minute, area_l1, area_l2, {MALE} AS male, {FEMALE} AS female, {LIVE_FLAGS} FROM ballots"


def rollup_sql() -> str:
    spec = {
        "nation": ("0::BIGINT", "NULL", "NULL", "NULL", ""),
        "l1": ("area_l1", "area_l1", "NULL", "NULL", "GROUP BY area_l1"),
        "l2": ("area_l2", "area_l1", "area_l2", "NULL", "GROUP BY area_l1, area_l2"),
        "hour": ("0::BIGINT", "NULL", "NULL", "hour", "GROUP BY hour"),
        "l1_hour": ("area_l1", "area_l1", "NULL", "hour", "GROUP BY area_l1, hour"),
        "l2_hour": ("area_l2", "area_l1", "area_l2", "hour", "GROUP BY area_l1, area_l2, hour"),
    }
    return " UNION ALL ".join(
        f"SELECT '{lv}' AS level, {a}::BIGINT AS area_id, {l1}::BIGINT AS area_l1, {l2}::BIGINT AS area_l2, "
        f"{h}::BIGINT AS hour, {sums(MEASURES)} FROM bm {g}" for lv, (a, l1, l2, h, g) in spec.items())


def live_sql() -> dict[str, str]:
    return {k: with_views(v, *ALL_VIEWS) for k, v in live_sql_raw().items()}


def live_sql_raw() -> dict[str, str]:
    d = {
        "cdc_range_read": "SELECT 'server1.votes.dbo.ballots' AS topic, 0 AS partition, event_id AS offset, "
                          "(CASE WHEN event_id % 103 = 0 THEN 0 ELSE 1 END)::BIGINT AS has_value FROM ballots, "
                          "(SELECT max(event_id) + 1 AS n FROM ballots) WHERE event_id >= n // 4 AND event_id < n - n // 4",
        "cdc_decode": f"SELECT event_id AS offset, op, " + ", ".join(
            f"CASE WHEN op IN ('c', 'u') THEN {c} END AS {c}" for c in BALLOT_FIELDS)
            + f" FROM (SELECT *, {OP} AS op FROM ballots)",
        "ballot_features": FEATURES,
        "minute_counts": "SELECT area_l1, area_l2, minute, " + sums(C.COUNTERS) + f" FROM ({FEATURES}) "
                         "GROUP BY area_l1, area_l2, minute",
        "gender_flags": f"SELECT event_id, sex, {MALE} AS male, {FEMALE} AS female FROM ballots",
        "gender_flags_history": f"SELECT event_id, sex, {MALE} AS male, {FEMALE_H} AS female FROM ballots",
        "age_flags_live": f"SELECT event_id, age, {LIVE_FLAGS} FROM ballots",
        "age_flags_history": f"SELECT event_id, age, {HIST_FLAGS} FROM ballots",
        "age_summary_bins": f"SELECT event_id, age, {SUMM_FLAGS} FROM ballots",
        "drop_incomplete": "SELECT event_id, age, sex FROM ballots WHERE age IS NOT NULL AND sex IS NOT NULL",
        "minute_round": f"SELECT event_id, log_ms, {MINUTE} AS minute FROM ballots",
        "minute_round_nocarry": f"SELECT event_id, log_ms, {MINUTE_NOCARRY} AS minute FROM ballots",
        "time_of_day": f"SELECT event_id, {TOD} AS time_of_day FROM ballots",
        "minute_truncate": f"SELECT event_id, {MINUTE_CUT} AS minute FROM ballots",
        "polling_hours_filter": f"SELECT * FROM (SELECT event_id, {MINUTE_CUT} AS minute FROM ballots) "
                                "WHERE minute BETWEEN '07:00' AND '18:59'",
        "area_filter": "SELECT event_id, area_l2 FROM ballots WHERE area_l2 IN (SELECT area_id FROM reg_l2)",
        "area_rollup": rollup_sql(),
        "summary_scan": "SELECT area_id, total, male, female FROM s_l2 WHERE total > 0",
        "summary_area_scan": f"SELECT s.area_id, s.total, r.voters, {pct('s.total', 'r.voters')} AS pct, p.predicted FROM s_l2 s "
                             "LEFT JOIN reg_l2 r ON r.area_id = s.area_id LEFT JOIN (SELECT area_l2, sum(male + female)::BIGINT AS predicted "
                             "FROM prediction GROUP BY area_l2) p ON p.area_l2 = s.area_id",
        "registered_dim": "SELECT * FROM reg_l2",
        "registered_dim_nation": "SELECT * FROM reg_nat",
        "registered_dim_region": "SELECT * FROM reg_l1",
        "registered_dim_wilayat": "SELECT * FROM reg_l2",
        "area_dim": "SELECT n.n_regionkey::BIGINT AS area_l1, trim(r.r_name) AS l1_name, n.n_nationkey::BIGINT AS area_l2, "
                    "trim(n.n_name) AS l2_name FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey",
        "area_names": "SELECT i.level, i.area_id, coalesce(nm.area_name, i.area_id::VARCHAR) AS area_name FROM "
                      "(SELECT DISTINCT 'l1' AS level, area_l1 AS area_id FROM ballots UNION "
                      " SELECT DISTINCT 'l2', area_l2 FROM ballots) i "
                      "LEFT JOIN names nm ON nm.level = i.level AND nm.area_id = i.area_id",
        "hour_12h": f"SELECT hour, {label12('hour')} AS label FROM (SELECT DISTINCT ((log_ms // 3600000) % 24)::BIGINT AS hour FROM ballots)",
        "coerce_bad_values": "SELECT event_id, CASE WHEN event_id % 59 = 0 THEN NULL "
                             "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts, age FROM ballots",
        "pct_half_even": f"SELECT s.area_id, {pct('s.male', 'r.male_count', 'E')} AS pct FROM s_l2 s "
                         "LEFT JOIN reg_l2_full r ON r.area_id = s.area_id",
        "pct_half_up": f"SELECT s.area_id, {pct('s.male', 'r.male_count', 'U')} AS pct FROM s_l2 s "
                       "LEFT JOIN reg_l2_full r ON r.area_id = s.area_id",
        "zero_denominator_policy": "SELECT s.area_id, "
            f"{pct('s.female', 'r.female_count', 'E', 'null')} AS p_error, "
            f"{pct('s.female', 'r.female_count', 'E', 'zero')} AS p_zero, "
            f"{pct('s.female', 'r.female_count', 'E', 'one')} AS p_one, "
            f"{pct('s.female', 'r.female_count', 'E', 'null', 'pct_zero')} AS p_missing_zero, "
            f"{pct('s.female', 'r.female_count', 'E', 'null', 'den_one')} AS p_missing_one "
            "FROM s_l2 s LEFT JOIN reg_l2 r ON r.area_id = s.area_id",
        "national_turnout": f"SELECT s.total, r.voters, {pct('s.total', 'r.voters')} AS pct FROM s_nation s, reg_nat r",
        "region_age_turnout": "SELECT area_id, label, label_ord::BIGINT AS label_ord, pct FROM (" + age_pct_long("l1") + ")",
        "area_lookup_strict": "SELECT s.area_id, s.total, r.voters FROM s_l2 s JOIN reg_l2 r ON r.area_id = s.area_id",
        "forecast_by_slot": " UNION ALL ".join(
            f"SELECT '{lv}' AS level, {a}::BIGINT AS area_id, strftime(time_slot, '%Y-%m-%d %H:%M:%S') AS time_slot, "
            f"sum(male + female)::BIGINT AS total FROM prediction GROUP BY {g}time_slot"
            for lv, a, g in [("nation", "0", ""), ("l1", "area_l1", "area_l1, "), ("l2", "area_l2", "area_l2, ")]),
        "next_hour_slot": "SELECT area_l2, strftime(date_trunc('hour', max(ts) + INTERVAL 1 HOUR), '%Y-%m-%d %H:%M:%S') "
                          "AS slot FROM ballots GROUP BY area_l2",
        "area_hourly": "SELECT 'l1_hour' AS level, area_id, hour, total FROM s_l1_hour UNION ALL "
                       "SELECT 'l2_hour', area_id, hour, total FROM s_l2_hour",
        "age_unpivot": " UNION ALL ".join(f"SELECT area_id, '{lbl}' AS label, {c} AS n, {i + 1}::BIGINT AS label_ord FROM s_l1"
                                          for i, (lbl, c) in enumerate(zip(C.SUMMARY_LABELS, AGE_COLS))),
        "gender_pivot": "SELECT x AS area_name, max(y) FILTER (WHERE series = 'MalePercentage')::DOUBLE AS MalePercentage, "
                        "max(y) FILTER (WHERE series = 'FemalePercentage')::DOUBLE AS FemalePercentage "
                        f"FROM ({_r8()}) GROUP BY x",
        "ampm_order": f"SELECT v_time AS label, {ampm_ord('v_time', True)} AS legacy_ord, {ampm_ord('v_time')} AS hour_ord "
                      f"FROM ({TSUM})",
        "registered_age_fold": " UNION ALL ".join(
            f"SELECT '{lbl}' AS label, {i + 1}::BIGINT AS label_ord, coalesce(f.d{i}, 0)::BIGINT AS n FROM {FOLD} f"
            for i, lbl in enumerate(C.FORECAST_AGE_LABELS)),
    }
    return d


# ---- history, forecast, prediction table ------------------------------------------------------

COUNTERS = C.COUNTERS
view("hist", f"SELECT (day(ts) % 3)::BIGINT AS dataset, area_l1, area_l2, ({SOD} // 60)::BIGINT AS minute, "
     f"{MALE} AS male, {FEMALE_H} AS female, {HIST_FLAGS} FROM ballots "
     f"WHERE {MINUTE_CUT} BETWEEN '07:00' AND '18:59'", ["ballots"])


def dense_sql(area: str, split: bool, src: str = "hist") -> str:
    ds = "dataset" if split else "0::BIGINT"
    series = (f"SELECT {ds} AS dataset, {area} AS area_id, minute, {sums(COUNTERS)} FROM {src} "
              f"GROUP BY {'dataset, ' if split else ''}{area}, minute")
    return (f"SELECT k.dataset, k.area_id, g.minute, "
            + ", ".join(f"coalesce(s.{c}, 0)::BIGINT AS {c}" for c in COUNTERS)
            + f" FROM (SELECT DISTINCT dataset, area_id FROM ({series})) k "
            f"CROSS JOIN (SELECT range::BIGINT AS minute FROM range({C.POLL_FIRST_MINUTE}, {C.POLL_LAST_MINUTE + 1})) g "
            f"LEFT JOIN ({series}) s ON s.dataset = k.dataset AND s.area_id = k.area_id AND s.minute = g.minute")


view("dense_l1", dense_sql("area_l1", False), ["hist"])
view("dense_l2", dense_sql("area_l2", True), ["hist"])
view("iqr_l1", "SELECT dataset, area_id, " + ", ".join(
    f"quantile_cont({c}::DOUBLE, 0.25) AS q1_{c}, quantile_cont({c}::DOUBLE, 0.75) AS q3_{c}" for c in COUNTERS)
    + " FROM dense_l1 GROUP BY dataset, area_id", ["dense_l1"])
view("zeroed_l1", "SELECT d.dataset, d.area_id, d.minute, " + ", ".join(
    f"CASE WHEN d.{c} < q.q1_{c} - 1.5 * (q.q3_{c} - q.q1_{c}) OR d.{c} > q.q3_{c} + 1.5 * (q.q3_{c} - q.q1_{c}) "
    f"THEN 0.0 ELSE d.{c}::DOUBLE END AS {c}" for c in COUNTERS)
    + " FROM dense_l1 d JOIN iqr_l1 q ON q.dataset = d.dataset AND q.area_id = d.area_id", ["iqr_l1"])


def fit_sql(src: str) -> str:
    return (f"SELECT area_id, " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in COUNTERS)
            + f" FROM {src} z WHERE dataset = (SELECT min(dataset) FROM {src} z2 WHERE z2.area_id = z.area_id) "
            "GROUP BY area_id")


def scale_sql(src: str, params: str) -> str:
    return ("SELECT z.dataset, z.area_id, z.minute, " + ", ".join(
        f"(z.{c} - p.lo_{c}) / (CASE WHEN p.hi_{c} = p.lo_{c} THEN 1.0 ELSE (p.hi_{c} - p.lo_{c})::DOUBLE END) AS {c}"
        for c in COUNTERS) + f" FROM {src} z JOIN ({params}) p ON p.area_id = z.area_id")


view("fit_l1", fit_sql("zeroed_l1"), ["zeroed_l1"])
view("scaled_l1", scale_sql("zeroed_l1", "SELECT * FROM fit_l1"), ["fit_l1"])
VEC = "[" + ", ".join(COUNTERS) + "]"
view("windows_l1", f"SELECT dataset, area_id, minute AS start, list({VEC}) OVER w_in AS inputs, "
     f"list({VEC}) OVER w_out AS targets FROM scaled_l1 "
     "WINDOW w_in AS (PARTITION BY dataset, area_id ORDER BY minute ROWS BETWEEN CURRENT ROW AND 59 FOLLOWING), "
     "w_out AS (PARTITION BY dataset, area_id ORDER BY minute ROWS BETWEEN 60 FOLLOWING AND 119 FOLLOWING) "
     "QUALIFY len(inputs) = 60 AND len(targets) = 60", ["scaled_l1"])
view("split_l1", "SELECT dataset, area_id, start, CASE WHEN row_number() OVER (PARTITION BY dataset, area_id ORDER BY start) "
     "> count(*) OVER (PARTITION BY dataset, area_id) - ceil(0.1 * count(*) OVER (PARTITION BY dataset, area_id)) "
     "THEN 'test' ELSE 'train' END AS split FROM windows_l1", ["windows_l1"])

view("mc", "SELECT area_l1, area_l2, minute, " + sums(COUNTERS) + f" FROM ({FEATURES}) "
     "WHERE area_l2 <> 5 OR minute < '00:20' GROUP BY area_l1, area_l2, minute", ["ballots"])
view("first60", "SELECT *, row_number() OVER (PARTITION BY area_l2 ORDER BY minute)::BIGINT AS step FROM mc "
     "QUALIFY step <= 60", ["mc"])
view("steps60", "SELECT k.area_l1, k.area_l2, g.step, " + ", ".join(f"coalesce(f.{c}, 0)::BIGINT AS {c}" for c in COUNTERS)
     + " FROM (SELECT DISTINCT area_l1, area_l2 FROM first60) k CROSS JOIN (SELECT range::BIGINT AS step FROM range(1, 61)) g "
     "LEFT JOIN first60 f ON f.area_l2 = k.area_l2 AND f.step = g.step", ["first60"])


def trend_sql(steps: str, bounds: str | None = None) -> str:
    """Forecast of a 60-step view by its trend, scaled by each group's own bounds, or by (area_l2, feature, lo, hi) of ``bounds``."""
    flat = f"(UNPIVOT {steps} ON " + ", ".join(COUNTERS) + " INTO NAME feature VALUE x)"
    own = f"(SELECT area_l2, feature, min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM {flat} GROUP BY area_l2, feature)"
    s = own if bounds is None else (f"(SELECT o.area_l2, o.feature, coalesce(b.lo, o.lo) AS lo, coalesce(b.hi, o.hi) AS hi FROM {own} o "
                                    f"LEFT JOIN ({bounds}) b ON b.area_l2 = o.area_l2 AND b.feature = o.feature)")
    return ("SELECT area_l1, area_l2, " + ", ".join(f"max(v) FILTER (WHERE feature = '{c}') AS {c}" for c in COUNTERS)
            + " FROM (SELECT area_l1, area_l2, feature, "
            "trunc(round((60 * regr_intercept(y, step) + 5430 * regr_slope(y, step)) * any_value(span) + any_value(lo), 6))::BIGINT AS v "
            "FROM (SELECT l.*, s.lo, CASE WHEN s.hi = s.lo THEN 1.0 ELSE (s.hi - s.lo)::DOUBLE END AS span, "
            "      (l.x - s.lo) / (CASE WHEN s.hi = s.lo THEN 1.0 ELSE (s.hi - s.lo)::DOUBLE END) AS y "
            f"      FROM {flat} l JOIN {s} s ON s.area_l2 = l.area_l2 AND s.feature = l.feature) "
            "GROUP BY area_l1, area_l2, feature) GROUP BY area_l1, area_l2")


def last_hour_sql(src: str) -> str:
    """60 clock minutes up to the newest ballot of ``src`` for every area pair, silent minutes as zeros."""
    ev = f"SELECT area_l1, area_l2, ((log_ms + 30000) // 60000)::BIGINT AS em, {MALE} AS male, {FEMALE} AS female, {LIVE_FLAGS} FROM {src}"
    return ("SELECT p.area_l1, p.area_l2, g.step, " + ", ".join(f"coalesce(m.{c}, 0)::BIGINT AS {c}" for c in COUNTERS)
            + " FROM (SELECT n_regionkey::BIGINT AS area_l1, n_nationkey::BIGINT AS area_l2 FROM nation) p "
            "CROSS JOIN (SELECT range::BIGINT AS step FROM range(1, 61)) g "
            f"CROSS JOIN (SELECT max((log_ms + 30000) // 60000)::BIGINT AS newest FROM {src}) t "
            f"LEFT JOIN (SELECT area_l1, area_l2, em, {sums(COUNTERS)} FROM ({ev}) GROUP BY area_l1, area_l2, em) m "
            "ON m.area_l1 = p.area_l1 AND m.area_l2 = p.area_l2 AND m.em = t.newest - 60 + g.step")


view("fc", trend_sql("steps60"), ["steps60"])
view("steps_lh", last_hour_sql("ballots"), ["ballots"])
view("iqr_l2", "SELECT dataset, area_id, " + ", ".join(
    f"quantile_cont({c}::DOUBLE, 0.25) AS q1_{c}, quantile_cont({c}::DOUBLE, 0.75) AS q3_{c}" for c in COUNTERS)
    + " FROM dense_l2 GROUP BY dataset, area_id", ["dense_l2"])
view("zeroed_l2", "SELECT d.dataset, d.area_id, d.minute, " + ", ".join(
    f"CASE WHEN d.{c} < q.q1_{c} - 1.5 * (q.q3_{c} - q.q1_{c}) OR d.{c} > q.q3_{c} + 1.5 * (q.q3_{c} - q.q1_{c}) "
    f"THEN 0.0 ELSE d.{c}::DOUBLE END AS {c}" for c in COUNTERS)
    + " FROM dense_l2 d JOIN iqr_l2 q ON q.dataset = d.dataset AND q.area_id = d.area_id", ["iqr_l2"])
view("fit_l2", fit_sql("zeroed_l2"), ["zeroed_l2"])
# history files listed as 2, 0, 1
view("hist_listed", "SELECT * REPLACE (((dataset + 1) % 3)::BIGINT AS dataset) FROM hist", ["hist"])
view("dense_listed", dense_sql("area_l1", True, "hist_listed"), ["hist_listed"])
view("zeroed_listed", "SELECT d.dataset, d.area_id, d.minute, " + ", ".join(
    f"CASE WHEN d.{c} < q.q1_{c} - 1.5 * (q.q3_{c} - q.q1_{c}) OR d.{c} > q.q3_{c} + 1.5 * (q.q3_{c} - q.q1_{c}) "
    f"THEN 0.0 ELSE d.{c}::DOUBLE END AS {c}" for c in COUNTERS)
    + " FROM dense_listed d JOIN (SELECT dataset, area_id, " + ", ".join(
    f"quantile_cont({c}::DOUBLE, 0.25) AS q1_{c}, quantile_cont({c}::DOUBLE, 0.75) AS q3_{c}" for c in COUNTERS)
    + " FROM dense_listed GROUP BY dataset, area_id) q ON q.dataset = d.dataset AND q.area_id = d.area_id", ["dense_listed"])
STORED = ("SELECT area_id AS area_l2, feature, lo, hi FROM (UNPIVOT (SELECT * FROM fit_l2) ON "
          + ", ".join(f"(lo_{c}, hi_{c}) AS {c}" for c in COUNTERS) + " INTO NAME feature VALUE lo, hi)")
# ballots that the change log carries (inserts and updates), and what the live job makes of them
view("stream_ballots", f"SELECT * FROM (SELECT *, {OP} AS op FROM ballots) WHERE op IN ('c', 'u')", ["ballots"])
view("stream_steps", last_hour_sql("stream_ballots"), ["stream_ballots"])
view("stream_fc", trend_sql("stream_steps"), ["stream_steps"])
view("stream_l2", "SELECT area_l2, " + ", ".join(f"sum({e})::BIGINT AS {n}" for n, e in (
    [("male", flag("sex = 1")), ("female", flag("sex = 2"))] + [(n, flag(closed("age", lo, hi))) for n, lo, hi in C.SUMMARY_BINS]))
    + " FROM stream_ballots GROUP BY area_l2", ["stream_ballots"])
view("fc_live", "SELECT f.area_l1, f.area_l2, f.male + s.male AS male, f.female + s.female AS female, "
     + ", ".join(f"f.col_{i + 1} + s.{AGE_COLS[i]} AS col_{i + 1}" for i in range(5))
     + ", f.col_6 + f.col_7 + s.age_71_p AS col_6 FROM fc f JOIN s_l2 s ON s.area_id = f.area_l2", ["fc", "s_l2"])
view("slot", "SELECT date_trunc('hour', max(ts) + INTERVAL 1 HOUR) AS slot FROM ballots", ["ballots"])
view("seeded", "SELECT area_l1, area_l2, time_slot, " + ", ".join(C.PREDICTION_COUNTERS) + " FROM prediction UNION ALL "
     "SELECT d.area_l1, d.area_l2, (SELECT slot FROM slot), " + ", ".join(f"0::BIGINT" for _ in C.PREDICTION_COUNTERS)
     + " FROM (SELECT DISTINCT n_regionkey::BIGINT AS area_l1, n_nationkey::BIGINT AS area_l2 FROM nation) d "
     "WHERE NOT EXISTS (SELECT 1 FROM prediction p WHERE p.area_l1 = d.area_l1 AND p.area_l2 = d.area_l2)",
     ["prediction", "slot"])


def eval_sql() -> str:
    lf = ("SELECT dataset, area_id, feature, k, y FROM (SELECT *, (row_number() OVER (PARTITION BY dataset, area_id "
          "ORDER BY minute) - 1)::DOUBLE AS k FROM scaled_l1) UNPIVOT (y FOR feature IN (" + ", ".join(COUNTERS) + "))")
    wf = (f"SELECT dataset, area_id, feature, k, regr_slope(y, k) OVER win AS b, regr_intercept(y, k) OVER win AS a, "
          "count(*) OVER wout AS nt, sum(y) OVER wout AS sy, sum(y * y) OVER wout AS syy, sum(k * y) OVER wout AS sky, "
          f"sum(k) OVER wout AS sk, sum(k * k) OVER wout AS skk FROM ({lf}) "
          "WINDOW win AS (PARTITION BY dataset, area_id, feature ORDER BY k ROWS BETWEEN CURRENT ROW AND 59 FOLLOWING), "
          "wout AS (PARTITION BY dataset, area_id, feature ORDER BY k ROWS BETWEEN 60 FOLLOWING AND 119 FOLLOWING)")
    # predicted sum over the 60 target steps k+60 .. k+119 is 60 a + b (60 k + 5370)
    params = ("SELECT area_id, feature, lo, hi FROM (UNPIVOT (SELECT * FROM fit_l1) ON "
              + ", ".join(f"(lo_{c}, hi_{c}) AS {c}" for c in COUNTERS) + " INTO NAME feature VALUE lo, hi)")
    pos = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(COUNTERS)) + " END"
    per = ("SELECT w.dataset, w.area_id, w.k, "
           "sum(syy - 2 * a * sy - 2 * b * sky + 60 * a * a + 2 * a * b * sk + b * b * skk) "
           f"/ {60 * len(COUNTERS)} AS mse, "
           "list(round_even(round((60 * a + b * (60 * w.k + 5370)) * (CASE WHEN p.hi = p.lo THEN 1.0 ELSE p.hi - p.lo END) "
           f"+ p.lo, 6), 0)::BIGINT ORDER BY {pos.replace('feature', 'w.feature')}) AS counts "
           f"FROM ({wf}) w JOIN ({params}) p ON p.area_id = w.area_id AND p.feature = w.feature "
           "WHERE nt = 60 GROUP BY w.dataset, w.area_id, w.k")
    spl = ("SELECT *, CASE WHEN row_number() OVER (PARTITION BY dataset, area_id ORDER BY k) > count(*) OVER "
           "(PARTITION BY dataset, area_id) - ceil(0.1 * count(*) OVER (PARTITION BY dataset, area_id)) "
           f"THEN 'test' ELSE 'train' END AS split FROM ({per})")
    return (f"SELECT dataset, area_id, split, count(*)::BIGINT AS n_windows, round(avg(mse), 6) AS mse, "
            f"arg_max(counts, k) AS last_counts FROM ({spl}) GROUP BY dataset, area_id, split")


def ridge_sql(src: str, upto: int | None = None) -> str:
    """area_id, feature, n, c0 and w1..w3 of a ridge fit of a scaled minute on the three before it: centred normal equations
    with 0.001 per row on the diagonal, solved by Cramer's rule, rounded to six decimals."""
    long = (f"SELECT dataset, area_id, feature, minute, y FROM {src} UNPIVOT (y FOR feature IN (" + ", ".join(COUNTERS) + "))")
    lag = ("SELECT *, " + ", ".join(f"lag(y, {i}) OVER w AS x{i}" for i in (1, 2, 3)) + ", row_number() OVER w - 1 AS k "
           f"FROM ({long}) WINDOW w AS (PARTITION BY dataset, area_id, feature ORDER BY minute)")
    rows = f"SELECT * FROM ({lag}) WHERE k >= 3" + (f" AND k < {upto}" if upto else "")
    pairs = {"a": (1, 1), "b": (1, 2), "c": (1, 3), "d": (2, 2), "e": (2, 3), "f": (3, 3)}
    sums_ = ("SELECT area_id, feature, count(*) AS n, avg(y) AS my, " + ", ".join(f"avg(x{i}) AS m{i}" for i in (1, 2, 3)) + ", "
             + ", ".join(f"sum(x{i} * x{j}) - count(*) * avg(x{i}) * avg(x{j}){' + 0.001 * count(*)' if i == j else ''} AS {v}"
                         for v, (i, j) in pairs.items()) + ", "
             + ", ".join(f"sum(x{i} * y) - count(*) * avg(x{i}) * avg(y) AS r{i}" for i in (1, 2, 3)) + f" FROM ({rows}) GROUP BY area_id, feature")
    det = "(a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d))"
    w = (f"(r1 * (d * f - e * e) - b * (r2 * f - e * r3) + c * (r2 * e - d * r3)) / {det}",
         f"(a * (r2 * f - e * r3) - r1 * (b * f - c * e) + c * (b * r3 - c * r2)) / {det}",
         f"(a * (d * r3 - e * r2) - b * (b * r3 - c * r2) + r1 * (b * e - c * d)) / {det}")
    solved = "SELECT *, " + ", ".join(f"{x} AS v{i + 1}" for i, x in enumerate(w)) + f" FROM ({sums_})"
    return ("SELECT area_id, feature, n::BIGINT AS n, round(my - v1 * m1 - v2 * m2 - v3 * m3, 6) AS c0, "
            + ", ".join(f"round(v{i}, 6) AS w{i}" for i in (1, 2, 3)) + f" FROM ({solved})")


def rolled_sql(kind: str = "'ridge'") -> str:
    """Forecast of steps60 by the stored models, a step at a time; ``kind`` (SQL over area_id) may name trend or last instead."""
    scaled = ("SELECT l.area_l1, l.area_l2, l.feature, l.step, s.lo, s.span, (l.x - s.lo) / s.span AS y FROM (UNPIVOT steps60 ON "
              + ", ".join(COUNTERS) + " INTO NAME feature VALUE x) l JOIN (SELECT area_l2, feature, lo, "
              f"CASE WHEN hi = lo THEN 1.0 ELSE (hi - lo)::DOUBLE END AS span FROM ({STORED.replace('fit_l2', 'fit_whole_l2')})) s ON s.area_l2 = l.area_l2 AND s.feature = l.feature")
    start = ("SELECT area_l1, area_l2, feature, any_value(lo) AS lo, any_value(span) AS span, " + ", ".join(
        f"max(y) FILTER (WHERE step = {61 - i}) AS x{i}" for i in (1, 2, 3))
        + ", 60 * regr_intercept(y, step) + 5430 * regr_slope(y, step) AS trend FROM scaled GROUP BY area_l1, area_l2, feature")
    return ("SELECT * FROM (WITH RECURSIVE scaled AS (" + scaled + "), start AS (" + start + "), "
            "walk AS (SELECT s.area_l1, s.area_l2, s.feature, 0 AS h, 0.0::DOUBLE AS y, x1, x2, x3, c0, w1, w2, w3 FROM start s "
            "JOIN ridge_l2 m ON m.area_id = s.area_l2 AND m.feature = s.feature "
            "UNION ALL SELECT area_l1, area_l2, feature, h + 1, c0 + w1 * x1 + w2 * x2 + w3 * x3, c0 + w1 * x1 + w2 * x2 + w3 * x3, x1, x2, "
            "c0, w1, w2, w3 FROM walk WHERE h < 60), "
            "total AS (SELECT area_l2, feature, sum(y) AS ridge FROM walk GROUP BY area_l2, feature) "
            "SELECT area_l1, area_l2, " + ", ".join(f"max(v) FILTER (WHERE feature = '{c}') AS {c}" for c in COUNTERS)
            + " FROM (SELECT s.area_l1, s.area_l2, s.feature, trunc(round(CASE kind WHEN 'ridge' THEN t.ridge WHEN 'last' THEN 60 * s.x1 ELSE s.trend END "
            f"* span + lo, 6))::BIGINT AS v FROM (SELECT *, {kind.replace('area_id', 'area_l2')} AS kind FROM start) s "
            "JOIN total t ON t.area_l2 = s.area_l2 AND t.feature = s.feature) GROUP BY area_l1, area_l2)")


def ridge_eval_sql() -> str:
    """Errors per window of the models fitted before minute 600 (the first test target), and of the trend from eval_sql."""
    trend = eval_sql().replace(", arg_max(counts, k) AS last_counts", "")
    long = ("SELECT dataset, area_id, feature, k, y FROM (SELECT *, row_number() OVER (PARTITION BY dataset, area_id ORDER BY minute) - 1 AS k "
            "FROM scaled_l1) UNPIVOT (y FOR feature IN (" + ", ".join(COUNTERS) + "))")
    return ("SELECT * FROM (WITH RECURSIVE g AS (" + long + "), m AS (" + ridge_sql("scaled_l1", 600) + "), "
            "walk AS (SELECT g.dataset, g.area_id, g.feature, g.k AS last, 0 AS h, 0.0::DOUBLE AS p, y AS x1, "
            "lag(y, 1) OVER w AS x2, lag(y, 2) OVER w AS x3, c0, w1, w2, w3 FROM g JOIN m ON m.area_id = g.area_id AND m.feature = g.feature "
            "WINDOW w AS (PARTITION BY g.dataset, g.area_id, g.feature ORDER BY g.k) QUALIFY g.k BETWEEN 59 AND 659 "
            "UNION ALL SELECT dataset, area_id, feature, last, h + 1, c0 + w1 * x1 + w2 * x2 + w3 * x3, c0 + w1 * x1 + w2 * x2 + w3 * x3, x1, x2, "
            "c0, w1, w2, w3 FROM walk WHERE h < 60), "
            "err AS (SELECT w.dataset, w.area_id, w.last, avg((w.p - g.y) ** 2) AS mse FROM walk w JOIN g ON g.dataset = w.dataset AND g.area_id = w.area_id "
            "AND g.feature = w.feature AND g.k = w.last + w.h WHERE w.h > 0 GROUP BY w.dataset, w.area_id, w.last) "
            "SELECT e.dataset, e.area_id, e.split, e.n_windows, e.mse, t.mse AS mse_trend FROM (SELECT dataset, area_id, "
            "CASE WHEN last >= 599 THEN 'test' ELSE 'train' END AS split, count(*)::BIGINT AS n_windows, round(avg(mse), 6) AS mse FROM err GROUP BY ALL) e "
            f"JOIN ({trend}) t ON t.dataset = e.dataset AND t.area_id = e.area_id AND t.split = e.split)")


view("fit_whole_l2", fit_sql("dense_l2"), ["dense_l2"])
view("scaled_l2", scale_sql("dense_l2", "SELECT * FROM fit_whole_l2"), ["fit_whole_l2"])
view("ridge_l2", ridge_sql("scaled_l2"), ["scaled_l2"])


def modeling_sql() -> dict[str, str]:
    fmt = "strftime(time_slot, '%Y-%m-%d %H:%M:%S') AS time_slot"
    pc = ", ".join(C.PREDICTION_COUNTERS)
    d = {
        "history_load": "SELECT (day(ts) % 3)::BIGINT AS dataset, citizen_id, area_l2, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, "
                        "age, sex, reg_year, area_l1 FROM ballots",
        "history_prepared": "SELECT * FROM dense_l2",
        "minute_grid_dense": "SELECT * FROM dense_l1",
        "iqr_bounds": "SELECT * FROM iqr_l1",
        "outlier_zeroed": "SELECT * FROM zeroed_l1",
        "minmax_scaled": scale_sql("dense_l2", fit_sql("dense_l2")),
        "scaler_params": "SELECT * FROM fit_l1",
        "history_scaled": "SELECT * FROM scaled_l1",
        "history_scaled_listed": scale_sql("zeroed_listed", fit_sql("zeroed_listed")),
        "supervised_windows": "SELECT * FROM windows_l1",
        "time_split": "SELECT * FROM split_l1",
        "first_60_steps": "SELECT area_l1, area_l2, minute, " + ", ".join(COUNTERS) + ", step FROM first60",
        "pad_to_60": "SELECT * FROM steps60",
        "forecast_minutes": "SELECT * FROM fc",
        "forecast_trend_sql": "SELECT * FROM fc",
        "forecast_last_hour": trend_sql("steps_lh"),
        "forecast_stored_scaler": trend_sql("steps60", STORED),
        "forecast_eval": eval_sql(),
        "ridge_models": "SELECT area_id, feature, n AS n_rows, c0 AS intercept, w1, w2, w3 FROM ridge_l2",
        "forecast_ridge": rolled_sql(),
        "forecast_area_models": rolled_sql("CASE area_id % 4 WHEN 0 THEN 'ridge' WHEN 2 THEN 'last' ELSE 'trend' END"),
        "forecast_ridge_eval": ridge_eval_sql(),
        "forecast_plus_live": "SELECT * FROM fc_live",
        "prediction_seed": f"SELECT area_l1, area_l2, {fmt}, {pc} FROM seeded",
        "prediction_upsert": f"SELECT t.area_l1, t.area_l2, strftime(CASE WHEN u.area_l2 IS NULL THEN t.time_slot "
                             f"ELSE (SELECT slot FROM slot) END, '%Y-%m-%d %H:%M:%S') AS time_slot, "
                             + ", ".join(f"(CASE WHEN u.area_l2 IS NULL THEN t.{c} ELSE u.{c} END)::BIGINT AS {c}"
                                         for c in C.PREDICTION_COUNTERS)
                             + " FROM seeded t LEFT JOIN (SELECT * FROM fc_live WHERE area_l2 <> 7) u ON u.area_l1 = t.area_l1 AND u.area_l2 = t.area_l2",
    }
    views = ALL_VIEWS + ["hist", "dense_l1", "dense_l2", "iqr_l1", "zeroed_l1", "fit_l1", "scaled_l1", "windows_l1",
                         "split_l1", "mc", "first60", "steps60", "fc", "fc_live", "slot", "seeded", "steps_lh", "fit_l2", "zeroed_listed",
                         "scaled_l2", "ridge_l2"]
    return {k: with_views(v, *views) for k, v in d.items()}


def stream_sql() -> dict[str, str]:
    decoded = f"SELECT *, {OP} AS op FROM ballots"
    seen = "SELECT DISTINCT event_id AS o FROM ballots WHERE (event_id + 123) % 500 >= 7"
    # arrival: eight days of the month a part, every eleventh message a part later; late after two days
    arrived = ("SELECT *, (day(ts) - 1) // 8 + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS part FROM stream_ballots")
    judged = (f"SELECT *, coalesce(log_ms < (SELECT max(log_ms) FROM ({arrived}) e WHERE e.part < a.part) - 172800000, false) AS late FROM ({arrived}) a")
    d = {
        "stream_dedup_intervals": live_sql_raw()["cdc_decode"],
        "cdc_offset_gaps": "SELECT 'server1.votes.dbo.ballots' AS topic, 0 AS partition, (o + 1)::BIGINT AS first_missing, (n - 1)::BIGINT AS last_missing, "
                           f"(n - o - 1)::BIGINT AS n_missing FROM (SELECT o, lead(o) OVER (ORDER BY o) AS n FROM ({seen})) WHERE n > o + 1",
        "stream_late_rows": f"SELECT area_l1, area_l2, minute, count(*) FILTER (NOT late)::BIGINT AS on_time, count(*) FILTER (late)::BIGINT AS late "
                            f"FROM (SELECT area_l1, area_l2, late, {MINUTE} AS minute FROM ({judged})) "
                            "GROUP BY area_l1, area_l2, minute",
        "stream_minute_counts": "SELECT area_l1, area_l2, minute, " + sums(C.COUNTERS) + " FROM ("
                                + FEATURES.replace("FROM ballots", f"FROM ({decoded}) WHERE op IN ('c', 'u')")
                                + ") GROUP BY area_l1, area_l2, minute",
        "stream_dedup": live_sql_raw()["cdc_decode"],
        "stream_dedup_citizen": "SELECT citizen_id, event_id AS offset, age, sex, reg_year, log_ms, area_l1, area_l2 FROM stream_ballots "
                                "QUALIFY row_number() OVER (PARTITION BY citizen_id ORDER BY event_id) = 1",
        "stream_ingest_counts": f"SELECT count(*)::BIGINT AS messages, count(*) FILTER (op IN ('c', 'u'))::BIGINT AS ballots, "
                                f"min(event_id)::BIGINT AS first_offset, max(event_id)::BIGINT AS last_offset FROM ({decoded})",
        "stream_forecast": "SELECT f.area_l1, f.area_l2, strftime(make_timestamp(((SELECT max(log_ms) FROM stream_ballots) // 3600000 + 1) "
                           "* 3600000000), '%Y-%m-%d %H:%M:%S') AS time_slot, "
                           + ", ".join(f"(f.{c} + coalesce(s.{c}, 0))::BIGINT AS {c}" for c in ("male", "female")) + ", "
                           + ", ".join(f"(f.col_{i + 1} + coalesce(s.{AGE_COLS[i]}, 0))::BIGINT AS col_{i + 1}" for i in range(5))
                           + ", (f.col_6 + f.col_7 + coalesce(s.age_71_p, 0))::BIGINT AS col_6 "
                           "FROM stream_fc f LEFT JOIN stream_l2 s ON s.area_l2 = f.area_l2",
        "cdc_latest_state": "SELECT citizen_id, event_id AS offset, age, sex, reg_year, log_ms, area_l1, area_l2 FROM ("
                            f"SELECT * FROM ({decoded}) WHERE op IS NOT NULL "
                            "QUALIFY row_number() OVER (PARTITION BY citizen_id ORDER BY log_ms DESC, event_id DESC) = 1"
                            ") WHERE op <> 'd'",
    }
    d["stream_cdc_state"] = d["cdc_latest_state"]
    return {k: with_views(v, *ALL_VIEWS, "stream_ballots", "stream_fc", "stream_l2") for k, v in d.items()}


def pick_sql() -> str:
    cands = " UNION ALL ".join(f"SELECT {g} AS grp, '{n}' AS name, {w}::DOUBLE AS weight" for g, n, w in C.PICKS)
    u = ("((('0x' || substr(md5(b.batch_id::VARCHAR || ':' || c.name), 1, 13))::BIGINT)::DOUBLE + 0.5) "
         f"/ {float(1 << 52)}")
    return ("SELECT batch_id, grp, name, rnk::BIGINT AS rank FROM (SELECT b.batch_id, c.grp, c.name, "
            f"row_number() OVER (PARTITION BY b.batch_id, c.grp ORDER BY -ln({u}) / c.weight, c.name) AS rnk "
            "FROM (SELECT DISTINCT (ts::DATE - DATE '1970-01-01')::BIGINT AS batch_id FROM ballots) b "
            f"CROSS JOIN ({cands}) c) WHERE rnk <= 1")


# the bundle of batch 0: charts of the nation (two of them drawn), and of every region and wilayat
BUNDLE_NATION = ["hour_summary", "gender_turnout", "turnout_with_forecast"]
BUNDLE_AREA = ["area_cumulative_turnout", "area_gender_turnout", "area_turnout_with_forecast", "area_gender_forecast", "area_age_turnout"]
NESTED = ["region_gender_turnout", "wilayat_gender_top10", "region_age_top2", "wilayat_age_top2"]
BUNDLE_ENDPOINTS = ["nation", "nation_en", "nation_cn", "nation_ru", "nation_fr", "nation_es"]


def drawn(batch: int = 0) -> list[str]:
    """The report drawn from each weighted list: smallest -ln(u) / weight, u from md5 of '<batch>:<name>'."""
    best: dict[int, tuple] = {}
    for group, name, weight in C.PICKS:
        u = (int(hashlib.md5(f"{batch}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / float(1 << 52)
        best[group] = min(best.get(group, (math.inf, "")), (-math.log(u) / weight, name))
    return [best[g][1] for g in sorted(best)]


def bundle_sql() -> str:
    from turnout.plans.charts import CHART_SPECS
    reports, names = report_sql(), BUNDLE_NATION + drawn() + BUNDLE_AREA
    rows = " UNION ALL ".join(
        f"SELECT {i} AS pos, '{CHART_SPECS[n][0]}' AS type, '{CHART_SPECS[n][1]}' AS graph, '{CHART_SPECS[n][2]}' AS info, level, area_id, area_name, "
        f"x, x_ord, {'series' if n in NESTED else chr(39) * 2} AS series, y::DOUBLE AS y FROM ({reports[n]})" for i, n in enumerate(names))
    # an axis label that occurred before in its chart gets its place in brackets
    axis = ("SELECT *, CASE WHEN row_number() OVER (PARTITION BY pos, level, area_id, x ORDER BY k) > 1 THEN x || ' (' || k || ')' ELSE x END AS label "
            "FROM (SELECT *, row_number() OVER (PARTITION BY pos, level, area_id ORDER BY x_ord, x) AS k "
            f"FROM (SELECT DISTINCT pos, level, area_id, x, x_ord FROM ({rows})))")
    placed = f"SELECT *, dense_rank() OVER (PARTITION BY level, area_id ORDER BY pos) - 1 AS position FROM ({rows})"
    ends = (" UNION ALL ".join(f"SELECT 'nation' AS level, '{e}' AS endpoint" for e in BUNDLE_ENDPOINTS)
            + " UNION ALL SELECT 'l1', 'region' UNION ALL SELECT 'l2', 'wilayat'")
    return (f"SELECT e.endpoint, r.area_id::VARCHAR AS area_key, r.position::BIGINT AS position, r.type, r.graph, "
            f"replace(r.info, '{{name}}', r.area_name) AS info, r.series, a.label AS x, r.y FROM ({placed}) r "
            f"JOIN ({axis}) a ON a.pos = r.pos AND a.level = r.level AND a.area_id = r.area_id AND a.x = r.x AND a.x_ord = r.x_ord "
            f"JOIN ({ends}) e ON e.level = r.level")


def publish_sql() -> dict[str, str]:
    r15 = _r15()
    d = {
        "weighted_pick": pick_sql(),
        "chart_plots_json": "SELECT level, area_id, '{' || string_agg('\"' || x || '\":' || y::VARCHAR, ',' ORDER BY x_ord) || '}' AS plots "
                            f"FROM ({r15}) "
                            "GROUP BY level, area_id",
    }
    return {k: with_views(v, *ALL_VIEWS) for k, v in d.items()} | {"report_bundle_json": bundle_sql()}


def all_sql() -> dict[str, str]:
    out = dict(report_sql())
    out.update(live_sql())
    out.update(modeling_sql())
    out.update(stream_sql())
    out.update(publish_sql())
    return out
