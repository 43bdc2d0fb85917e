"""Invariants over the proof views."""

from pyspark.sql import functions as F

from tests.conftest import SMALL
from turnout import constants as C
from turnout.operators.aggregate import summaries
from turnout.plans import history as H
from turnout.plans import modeling as M
from turnout.plans import predictions as PR
from turnout.plans import reports as R
from turnout.plans.inputs import Inputs
from turnout.sources import proof_views as pv


def test_levels_sum_to_nation(spark):
    s = summaries(pv.ballots(spark, SMALL))
    tot = {r["level"]: r["t"] for r in s.groupBy("level").agg(F.sum("total").alias("t")).collect()}
    n = pv.ballots(spark, SMALL).count()
    assert tot["nation"] == tot["l1"] == tot["l2"] == tot["hour"] == tot["l1_hour"] == tot["l2_hour"] == n


def test_running_totals_never_fall(spark):
    rows = R.r15_area_cumulative_turnout(Inputs(spark, SMALL)).collect()
    by = {}
    for r in rows:
        by.setdefault((r["level"], r["area_id"]), []).append((r["x_ord"], r["y"]))
    for pts in by.values():
        ys = [y for _, y in sorted(pts)]
        assert ys == sorted(ys)


def test_dense_grid_and_windows(spark):
    dense = H.prepared(spark, SMALL, "area_l1", split=False)
    n_series = dense.select("dataset", "area_id").distinct().count()
    assert dense.count() == n_series * 720
    w = H.windows(spark, SMALL)
    assert w.count() == n_series * (720 - 119)
    one = w.orderBy("area_id", "start").first()
    assert len(one["inputs"]) == 60 and len(one["targets"]) == 60 and len(one["inputs"][0]) == 9


def test_split_is_last_ten_percent(spark):
    s = H.split_windows(spark, SMALL)
    per = s.groupBy("area_id", "split").count().collect()
    counts = {(r["area_id"], r["split"]): r["count"] for r in per}
    for (area, split), n in counts.items():
        if split == "test":
            assert n == 61 and counts[(area, "train")] == 540


def test_scaled_values_in_unit_range_for_fit_dataset(spark):
    sc = H.scaled(spark, SMALL)
    agg = sc.agg(*[F.min(c).alias(f"lo_{c}") for c in C.COUNTERS], *[F.max(c).alias(f"hi_{c}") for c in C.COUNTERS]).first()
    assert all(agg[f"lo_{c}"] >= 0 for c in C.COUNTERS) and all(agg[f"hi_{c}"] <= 1 for c in C.COUNTERS)


def test_seed_and_upsert_are_repeatable(spark):
    inp = Inputs(spark, SMALL)
    slot = M.batch_slot(spark, SMALL)
    table = PR.seed_predictions(inp.prediction, inp.dim, slot)
    pairs = inp.dim.count()
    assert table.count() == pairs                                  # one row per hierarchy pair
    assert table.select("area_l1", "area_l2").distinct().count() == pairs
    again = PR.seed_predictions(table, inp.dim, slot)
    assert again.count() == pairs                                  # seeding twice adds nothing
    updates = PR.add_live_totals(M.FC.forecast(M._minute_counts(spark, SMALL)), inp.level("l2"))
    once = PR.upsert_predictions(table, updates, slot)
    twice = PR.upsert_predictions(once, updates, slot)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_forecast_python_equals_sql(spark):
    a = {r["area_l2"]: tuple(r) for r in M.forecast_minutes(spark, SMALL).collect()}
    b = {r["area_l2"]: tuple(r) for r in M.forecast_trend_sql(spark, SMALL).collect()}
    assert a == b


def test_bundles_have_all_charts(spark):
    from turnout.plans import charts as CH
    b = CH.bundles(Inputs(spark, SMALL)).collect()
    nation = [r for r in b if r["endpoint"].startswith("nation")]
    assert len(nation) == len(CH.LANG_ENDPOINTS) and all(r["n_charts"] == 5 for r in nation)
    assert len({r["charts"] for r in nation}) == 1                 # the same bundle on every language endpoint
    import json
    charts = json.loads(nation[0]["charts"])
    assert {c["type"] for c in charts} <= {"stats", "forcasted"} and all("plots" in c for c in charts)


def test_report_switches(spark):
    inp = Inputs(spark, SMALL)
    r1 = {r["x_ord"]: r["y"] for r in R.r1_forecast_by_hour(inp).collect()}
    r1c = {r["x_ord"]: r["y"] for r in R.r1_forecast_by_hour(inp, cumulative_total=True).collect()}
    # the running total counts every slot up to the later one of an hour
    slots = R.forecast_by_slot(inp).orderBy("hour", "time_slot").collect()
    voters, total, want = inp.reg_nat.first()["voters"], 0, {}
    for r in slots:
        total += r["total"]
        want[r["hour"]] = round(100 * total / voters)
    assert r1c == want and sorted(r1) == sorted(want) and len(slots) > len(want)
    per = R.r17_area_forecast_cumulative(inp, cumulative_total=False).count()
    assert per == R.r17_area_forecast_cumulative(inp).count()
    fixed = [r["x_ord"] for r in R.r2_hour_summary(inp, legacy_ampm_order=False).orderBy("x_ord").collect()]
    assert fixed == sorted(set(fixed))


def test_forecast_from_last_hour_covers_every_area(spark):
    from turnout.plans import forecast as FC
    pairs = Inputs(spark, SMALL).dim
    steps = FC.last_hour_steps(M._last_hour(spark, SMALL), pairs)
    assert steps.groupBy("area_l2").count().filter("count <> 60").count() == 0
    assert FC.forecast_steps(steps).count() == pairs.count()


def test_empty_forecast_keeps_or_drops_live_points(spark):
    base = Inputs(spark, SMALL)
    empty = base.prediction.limit(0)
    inp = Inputs(spark, SMALL, prediction_table=empty)
    kept = R.r3_turnout_with_forecast(inp).collect()
    assert len(kept) == R.r2_hour_summary(base).count() and {r["series"] for r in kept} == {"stats"}
    assert R.r3_turnout_with_forecast(inp, keep_live=False).count() == 0          # published behaviour
    assert R.r18_area_turnout_with_forecast(inp, keep_live=False).count() == 0
