"""Models per area: the distributed fit against plain least squares, cogrouped forecasts, and policies that fail the query."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM, SMALL
from turnout import constants as C
from turnout.functions import percent as P
from turnout.plans import forecast as FC
from turnout.plans import live as L
from turnout.plans import modeling as M
from turnout.plans import reports as R
from turnout.plans import ridge as RG
from turnout.plans.inputs import Inputs


def test_fit_equals_least_squares(spark):
    rng = np.random.default_rng(0)
    frames = []
    for dataset in (0, 1):
        for area in (3, 4):
            f = pd.DataFrame({c: rng.random(200) if area == 3 else np.cumsum(rng.normal(size=200)) for c in C.COUNTERS})
            frames.append(f.assign(dataset=dataset, area_id=area, minute=range(420, 620)))
    series = spark.createDataFrame(pd.concat(frames)[["dataset", "area_id", "minute", *C.COUNTERS]])
    got = {(r.area_id, r.feature): r for r in RG.fit_ridge(series, upto=150).collect()}
    assert len(got) == 2 * len(C.COUNTERS)
    for area in (3, 4):
        for c in C.COUNTERS:
            x, y = [], []
            for f in frames:
                v = f[c].to_numpy()
                if f["area_id"].iloc[0] == area:
                    x += [v[k - 3:k][::-1] for k in range(3, 150)]
                    y += v[3:150].tolist()
            x, y = np.array(x), np.array(y)
            xc = x - x.mean(axis=0)
            w = np.linalg.solve(xc.T @ xc + RG.PENALTY * len(y) * np.eye(3), xc.T @ (y - y.mean()))
            r = got[area, c]
            assert r.n_rows == len(y) and np.allclose(r.weights, w, atol=2e-6) and abs(r.intercept - (y.mean() - x.mean(axis=0) @ w)) < 2e-6


def test_each_area_has_its_own_model(spark):
    steps = FC.model_steps(M._minute_counts(spark, SMALL))
    trend = {r.area_l2: r for r in FC.forecast_steps(steps).collect()}
    own, last_area = sorted(trend)[:2]
    rows = [(own, c, 0.5, [0.0, 0.0, 0.0], "ridge") for c in C.COUNTERS] + [(last_area, c, 0.0, [0.0] * 3, "last") for c in C.COUNTERS]
    models = spark.createDataFrame([*rows, *[(99, c, 0.0, [0.0] * 3, "ridge") for c in C.COUNTERS]],
                                   "area_id long, feature string, intercept double, weights array<double>, kind string")
    got = {r.area_l2: r for r in RG.forecast_area_models(steps, models).collect()}
    assert set(got) == set(trend) and all(got[a] == trend[a] for a in trend if a not in (own, last_area))
    last = {r.area_l2: r for r in steps.filter("step = 60").collect()}
    lo, hi = steps.filter(F.col("area_l2") == own).agg(F.min("male"), F.max("male")).first()
    assert got[own].male == int(30 * (hi - lo if hi > lo else 1) + lo)
    low = steps.filter(F.col("area_l2") == last_area).agg(F.min("male")).first()[0]
    assert got[last_area].male == 60 * (last[last_area].male - low) + low
    with pytest.raises(Exception, match="one kind of model"):
        RG.forecast_area_models(steps, models.withColumn("kind", F.expr("CASE WHEN feature = 'male' THEN 'trend' ELSE kind END"))).collect()


def test_fitted_models_beat_the_trend(spark):
    rows = M.forecast_ridge_eval(spark, MEDIUM).collect()
    assert {r.split for r in rows} == {"train", "test"}
    assert sum(r.mse for r in rows if r.split == "test") < sum(r.mse_trend for r in rows if r.split == "test")


def test_zero_denominator_fails_and_names_the_area(spark):
    rows = spark.createDataFrame([(5, 1, 2), (7, 1, 0)], "area_id long, n long, d long")
    ok = rows.filter("area_id = 5").select(P.percent("n", "d", on_zero=P.ZERO_ERROR, what=("area_id",)))
    assert ok.first()[0] == 50
    with pytest.raises(Exception, match="zero denominator d: area_id 7"):
        rows.select(P.percent("n", "d", on_zero=P.ZERO_ERROR, what=("area_id",))).collect()


@pytest.mark.parametrize("report", [R.r4_gender_turnout, R.r6_gender_forecast, R.r10_age_turnout, R.r11_regyear_turnout, R.r12_region_turnout,
                                    R.r15_area_cumulative_turnout, R.r19_area_gender_forecast])
def test_reports_with_the_published_error_policy(spark, report):
    base = Inputs(spark, SMALL)
    strict = Inputs(spark, SMALL, on_zero=P.ZERO_ERROR, registered_tables={
        lv: base.registered(lv).filter("female_count > 0") for lv in (C.LEVEL_NATION, C.LEVEL_L1, C.LEVEL_L2)})
    plain = Inputs(spark, SMALL, registered_tables=strict.registered_tables)
    assert sorted(map(tuple, report(strict).collect())) == sorted(map(tuple, report(plain).collect()))
    zero = {lv: base.registered(lv).select("area_id", *[F.lit(0).cast("long").alias(c) for c in base.registered(lv).columns if c != "area_id"])
            for lv in (C.LEVEL_NATION, C.LEVEL_L1, C.LEVEL_L2)}
    with pytest.raises(Exception, match="zero denominator"):
        report(Inputs(spark, SMALL, on_zero=P.ZERO_ERROR, registered_tables=zero)).collect()
    assert all(r["y"] is None for r in report(Inputs(spark, SMALL, registered_tables=zero)).collect())


def test_strict_lookup_fails_in_the_query(spark):
    strict = L.area_lookup_strict(spark, SMALL, raise_on_unknown=True)       # no job yet
    with pytest.raises(Exception, match="no registered voters: area_id 24"):
        strict.collect()
    from turnout.operators.joins import with_registered
    inp = Inputs(spark, SMALL)
    known = with_registered(inp.level("l2").filter("area_id <> 24"), inp.reg_l2, how="strict")
    assert known.count() == L.area_lookup_strict(spark, SMALL).count()


def test_bucketed_summary_prunes_and_joins_without_exchange(spark):
    names = L.summary_area_tables(spark, SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = L.summary_area_rows(spark, names)
        plan = whole._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        some = L.summary_area_rows(spark, names, areas=[3])
        scan = some._jdf.queryExecution().explainString(some._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        assert f"SelectedBucketsCount: 1 out of {L.SUMMARY_BUCKETS}" in scan and "PartitionFilters: [isnotnull(level" in scan
        assert [tuple(r) for r in some.collect()] == [tuple(r) for r in whole.filter("area_id = 3").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
