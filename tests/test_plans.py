"""Plan shape: pruned scans, one pass over ballots per report, no Python in report plans."""

from tests.conftest import SMALL
from turnout.plans import reports as R
from turnout.plans.inputs import Inputs


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_plans_stay_in_the_jvm(spark):
    for name, fn in R.REPORTS.items():
        p = _plan(fn(Inputs(spark, SMALL)))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def _final(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_scans_read_only_needed_columns(spark):
    p = _plan(R.r12_region_turnout(Inputs(spark, SMALL)))
    scans = [line for line in p.splitlines() if "FileScan" in line and "/events.parquet" in line]
    assert scans and all("c_acctbal" not in line and "event_type" not in line and "value" not in line for line in scans)
    assert all("ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in line for line in scans)


def test_area_reports_scan_events_once(spark):
    assert _final(R.r20_area_age_turnout(Inputs(spark, SMALL))).count("/events.parquet") == 1


def test_history_scans_events_once(spark):
    from turnout.plans import modeling as M
    for query in (M.minute_grid_dense, M.outlier_zeroed, M.history_scaled, M.supervised_windows, M.forecast_eval):
        assert _final(query(spark, SMALL)).count("/events.parquet") == 1, query.__name__


def test_summary_filter_reaches_the_scan(spark):
    from turnout.plans.live import summary_scan
    p = _plan(summary_scan(spark, SMALL))
    assert "PushedFilters: [IsNotNull(total), GreaterThan(total,0)]" in p
    assert "ReadSchema: struct<area_id:bigint,total:bigint,male:bigint,female:bigint>" in p


def test_minute_counts_combines_before_shuffle_unless_colocated(spark):
    from turnout.operators.features import ballot_features, minute_counts
    from turnout.sources import proof_views as pv
    f = ballot_features(pv.ballots(spark, SMALL))
    default = _plan(minute_counts(f))
    assert default.count("Exchange hashpartitioning") == 1 and "partial_sum" in default
    colocated = _plan(minute_counts(f, colocate=8))
    assert colocated.count("Exchange hashpartitioning(area_l2") == 1
    assert colocated.count("Exchange hashpartitioning") == 1        # the aggregate reuses the area partitioning


def test_small_dimensions_are_broadcast_by_size(spark):
    """No hint needed: at this size Spark's measured-size rule picks broadcast joins for dimensions."""
    df = R.r16_area_gender_turnout(Inputs(spark, SMALL))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
