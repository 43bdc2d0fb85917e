"""All registered queries: key -> callable(spark, data_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnout import constants as C
from turnout.plans import live as L
from turnout.plans import modeling as M
from turnout.plans import publish as PB
from turnout.plans import reports as R
from turnout.plans import streams as S
from turnout.plans.inputs import Inputs
from turnout.sources import proof_views as pv

Query = Callable[[SparkSession, str], DataFrame]


def _report(fn) -> Query:
    return lambda spark, data_dir: fn(Inputs(spark, data_dir))


def _fresh(fn: Query) -> Query:
    """The query on views that are built anew where table files have changed since the last one."""
    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        pv.refresh(spark, data_dir)
        return fn(spark, data_dir)
    return run


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {k: _report(fn) for k, fn in R.REPORTS.items()}
    q.update({
        "cdc_range_read": L.cdc_range_read,
        "cdc_decode": L.cdc_decode,
        "ballot_features": L.features,
        "minute_counts": L.live_minute_counts,
        "gender_flags": L.gender_flags,
        "gender_flags_history": lambda s, d: L.gender_flags(s, d, history_rule=True),
        "age_flags_live": lambda s, d: L.age_flag_rows(s, d, C.LIVE_BINS),
        "age_flags_history": lambda s, d: L.age_flag_rows(s, d, C.HISTORY_BINS),
        "age_summary_bins": lambda s, d: L.age_flag_rows(s, d, C.SUMMARY_BINS, closed=True),
        "drop_incomplete": L.drop_incomplete_rows,
        "minute_round": L.minute_round,
        "minute_round_nocarry": lambda s, d: L.minute_round(s, d, carry=False),
        "time_of_day": L.time_of_day,
        "minute_truncate": L.minute_truncate,
        "polling_hours_filter": L.polling_hours_filter,
        "area_filter": L.area_filter,
        "area_rollup": L.area_rollup,
        "summary_scan": L.summary_scan,
        "summary_area_scan": L.summary_area_scan,
        "registered_dim": L.registered_dim,
        "registered_dim_nation": lambda s, d: L.registered_dim(s, d, C.LEVEL_NATION),
        "registered_dim_region": lambda s, d: L.registered_dim(s, d, C.LEVEL_L1),
        "registered_dim_wilayat": lambda s, d: L.registered_dim(s, d, C.LEVEL_L2),
        "area_dim": L.area_dim_rows,
        "area_names": _report(R.h1_area_names),
        "hour_12h": _report(R.h2_hour_12h),
        "coerce_bad_values": L.coerce_bad_values,
        "pct_half_even": lambda s, d: L.pct_rounding(s, d, "even"),
        "pct_half_up": lambda s, d: L.pct_rounding(s, d, "up"),
        "zero_denominator_policy": L.zero_denominator_policy,
        "national_turnout": L.national_turnout,
        "region_age_turnout": L.region_age_turnout,
        "area_lookup_strict": L.area_lookup_strict,
        "forecast_by_slot": L.forecast_by_slot_rows,
        "next_hour_slot": L.next_hour_slot,
        "area_hourly": L.area_hourly,
        "age_unpivot": L.age_unpivot,
        "gender_pivot": L.gender_pivot,
        "ampm_order": L.ampm_order,
        "registered_age_fold": _report(R.registered_age_fold),
        "history_load": M.history_load,
        "history_prepared": M.history_prepared,
        "minute_grid_dense": M.minute_grid_dense,
        "iqr_bounds": M.iqr_bounds,
        "outlier_zeroed": M.outlier_zeroed,
        "minmax_scaled": M.minmax_scaled,
        "scaler_params": M.scaler_params,
        "history_scaled": M.history_scaled,
        "history_scaled_listed": M.history_scaled_listed,
        "supervised_windows": M.supervised_windows,
        "time_split": M.time_split,
        "first_60_steps": M.first_60_steps,
        "pad_to_60": M.pad_to_60,
        "forecast_minutes": M.forecast_minutes,
        "forecast_last_hour": M.forecast_last_hour,
        "forecast_stored_scaler": M.forecast_stored_scaler,
        "forecast_trend_sql": M.forecast_trend_sql,
        "forecast_eval": M.forecast_eval,
        "ridge_models": M.ridge_models,
        "forecast_ridge": M.forecast_ridge,
        "forecast_area_models": M.forecast_area_models,
        "forecast_ridge_eval": M.forecast_ridge_eval,
        "forecast_plus_live": M.forecast_plus_live,
        "prediction_seed": M.prediction_seed,
        "prediction_upsert": M.prediction_upsert,
        "stream_minute_counts": S.stream_minute_counts,
        "stream_ingest_counts": S.stream_ingest_counts,
        "stream_dedup": S.stream_dedup,
        "stream_dedup_citizen": S.stream_dedup_citizen,
        "stream_dedup_intervals": S.stream_dedup_intervals,
        "stream_late_rows": S.stream_late_rows,
        "cdc_latest_state": S.cdc_latest_state,
        "stream_cdc_state": S.stream_cdc_state,
        "cdc_offset_gaps": S.cdc_offset_gaps,
        "stream_forecast": S.stream_forecast,
        "chart_plots_json": PB.chart_plots_json,
        "weighted_pick": PB.weighted_pick,
        "report_bundle_json": PB.report_bundle_json,
    })
    return {k: _fresh(fn) for k, fn in q.items()}
