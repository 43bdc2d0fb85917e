"""Stream = batch, restart from the checkpoint, late rows with and without a watermark."""

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from turnout.operators.features import ballot_features, minute_counts
from turnout.plans.streams import write_log_files
from turnout.session import scratch_path
from turnout.sources import cdc
from turnout.sources import proof_views as pv
from turnout.streaming import ingest as ST
from turnout.streaming import intervals as IV
from turnout.streaming import keyed, state


def _batch_counts(spark):
    raw = pv.cdc_raw(spark, SMALL)
    return minute_counts(ballot_features(ST.decoded_ballots(raw)))


def _rows(df, keys):
    return sorted(tuple(r[k] for k in keys) for r in df.collect())


def test_restart_resumes_without_loss(spark):
    raw = pv.cdc_raw(spark, SMALL)
    staged = scratch_path(spark, "staged")
    write_log_files(raw, staged)
    days = sorted(d for d in os.listdir(staged) if d.startswith("day="))
    src_dir = scratch_path(spark, "restart-in")
    os.makedirs(src_dir)
    half = len(days) // 2
    for d in days[:half]:
        shutil.copytree(os.path.join(staged, d), os.path.join(src_dir, d))
    table, ckpt = scratch_path(spark, "restart-table"), scratch_path(spark, "restart-ckpt")
    src = {"path": src_dir, "maxFilesPerTrigger": 3}
    ST.run_minute_counts(spark, src, table, ckpt).awaitTermination()
    for d in days[half:]:
        shutil.copytree(os.path.join(staged, d), os.path.join(src_dir, d))
    ST.run_minute_counts(spark, src, table, ckpt).awaitTermination()      # same checkpoint: resumes
    got = keyed.current(spark, table)
    assert len(keyed.manifests(spark, table)) <= keyed.KEEP
    keys = ["area_l1", "area_l2", "minute", "male", "female", "col_1", "col_7"]
    assert _rows(got, keys) == _rows(_batch_counts(spark), keys)


def test_watermark_drops_late_rows_only_when_asked(spark):
    good = lambda ms, cid: (('{"payload":{"after":{"CITIZENID":%d,"Age":40,"SEX":1,"VOTE_REG_YR":2011,'
                             '"LOG_TIMESTAMP":%d,"REGIONID":1,"WILAYATID":2},"op":"c"}}') % (cid, ms))
    base = 1_700_000_000_000
    first = [(0, i, good(base + i * 60_000, i)) for i in range(30)]                 # 30 minutes
    late = [(0, 100, good(base, 100))]                                              # 29 minutes late
    src_dir = scratch_path(spark, "late-in")

    def put(rows, day):
        df = spark.createDataFrame(rows, "partition int, offset long, value string")
        (df.select(F.lit("t").alias("topic"), "partition", "offset", F.col("value").cast("binary").alias("value"),
                   F.get_json_object("value", "$.payload.after.LOG_TIMESTAMP").cast("long").alias("ms"))
           .select("topic", "partition", "offset", "value", F.timestamp_millis("ms").alias("timestamp"))
           .coalesce(1).write.parquet(f"{src_dir}/day={day}"))
        time.sleep(1.1)                       # the file source orders files by modification time

    # Spark filters late rows with the watermark of the batch before the previous one, so an
    # on-time batch sits between the first minutes and the late row
    put(first, 1)
    put([(0, 50, good(base + 31 * 60_000, 50))], 2)
    put(late, 3)
    src = {"path": src_dir, "maxFilesPerTrigger": 1}
    for wm, expect in ((None, 2), ("5 minutes", 1)):
        table, ckpt = scratch_path(spark, "late-table"), scratch_path(spark, "late-ckpt")
        ST.run_minute_counts(spark, src, table, ckpt, watermark=wm).awaitTermination()
        keys = ["area_l1", "area_l2", "minute"] if wm is None else ["area_l1", "area_l2", "window_start"]
        t = keyed.current(spark, table)
        first_minute = t.orderBy(keys[-1]).first()
        assert first_minute["male"] == expect


def test_latest_state_drops_deleted_citizens(spark):
    ins = '{"payload":{"after":{"CITIZENID":1,"Age":40,"SEX":1,"LOG_TIMESTAMP":1,"REGIONID":1,"WILAYATID":2},"op":"c","ts_ms":1,"source":{"event_serial_no":1}}}'
    upd = ins.replace('"Age":40', '"Age":41').replace('"op":"c","ts_ms":1', '"op":"u","ts_ms":2')
    dele = '{"payload":{"before":{"CITIZENID":2},"op":"d","ts_ms":3,"source":{"event_serial_no":3}}}'
    ins2 = ins.replace('"CITIZENID":1', '"CITIZENID":2')
    rows = [(0, 0, ins), (0, 1, upd), (0, 2, ins2), (0, 3, dele)]
    log = spark.createDataFrame(rows, "partition int, offset long, value string").withColumn("value", F.col("value").cast("binary"))
    st = ST.latest_state(cdc.decode_state(log)).collect()
    assert [(r["citizen_id"], r["age"]) for r in st] == [(1, 41)]


def test_live_pipeline_publishes_every_batch(spark):
    from turnout.plans import streams as S
    from turnout.plans.inputs import Inputs
    from turnout.streaming import pipeline as PL
    src = S._source(spark, SMALL)
    folder, ckpt = scratch_path(spark, "live"), scratch_path(spark, "live-ckpt")
    q = PL.run_live_pipeline(spark, src, folder, ckpt, Inputs(spark, SMALL).dim, data_dir=SMALL)
    q.awaitTermination()
    n_batches = len(q.recentProgress)
    reports = spark.read.json(f"{folder}/reports")
    per = {(r["batch_id"], r["endpoint"]): r["count"] for r in reports.groupBy("batch_id", "endpoint").count().collect()}
    assert {b for b, _ in per} == set(range(n_batches))
    assert all(per[(b, "nation_en")] == 1 for b in range(n_batches))
    pred = state.current(spark, f"{folder}/prediction")
    assert pred.count() == Inputs(spark, SMALL).dim.count()          # one row per hierarchy pair


def test_running_forecast_does_not_depend_on_batches(spark):
    from turnout.plans import streams as S
    from turnout.plans.inputs import Inputs
    from turnout.streaming import pipeline as PL
    tables = []
    for files in (1000, 20, 7):
        src = S._source(spark, SMALL, files_per_trigger=files)
        folder, ckpt = scratch_path(spark, "live-run"), scratch_path(spark, "live-run-ckpt")
        q = PL.run_live_pipeline(spark, src, folder, ckpt, Inputs(spark, SMALL).dim, publish=False, forecast_from="running")
        q.awaitTermination()
        for name in ("minutes", "summary", "prediction"):
            assert len(state.versions(spark, f"{folder}/{name}")) <= state.KEEP
        tables.append(sorted(map(tuple, state.current(spark, f"{folder}/prediction").collect())))
    assert tables[0] == tables[1] == tables[2]
    assert len(tables[0]) == Inputs(spark, SMALL).dim.count()


@pytest.mark.parametrize("files", [1000, 30, 6])
def test_dedup_does_not_depend_on_batches(spark, files):
    from turnout.plans import streams as S
    raw = pv.cdc_raw(spark, SMALL)
    got = S.stream_dedup(spark, SMALL, files_per_trigger=files)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, cdc.decode_cdc(raw).collect()), key=str)
    first = S.stream_dedup_citizen(spark, SMALL, files_per_trigger=files)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, ST.first_ballots(raw).collect()))


def test_last_hour_crosses_midnight(spark):
    from turnout.plans import forecast as FC
    day = 86_400_000
    ms = [day * 20_000 + 23 * 3_600_000, day * 20_000 + 86_390_000, day * 20_001 + 600_000]  # 23:00, 23:59:50, 00:10 next day
    ballots = spark.createDataFrame([(1, 2, 40, 1, t) for t in ms] + [(1, 3, 40, 2, ms[0])],
                                    "area_l1 long, area_l2 long, age long, sex long, log_ms long")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "area_l1 long, area_l2 long")
    steps = FC.last_hour_steps(FC.event_minute_counts(ballots), pairs)
    assert steps.count() == 120
    assert [(r.area_l2, r.step) for r in steps.filter("male + female > 0").orderBy("step").collect()] == [(2, 50), (2, 60)]


def test_bundles_from_given_documents(spark):
    """Denominators, names, ages and summary all given: nothing is read from a data directory."""
    from turnout.operators.aggregate import summaries_eager
    from turnout.plans import charts as CH
    from turnout.plans.inputs import Inputs
    from turnout.sources import dims
    given = Inputs(spark, SMALL)
    docs = {}
    for level in ("nation", "l1", "l2"):
        path = scratch_path(spark, f"doc-{level}")
        dims.write_registered_doc(given.registered(level), path, level)
        docs[level] = dims.read_registered(spark, path, level)
    rows = [tuple(r) for r in given.dim.collect()]
    own = Inputs(spark, None, summary=summaries_eager(pv.ballot_events(spark, SMALL), pv.citizen_areas(spark, SMALL)),
                 prediction_table=given.prediction, registered_tables=docs, area_table=dims.area_table(spark, rows),
                 age_counts=given.ages, registered_age_counts=given.reg_ages)
    assert sorted(map(tuple, CH.bundles(own).collect())) == sorted(map(tuple, CH.bundles(given).collect()))


def test_live_age_chart_counts_the_ballots_so_far(spark):
    from turnout.plans import reports as R
    from turnout.plans import streams as S
    from turnout.plans.inputs import Inputs
    from turnout.streaming import pipeline as PL
    src = S._source(spark, SMALL, files_per_trigger=20)
    folder, ckpt = scratch_path(spark, "live-ages"), scratch_path(spark, "live-ages-ckpt")
    PL.run_live_pipeline(spark, src, folder, ckpt, Inputs(spark, SMALL).dim, data_dir=SMALL).awaitTermination()
    ages = state.current(spark, f"{folder}/ages")
    decoded = ST.decoded_ballots(pv.cdc_raw(spark, SMALL)).filter("age IS NOT NULL").groupBy("age").count()
    assert sorted(map(tuple, ages.collect())) == sorted(map(tuple, decoded.collect()))
    live = R.r5_top_ages(Inputs(spark, SMALL, age_counts=ages))
    assert live.count() == 10


def test_ingest_counts_add_up(spark):
    from turnout.plans import streams as S
    tot = S.stream_ingest_counts(spark, SMALL).first()
    raw = pv.cdc_raw(spark, SMALL)
    assert tot["messages"] == raw.count()
    assert tot["ballots"] == ST.decoded_ballots(raw).count()


def test_command_line_takes_documents(spark, tmp_path):
    from turnout import __main__ as cli
    from turnout.plans.inputs import Inputs
    from turnout.sources import dims
    given = Inputs(spark, SMALL)
    args = ["reports", "--data-dir", SMALL, "--out", str(tmp_path / "out")]
    for level, name in (("nation", "nation"), ("l1", "region"), ("l2", "wilayat")):
        doubled = given.registered(level).withColumn("voters", F.col("voters") * 2)
        dims.write_registered_doc(doubled, str(tmp_path / name), level)
        args += [f"--{name}-doc", str(tmp_path / name)]
    (tmp_path / "areas.csv").write_text("area_l1,l1_name,area_l2,l2_name\n" + "".join(f"{a},R{a},{b},W{b}\n" for a, _, b, _ in map(tuple, given.dim.collect())))
    cli.main([*args, "--areas", str(tmp_path / "areas.csv")])
    lines = spark.read.json(str(tmp_path / "out")).filter("endpoint = 'region'").collect()
    assert lines and all("R" + r["area_key"] + ": turnout by hour" in r["charts"] for r in lines)
