"""Streams whose state follows the log's gaps or the batch: interval sets, keyed tables, change state, audits."""

import os
import random
import shutil
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from turnout.plans import streams as S
from turnout.session import scratch_path
from turnout.sources import cdc
from turnout.sources import proof_views as pv
from turnout.streaming import ingest as ST
from turnout.streaming import intervals as IV
from turnout.streaming import keyed, state


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_interval_sets_against_a_set():
    random.seed(4)
    for _ in range(60):
        first, last, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), set()
        for _ in range(8):
            offsets = [random.randrange(120) for _ in range(random.randrange(40))]
            at, first, last = IV.add_offsets(first, last, np.array(offsets, dtype=np.int64))
            fresh = []
            for k, o in enumerate(offsets):
                if o not in seen:
                    seen.add(o)
                    fresh.append(k)
            assert at.tolist() == fresh
            covered = {o for a, b in zip(first.tolist(), last.tolist()) for o in range(a, b + 1)}
            assert covered == seen
            assert (first[1:] > last[:-1] + 1).all()      # merged: no two touch


@pytest.mark.parametrize("files", [1000, 30, 6])
def test_interval_dedup_does_not_depend_on_batches(spark, files):
    want = rows_of(cdc.decode_cdc(pv.cdc_raw(spark, SMALL)))
    assert rows_of(S.stream_dedup_intervals(spark, SMALL, files_per_trigger=files)) == want


def test_interval_state_is_small_and_files_may_come_in_any_order(spark):
    src = S._source(spark, SMALL, copies=3, files_per_trigger=5)
    files = [os.path.join(d, f) for d, _, fs in os.walk(src["path"]) for f in fs if f.endswith(".parquet")]
    random.seed(1)
    random.shuffle(files)
    now = time.time() - 10_000
    for k, f in enumerate(files):                          # the file source reads in order of modification time
        os.utime(f, (now + 2 * k, now + 2 * k))
    ckpt = scratch_path(spark, "iv-ckpt")
    raw = pv.cdc_raw(spark, SMALL)
    got = S._dedup_by_intervals(spark, src, ckpt)
    assert rows_of(got) == rows_of(cdc.decode_cdc(raw))
    held = spark.read.format("statestore").load(ckpt)
    n_rows = held.count()
    assert n_rows <= IV.SLICES * raw.select("topic", "partition").distinct().count() < raw.count() / 10
    intervals = held.selectExpr("size(value.groupState.first) AS n").agg(F.sum("n")).first()[0]
    assert intervals == n_rows                             # a log without gaps is one interval per slice


def test_packed_intervals_come_back_whole():
    random.seed(6)
    for _ in range(400):
        low, share = random.choice([0, 0, -300, 10**12]), random.random()
        offsets = [low + o for o in range(random.choice([5, 90, 800])) if random.random() < share]
        seen = IV.Seen(np.zeros(0, np.int64), np.zeros(0, np.int64))
        random.shuffle(offsets)
        for part in np.array_split(np.array(offsets, dtype=np.int64), random.randrange(1, 9)):
            seen.add(part)
        first, last = seen.intervals()
        stored = IV.packed(first, last)
        assert len(stored[0]) == len(stored[1]) <= min(len(first), 2 * (800 // 64 + 2) + 1)
        got = IV.unpacked(*stored)
        assert got[0].tolist() == first.tolist() and got[1].tolist() == last.tolist()
        assert [o for a, b in zip(*got) for o in range(a, b + 1)] == sorted(offsets)
    old = [3, 9], [5, 9]                                    # state of a checkpoint without words
    assert [x.tolist() for x in IV.unpacked(*old)] == list(old)


def _log(spark, offsets):
    """Log rows of a column of offsets; a null offset is a message too."""
    return offsets.selectExpr("'t' AS topic", "0 AS partition", "offset", "CAST(repeat(coalesce(string(offset), 'null'), 5) AS BINARY) AS value",
                              "timestamp_seconds(offset) AS timestamp")


def _write_parts(path, *parts):
    """One file per part, read in their order."""
    now = time.time() - 10_000
    for k, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{path}/day={k}")
        for f in os.listdir(f"{path}/day={k}"):
            os.utime(f"{path}/day={k}/{f}", (now + 2 * k, now + 2 * k))


def test_interval_state_stays_small_while_every_other_offset_is_missing(spark):
    n, path, ckpt = 40_000, scratch_path(spark, "halves"), scratch_path(spark, "halves-ckpt")
    log = _log(spark, spark.range(n).withColumnRenamed("id", "offset"))
    odd = log.filter("offset % 2 = 1")
    _write_parts(path, odd, odd, log)
    got = S._dedup_by_intervals(spark, {"path": path, "maxFilesPerTrigger": 1}, ckpt)
    assert rows_of(got) == rows_of(cdc.decode_cdc(log))
    size = lambda batch: spark.read.format("statestore").option("batchId", batch).load(ckpt).selectExpr("sum(size(value.groupState.first))").first()[0]
    assert size(0) == size(1) <= n / 64 + 2 * IV.SLICES     # 20,000 gaps
    assert size(2) == IV.SLICES


def test_interval_dedup_takes_null_offsets_as_equal(spark):
    path = scratch_path(spark, "null-offsets")
    nulls = spark.range(3).selectExpr("CAST(NULL AS BIGINT) AS offset")
    log = _log(spark, spark.range(10).withColumnRenamed("id", "offset").unionByName(nulls))
    _write_parts(path, log, log, log)
    got = S._dedup_by_intervals(spark, {"path": path, "maxFilesPerTrigger": 1}, scratch_path(spark, "null-offsets-ckpt"))
    assert rows_of(got) == rows_of(cdc.decode_cdc(log.dropDuplicates(["offset"])))


def test_interval_dedup_holds_few_messages_of_a_group_in_python(spark, monkeypatch):
    """200,000 messages of one slice in one batch: Python has some of them at a time."""
    n, path, notes = 200_000, scratch_path(spark, "one-slice"), scratch_path(spark, "one-slice-notes")
    offsets = f"id DIV {IV.BLOCK} * {IV.BLOCK * IV.SLICES} + id % {IV.BLOCK} AS offset"
    log = _log(spark, spark.range(n).selectExpr(offsets))
    _write_parts(path, log)
    os.makedirs(notes)
    plain = IV._first_seen

    def watched(slices, block):
        step = plain(slices, block)

        def run(key, frames, held):
            import gc
            import pandas as pd

            def noted():
                for k, frame in enumerate(frames):
                    if k % 5 == 0:
                        rows = sum(len(x) for x in gc.get_objects() if type(x) is pd.Series and x.name == "value")
                        with open(f"{notes}/{k}", "w") as f:
                            f.write(str(rows))
                    yield frame
            yield from step(key, noted(), held)
        return run
    monkeypatch.setattr(IV, "_first_seen", watched)
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    got = S._dedup_by_intervals(spark, {"path": path, "maxFilesPerTrigger": 1}, scratch_path(spark, "one-slice-ckpt"))
    assert got.count() == got.select("offset").distinct().count() == n
    held = [int(open(f"{notes}/{name}").read()) for name in os.listdir(notes)]
    assert 0 < max(held) < 0.75 * n, max(held)
    assert spark.conf.get(conf) == before


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, n long")


def test_keyed_table_is_the_last_row_of_every_key(spark):
    path, plain = scratch_path(spark, "keyed"), {}
    random.seed(2)
    for version in range(12):
        rows = [(k, f"v{version}", random.randrange(99)) for k in random.sample(range(40), random.randrange(1, 20))]
        plain |= {k: (k, v, n) for k, v, n in rows}
        keyed.upsert(_batch(spark, rows), path, ["k"], version, buckets=4)
        assert rows_of(keyed.current(spark, path)) == sorted(plain.values(), key=str)
        if version == 7:                                   # replayed: the same table
            keyed.upsert(_batch(spark, rows), path, ["k"], version, buckets=4)
            assert rows_of(keyed.current(spark, path)) == sorted(plain.values(), key=str)
    assert len(keyed.manifests(spark, path)) == keyed.KEEP
    runs = keyed.read_manifest(spark, path, 11)["runs"]
    assert all(len(r) <= 6 for r in runs.values()) and all(a[1] >= 2 * b[1] for r in runs.values() for a, b in zip(r, r[1:]))


def test_keyed_table_writes_what_the_batch_has(spark):
    """20 small batches over a large table: a batch writes a few rows, untouched buckets are not rewritten."""
    path = scratch_path(spark, "keyed-large")
    keyed.upsert(spark.range(50_000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.col("id").alias("n")), path, ["k"], 0)

    def size(version):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/run={version}") for f in fs if f.endswith(".parquet"))
    whole, per = size(0), []
    for version in range(1, 21):
        keyed.upsert(_batch(spark, [(version * 100 + k, "new", version) for k in range(10)]), path, ["k"], version)
        per.append(size(version))
    assert max(per) < whole / 4 and sum(per) < whole
    t = keyed.current(spark, path)
    assert t.count() == 50_000 and t.filter("v = 'new'").count() == 200
    # buckets that no later batch touched still stand in run 0
    assert os.path.isdir(f"{path}/run=0")


def test_keyed_table_forgets_tombstones_only_at_the_bottom(spark):
    path = scratch_path(spark, "keyed-gone")
    def put(version, rows, forget=None):
        keyed.upsert(_batch(spark, rows), path, ["k"], version, buckets=1, order=["n"], gone=F.col("v") == "x", forget=forget)
    put(0, [(1, "a", 5), (2, "b", 5), (3, "c", 5)])
    put(1, [(1, "x", 9)])
    put(2, [(1, "a", 7)])                                  # older than the deletion: stays away
    assert rows_of(keyed.current(spark, path)) == [(2, "b", 5), (3, "c", 5)]
    put(3, [(2, "x", 20), (3, "x", 20), (1, "x", 19), (4, "x", 18)], forget="n < 30")
    assert keyed.current(spark, path).count() == 0
    put(4, [(5, "e", 40)])
    assert rows_of(keyed.current(spark, path)) == [(5, "e", 40)]


@pytest.mark.parametrize("files", [1000, 7])
def test_change_state_does_not_depend_on_batches_or_order(spark, files):
    src = S._source(spark, SMALL, copies=2, files_per_trigger=files)
    parts = [os.path.join(d, f) for d, _, fs in os.walk(src["path"]) for f in fs if f.endswith(".parquet")]
    random.Random(files).shuffle(parts)
    now = time.time() - 10_000
    for k, f in enumerate(parts):
        os.utime(f, (now + 2 * k, now + 2 * k))
    table, ckpt = scratch_path(spark, "changes"), scratch_path(spark, "changes-ckpt")
    ST.run_change_state(spark, src, table, ckpt).awaitTermination()
    assert rows_of(ST.change_state(spark, table)) == rows_of(ST.latest_state(cdc.decode_state(pv.cdc_raw(spark, SMALL))))


def test_islands_and_gaps(spark):
    log = spark.createDataFrame([("t", 0, o) for o in [5, 3, 4, 4, 9, 2**40, 2**40 + 1]] + [("t", 1, 7), ("u", 0, 1), ("u", 0, 2)],
                                "topic string, partition int, offset long")
    found = IV.islands(log, block=4)
    assert rows_of(found) == sorted([("t", 0, 3, 5), ("t", 0, 9, 9), ("t", 0, 2**40, 2**40 + 1), ("t", 1, 7, 7), ("u", 0, 1, 2)], key=str)
    assert rows_of(IV.gaps(found)) == sorted([("t", 0, 6, 8, 3), ("t", 0, 10, 2**40 - 1, 2**40 - 10)], key=str)
    assert IV.gaps(IV.islands(log.limit(0))).count() == 0


def test_audit_names_what_was_lost_while_down(spark):
    """The job stops, files of a day are lost, it starts again: the audit names their offsets."""
    raw = pv.cdc_raw(spark, SMALL)
    staged, src_dir = scratch_path(spark, "audit-staged"), scratch_path(spark, "audit-in")
    ordered = raw.withColumn("day", F.expr("offset DIV 100"))
    ordered.repartition("day").write.partitionBy("day").parquet(staged)
    days = sorted((d for d in os.listdir(staged) if d.startswith("day=")), key=lambda d: int(d[4:]))
    table, ckpt = scratch_path(spark, "audit"), scratch_path(spark, "audit-ckpt")
    os.makedirs(src_dir)
    lost = days[4]
    for part in (days[:4], days[5:]):
        for d in part:
            shutil.copytree(os.path.join(staged, d), os.path.join(src_dir, d))
        IV.run_offset_audit(spark, {"path": src_dir, "maxFilesPerTrigger": 3}, table, ckpt).awaitTermination()
    found = IV.gaps(state.current(spark, table)).collect()
    n = int(lost[4:])
    assert [(r.first_missing, r.last_missing, r.n_missing) for r in found] == [(100 * n, 100 * n + 99, 100)]


def test_late_rows_and_rows_in_time_are_all_rows(spark):
    counts = S.stream_late_rows(spark, SMALL)
    total = counts.agg(F.sum("on_time"), F.sum("late")).first()
    assert sum(total) == ST.decoded_ballots(pv.cdc_raw(spark, SMALL)).count() and total[1] > 0


def test_ingest_counts_make_one_job_per_batch(spark):
    src = S._source(spark, SMALL, files_per_trigger=20)
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out, ckpt = scratch_path(spark, "observed"), scratch_path(spark, "observed-ckpt")
    q, store = ST.run_ingest_counts(spark, src, out, ckpt)
    q.awaitTermination()
    store.close()
    batches = spark.read.json(out).count()
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))) - before
    assert batches == len(q.recentProgress) > 1 and len(jobs) == batches
