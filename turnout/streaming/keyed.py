"""Keyed state tables of streams, log-structured: runs of upserts in hash buckets, named by a manifest per version.

A micro-batch adds one run: its own rows, dealt into buckets by the hash of their keys, together with the rows of
those older runs of the same bucket that are smaller than twice what is being written.  So a bucket has runs of
falling size, a logarithm of them, and what a batch writes follows the batch and not the table; buckets it does not
touch are not read.  A row's newest form wins by ``order`` (the batch by default).

The manifest of version n, written last, lists the runs of every bucket.  Batch n reads the manifest before it and
writes run n and manifest n, so a batch replayed after a failure writes the same again.  Runs that neither of the last
two manifests names are removed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.streaming.state import _folder

KEEP = 2       # the current manifest, and the one before it, which a replayed batch reads again
BUCKETS = 16
BUCKET, VERSION, GONE = "_bucket", "_version", "_gone"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def manifests(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _folder(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))


def read_manifest(spark: SparkSession, path: str, version: int) -> dict:
    """{keys, order, buckets, schema, runs: {bucket: [[version, rows at most], ...]}}, the oldest run first."""
    fs, place = _folder(spark, f"{path}/manifest/v={version}.json")
    stream = fs.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Written beside its place and renamed, so a manifest is there whole or not at all."""
    fs, _ = _folder(spark, path)
    beside, place = _path(spark, f"{path}/manifest/_v={version}"), _path(spark, f"{path}/manifest/v={version}.json")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    fs.delete(place, False)
    fs.rename(beside, place)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the newest by ``order``, then by version."""
    rest = [c for c in rows.columns if c not in keys]
    by = F.struct(*order, VERSION)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row")).select(*keys, "_row.*")


def _read_runs(spark: SparkSession, path: str, schema: T.StructType, runs: dict[int, list[int]]) -> DataFrame | None:
    """Rows of the listed runs: bucket -> versions."""
    paths = [f"{path}/run={v}/{BUCKET}={b}" for b, versions in runs.items() for v in versions]
    if not paths:
        return None
    return spark.read.schema(schema).parquet(*paths)


def upsert(batch: DataFrame, path: str, keys: list[str], version: int, buckets: int = BUCKETS, order: list[str] = (),
           gone: Column | None = None, forget: str | None = None) -> int:
    """Adds ``batch`` (one row per key at most, or several that ``order`` ranks) as version ``version``; the number of rows
    of the batch is returned.

    ``gone`` marks rows that delete their key.  They stay as tombstones, so that an older form that arrives later does
    not come back, until a run that is the oldest of its bucket is written and ``forget`` (SQL over the row) holds.
    Keys are not null.
    """
    spark = batch.sparkSession
    before = [n for n in manifests(spark, path) if n < version]
    manifest = read_manifest(spark, path, before[-1]) if before else {"keys": keys, "order": list(order), "buckets": buckets, "runs": {}}
    buckets, order = manifest["buckets"], manifest["order"]
    rows = batch.withColumn(GONE, F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)).withColumn(
        VERSION, F.lit(version).cast("long")).withColumn(BUCKET, bucket_of(keys, buckets))
    rows = rows.persist()
    try:
        added = {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}  # a row per bucket
        runs = {int(b): [list(r) for r in listed] for b, listed in manifest["runs"].items()}
        taken: dict[int, list[int]] = {}
        for b, n in added.items():
            listed = runs.setdefault(b, [])
            while listed and listed[-1][1] < 2 * n:
                v, size = listed.pop()
                taken.setdefault(b, []).append(v)
                n += size
            listed.append([version, n])
        schema = T.StructType([f for f in rows.schema.fields if f.name != BUCKET])
        older = _read_runs(spark, path, schema, taken)
        merged = rows if older is None else rows.unionByName(older.withColumn(BUCKET, bucket_of(keys, buckets)))
        merged = _newest(merged, [BUCKET, *keys], order)
        if forget is not None:
            bottom = [b for b in added if len(runs[b]) == 1]
            merged = merged.filter(~(F.col(GONE) & F.col(BUCKET).isin(bottom) & F.coalesce(F.expr(forget), F.lit(False)))) if bottom else merged
        # the shuffle by key is by bucket too, so a bucket becomes one file per run
        merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/run={version}")
        fs, _ = _folder(spark, path)
        if forget is not None:  # a bucket may have nothing left
            runs = {b: [r for r in listed if r[0] != version or fs.exists(_path(spark, f"{path}/run={version}/{BUCKET}={b}"))] for b, listed in runs.items()}
    finally:
        rows.unpersist()
    manifest |= {"runs": {str(b): listed for b, listed in sorted(runs.items())}, "schema": schema.json()}
    _write_manifest(spark, path, version, manifest)
    _clean(spark, path, version)
    return sum(added.values())


def _clean(spark: SparkSession, path: str, version: int) -> None:
    """Removes manifests before the last two, and runs that those do not name."""
    fs, folder = _folder(spark, path)
    listed = [n for n in manifests(spark, path) if n <= version]
    kept = listed[-KEEP:]
    used = {v for n in kept for runs in read_manifest(spark, path, n)["runs"].values() for v, _ in runs} | {version}
    for n in listed[:-KEEP]:
        fs.delete(_path(spark, f"{path}/manifest/v={n}.json"), False)
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if name.startswith("run=") and int(name[4:]) <= version and int(name[4:]) not in used:
            fs.delete(s.getPath(), True)


def current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table: the newest form of every key that is not deleted."""
    listed = manifests(spark, path)
    manifest = read_manifest(spark, path, listed[-1] if version is None else version)
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    rows = _read_runs(spark, path, schema, {int(b): [v for v, _ in runs] for b, runs in manifest["runs"].items()})
    if rows is None:
        rows = spark.createDataFrame([], schema)
    return _newest(rows, manifest["keys"], manifest["order"]).filter(~F.col(GONE)).drop(GONE, VERSION)


def sink(path: str, keys: list[str], buckets: int = BUCKETS, order: list[str] = ()):
    """foreachBatch writer of update-mode rows into a keyed table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, path, keys, batch_id, buckets, order)
    return write
