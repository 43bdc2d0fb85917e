"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "turnout",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark; clusters bring their own."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**ENGINE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read; without it nothing there may
    be written, so it must be set.  A local session without it (tests) gets a folder, made once.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        conf = tempfile.mkdtemp(prefix="turnout-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never reused)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "turnout", f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``turnout`` importable on executors (the ``--py-files`` step), once per session.

    Grouped pandas functions reference this package by module name, so Python workers must be
    able to import it wherever the driver was started from.
    """
    import zipfile

    sc = spark.sparkContext
    key = (id(sc), sc.applicationId)
    if key in _SHIPPED:
        return
    base = ensure_checkpoint_dir(spark)
    if "://" in base and not base.startswith("file:"):
        # shared remote storage: the package is deployed with --py-files / installed on the cluster
        _SHIPPED.add(key)
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = scratch_path(spark, "pyfiles") + ".zip"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.join("turnout", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
