"""State tables of streams: a folder of versions, one per micro-batch, of which the last two are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEEP = 2  # the current version, and the one before it, which a replayed batch reads again


def _folder(spark: SparkSession, path: str):
    """Hadoop file system and path, so that shared storage of any kind works."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions (their writes were committed), ascending."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    jvm = spark.sparkContext._jvm
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return [n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/v={n}/_SUCCESS"))]


def version_before(spark: SparkSession, path: str, batch_id: int) -> str | None:
    """Path of the newest version that an earlier batch wrote, or None."""
    older = [n for n in versions(spark, path) if n < batch_id]
    return f"{path}/v={older[-1]}" if older else None


def write_version(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write version ``batch_id``, remove versions before the one it came from, and read it back."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/v={batch_id}")
    fs, _ = _folder(spark, path)
    for n in [n for n in versions(spark, path) if n <= batch_id][:-KEEP]:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v={n}"), True)
    return spark.read.schema(df.schema).parquet(f"{path}/v={batch_id}")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a state table."""
    return spark.read.parquet(f"{path}/v={versions(spark, path)[-1]}")
