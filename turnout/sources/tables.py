"""Parquet tables of a data directory, read with explicit column lists so the scan is pruned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, data_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def table(spark: SparkSession, name: str, columns: list[str] | None = None, where=None) -> DataFrame:
    """Scan a catalog table or view; the filter and projection reach the scan."""
    df = spark.table(name)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, partition_by: str | None = None) -> None:
    """A catalog table in hash buckets of ``key`` (and partitions): a filter on the key reads its bucket only, and tables
    with equal buckets join on the key without a shuffle.  One task writes a bucket, so each is one file per partition."""
    w = df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
    (w.partitionBy(partition_by) if partition_by else w).saveAsTable(name)
