"""History files (S7): several yearly extracts with the same seven columns by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# columns are read by position; these are their names in the published files
HISTORY_COLUMNS = ["CITIZENID", "WILAYAT_CODE", "TIMESTAMP", "AGE", "SEX", "VOTE_REG_YR", "REGIONID"]

# read as text so that bad cells survive to the coercion step
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_COLUMNS])


def write_history(ballots: DataFrame, path: str) -> None:
    """One CSV folder per dataset (``dataset=<n>``), no header, columns in the published order."""
    ballots.select(
        F.col("dataset"),
        F.col("citizen_id").cast("string"), F.col("area_l2").cast("string"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("age").cast("string"), F.col("sex").cast("string"),
        F.col("reg_year").cast("string"), F.col("area_l1").cast("string"),
    ).toDF("dataset", *HISTORY_COLUMNS).write.mode("overwrite").partitionBy("dataset").csv(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Columns by position with an explicit schema; the dataset id comes from the folder name."""
    raw = spark.read.schema(RAW_SCHEMA).csv(path)
    dataset = F.regexp_extract(F.col("_metadata.file_path"), r"dataset=(\d+)", 1).cast("long")
    return raw.select(dataset.alias("dataset"), *HISTORY_COLUMNS)


def read_history_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files or folders in list order: ``dataset`` is the place in the list, from 0."""
    read = lambda k, p: spark.read.schema(RAW_SCHEMA).csv(p).select(F.lit(k).cast("long").alias("dataset"), *HISTORY_COLUMNS)
    return reduce(DataFrame.unionByName, [read(k, p) for k, p in enumerate(paths)])


def coerce_history(raw: DataFrame) -> DataFrame:
    """Bad dates and bad numbers become null instead of failing the read."""
    num = lambda c: F.col(c).try_cast("long")
    return raw.select(
        "dataset",
        num("CITIZENID").alias("citizen_id"), num("WILAYAT_CODE").alias("area_l2"),
        F.try_to_timestamp(F.col("TIMESTAMP"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        num("AGE").alias("age"), num("SEX").alias("sex"), num("VOTE_REG_YR").alias("reg_year"),
        num("REGIONID").alias("area_l1"),
    )
