"""Area dimensions (S6, J10), registered-voter documents (S5) and folds over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout import constants as C
from turnout.sources.tables import read_table

# zero-width space, non-joiner, joiner and byte-order mark
_ZERO_WIDTH = "[\u200b\u200c\u200d\ufeff]"


def clean_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _ZERO_WIDTH, ""))


def area_dim(spark: SparkSession, data_dir: str) -> DataFrame:
    """Two-level hierarchy with names: (area_l1, l1_name, area_l2, l2_name)."""
    nation = read_table(spark, data_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, data_dir, "region", ["r_regionkey", "r_name"])
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_regionkey").cast("long").alias("area_l1"),
        clean_name(F.col("r_name")).alias("l1_name"),
        F.col("n_nationkey").cast("long").alias("area_l2"),
        clean_name(F.col("n_name")).alias("l2_name"),
    )


def area_names(dim: DataFrame) -> DataFrame:
    """Long name table (level, area_id, area_name) over both levels."""
    l1 = dim.select(F.lit(C.LEVEL_L1).alias("level"), F.col("area_l1").alias("area_id"),
                    F.col("l1_name").alias("area_name")).distinct()
    l2 = dim.select(F.lit(C.LEVEL_L2).alias("level"), F.col("area_l2").alias("area_id"),
                    F.col("l2_name").alias("area_name"))
    return l1.unionByName(l2)


def with_area_name(df: DataFrame, names: DataFrame, level_col: str = "level", id_col: str = "area_id",
                   out: str = "area_name") -> DataFrame:
    """Left lookup of a display name; an unknown id shows as its own text."""
    n = names.selectExpr("level AS _nl", "area_id AS _ni", "area_name AS _nn")
    j = df.join(n, (df[level_col] == n["_nl"]) & (df[id_col] == n["_ni"]), "left")
    return j.withColumn(out, F.expr(f"coalesce(_nn, CAST({id_col} AS STRING))")).drop("_nl", "_ni", "_nn")


# ---- registered voters -------------------------------------------------------------------

def registered_measures() -> list[str]:
    return (["voters", "male_count", "female_count"] + [b[0] for b in C.SUMMARY_BINS]
            + [f"ry_{y}" for y in C.REG_YEARS])


# registered-voter documents (wire format, fixed values): the field that holds a level's areas, the name of
# their id (the nation has none), and the names of their counts
DOC_FIELDS = {C.LEVEL_NATION: ("Oman", None), C.LEVEL_L1: ("allRegion", "RegionId"), C.LEVEL_L2: ("allWilayat", "wilayat")}


def document_names() -> dict[str, str]:
    """Measure -> its name in the documents."""
    names = {"voters": "CountOfVoters", "male_count": "MaleCount", "female_count": "FemaleCount"}
    names |= {n: f"AgeCount{lo}to{hi}" if hi else f"AgeCountAbove{lo - 1}" for n, lo, hi in C.SUMMARY_BINS}
    return names | {f"ry_{y}": f"RegisteredYear{y}" for y in C.REG_YEARS}


def registered_doc_schema(level: str) -> T.StructType:
    field, id_name = DOC_FIELDS[level]
    names = ([id_name] if id_name else []) + list(document_names().values())
    return T.StructType([T.StructField(field, T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in names])))])


def write_registered_doc(reg: DataFrame, path: str, level: str = C.LEVEL_L2, areas_per_doc: int = 1000) -> None:
    """Registered counts of one level as documents, one JSON line each, of about ``areas_per_doc`` areas at
    most, so that reading them splits by line."""
    field, id_name = DOC_FIELDS[level]
    ids = [F.col("area_id").alias(id_name)] if id_name else []
    area = F.struct(*ids, *[F.col(m).alias(n) for m, n in document_names().items()])
    docs = reg.groupBy(F.expr(f"area_id DIV {areas_per_doc}")).agg(F.sort_array(F.collect_list(area)).alias(field))
    docs.select(field).write.mode("overwrite").json(path)


def read_registered(spark: SparkSession, path: str, level: str = C.LEVEL_L2, multi_line: bool = False) -> DataFrame:
    """Reference documents of a level -> (area_id, counts); explicit schema, no inference, a count that a
    document lacks is null.  Documents are JSON lines, or with ``multi_line`` one document per file."""
    field, id_name = DOC_FIELDS[level]
    doc = spark.read.schema(registered_doc_schema(level)).option("multiLine", multi_line).json(path)
    areas = doc.select(F.inline(field))
    area_id = F.col(id_name) if id_name else F.lit(0).cast("long")
    return areas.select(area_id.alias("area_id"), *[F.col(n).alias(m) for m, n in document_names().items()])


def area_table(spark: SparkSession, rows: list[tuple[int, str, int, str]]) -> DataFrame:
    """An area dimension from given (area_l1, l1_name, area_l2, l2_name) rows; names are cleaned."""
    df = spark.createDataFrame(rows, "area_l1 long, l1_name string, area_l2 long, l2_name string")
    return df.withColumns({c: clean_name(F.col(c)) for c in ("l1_name", "l2_name")})
