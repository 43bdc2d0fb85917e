"""Proof views: ballots, CDC log, registered voters, predictions and history derived from the
driver's tables by fixed rules, so Spark results can be checked against an independent SQL oracle.

Every view reads whole tables; the only joins are key lookups (citizen -> area), and the only
aggregates group by area, so all views grow with the data.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import flags
from turnout.sources.tables import read_table

# area whose registered row is left out, and area whose female count is zero
MISSING_L2 = 24
ZERO_FEMALE_L2 = 3
# area that the prediction table lacks (the seed adds it), area whose minutes end early (its steps are
# padded), and area that gets no forecast (the upsert leaves its row)
UNPREDICTED_L2 = 13
SPARSE_L2, SPARSE_UNTIL = 5, "00:20"
NO_FORECAST_L2 = 7
REGISTERED_FACTOR = 20
PREDICTION_BASE = "2024-01-31 00:00:00"

_MEMO: dict = {}
_STAMPS: dict = {}


def memo(fn):
    """Build a view once per session and data directory; every registered query and every micro-batch starts with
    ``refresh``, which drops the views of tables whose files have changed."""
    @wraps(fn)
    def wrapper(spark: SparkSession, data_dir: str) -> DataFrame:
        key = (fn.__name__, session_key(spark), data_dir)
        if key not in _MEMO:
            _MEMO[key] = fn(spark, data_dir)
        return _MEMO[key]
    return wrapper


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: a stopped and recreated session never reuses cached plans."""
    return id(spark), spark.sparkContext.applicationId


def clear_memo() -> None:
    _MEMO.clear()
    _STAMPS.clear()


def refresh(spark: SparkSession, data_dir: str) -> None:
    """Forget the views of ``data_dir`` if a table they read has another size or modification time than before."""
    jvm = spark.sparkContext._jvm
    tables = jvm.org.apache.hadoop.fs.Path(f"{data_dir.rstrip('/')}/{{customer,events,nation,region}}.parquet")
    fs = tables.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stamp = []
    for status in fs.globStatus(tables) or []:
        files = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        stamp += [(f.getPath().toString(), f.getModificationTime(), f.getLen()) for f in files]
    key = session_key(spark), data_dir
    if _STAMPS.get(key) != stamp:
        for view in [k for k in _MEMO if k[1:] == key]:
            del _MEMO[view]
        _STAMPS[key] = stamp


@memo
def citizen_areas(spark: SparkSession, data_dir: str) -> DataFrame:
    """citizen -> (area_l1, area_l2)."""
    cust = read_table(spark, data_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, data_dir, "nation", ["n_nationkey", "n_regionkey"])
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("citizen_id"),
        F.col("n_regionkey").cast("long").alias("area_l1"),
        F.col("n_nationkey").cast("long").alias("area_l2"),
    )


@memo
def ballot_events(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ballot attributes derived from the event row alone (no lookup): everything but the areas."""
    ev = read_table(spark, data_dir, "events", ["event_id", "ts", "user_id"])
    years = ", ".join(f"{y}L" for y in C.REG_YEARS)
    return ev.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "CAST(CASE WHEN event_id % 61 = 0 THEN NULL ELSE 18 + event_id % 80 END AS BIGINT) AS age",
        "CAST(CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 0 "
        "ELSE 1 + (event_id DIV 7) % 2 END AS BIGINT) AS sex",
        f"element_at(array({years}), CAST(event_id % 10 + 1 AS INT)) AS reg_year",
        "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS log_ms",
    )


@memo
def ballots(spark: SparkSession, data_dir: str) -> DataFrame:
    """One ballot per event, with its areas.

    The citizen lookup is a plain equi-join: Spark broadcasts the citizen side only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges,
    with AQE splitting a skewed (hot citizen) partition.  Area-level summaries do not use this
    row-level join at all (see ``operators.aggregate.summaries_eager``).
    """
    ev = ballot_events(spark, data_dir)
    areas = citizen_areas(spark, data_dir)
    return ev.join(areas, ev.user_id == areas.citizen_id).select(
        "event_id", "ts", "citizen_id", "age", "sex", "reg_year", "log_ms", "area_l1", "area_l2")


@memo
def early_ballots(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ballots of a poll in which one area falls silent early (its steps are padded): area 5 until 00:20."""
    from turnout.functions.timeofday import minute_key
    b = ballots(spark, data_dir)
    return b.filter((F.col("area_l2") != SPARSE_L2) | (minute_key(b.log_ms) < SPARSE_UNTIL))


@memo
def forecast_ballots(spark: SparkSession, data_dir: str) -> DataFrame:
    """As ``early_ballots``, from a poll without a ballot of one area (the upsert leaves its row): area 7."""
    return early_ballots(spark, data_dir).filter(F.col("area_l2") != NO_FORECAST_L2)


def _after_struct(b) -> "F.Column":
    return F.struct(
        b.citizen_id.alias("CITIZENID"), b.age.alias("Age"), b.sex.alias("SEX"),
        b.reg_year.alias("VOTE_REG_YR"), b.log_ms.alias("LOG_TIMESTAMP"),
        b.area_l1.alias("REGIONID"), b.area_l2.alias("WILAYATID"))


@memo
def cdc_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """Change log of ballots in the Kafka record shape: (topic, partition, offset, value BINARY, timestamp).

    op 'd' when event_id % 97 = 0 (after null, before set), 'u' when % 89 = 0, the text
    ``garbage`` when % 101 = 0 and a null value when % 103 = 0; the later rule wins.
    """
    b = ballots(spark, data_dir)
    eid = b.event_id
    after = _after_struct(b)
    op = F.when(eid % 89 == 0, "u").when(eid % 97 == 0, "d").otherwise("c")
    envelope = F.struct(
        F.lit(None).cast("string").alias("schema"),
        F.struct(
            F.when(op != "c", after).alias("before"),
            F.when(op != "d", after).alias("after"),
            F.struct(F.lit("2.0").alias("version"), F.lit("sqlserver").alias("connector"),
                     F.lit("server1").alias("name"), b.log_ms.alias("ts_ms"),
                     F.lit("ballots").alias("table"), eid.alias("event_serial_no")).alias("source"),
            op.alias("op"),
            b.log_ms.alias("ts_ms"),
        ).alias("payload"),
    )
    value = (F.when(eid % 103 == 0, F.lit(None).cast("string"))
              .when(eid % 101 == 0, F.lit("garbage"))
              .otherwise(F.to_json(envelope)))
    return b.select(
        F.lit("server1.votes.dbo.ballots").alias("topic"),
        F.lit(0).alias("partition"),
        eid.alias("offset"),
        value.cast("binary").alias("value"),
        F.timestamp_millis(b.log_ms).alias("timestamp"),
    )


# offsets that a log with losses lacks: HOLE of every HOLE_EVERY, from the phase on; and which offsets it has twice
HOLE_EVERY, HOLE, HOLE_PHASE, REPEAT_EVERY = 500, 7, 123, 13


@memo
def cdc_raw_holed(spark: SparkSession, data_dir: str) -> DataFrame:
    """The change log with holes (7 offsets in every 500) and repeats (every 13th offset twice)."""
    raw = cdc_raw(spark, data_dir)
    kept = raw.filter((F.col("offset") + HOLE_PHASE) % HOLE_EVERY >= HOLE)
    return kept.unionByName(kept.filter(F.col("offset") % REPEAT_EVERY == 0))


# parts in which a delayed log arrives, days in each, and after how long a row counts as late
DELAYED_PARTS, PART_DAYS, DELAY_EVERY, LATE_AFTER_MS = 5, 8, 11, 2 * 86_400_000


@memo
def cdc_raw_delayed(spark: SparkSession, data_dir: str) -> DataFrame:
    """The change log with the ``part`` in which a message arrives: eight days of the month each, every 11th one part later."""
    day = F.dayofmonth(F.col("timestamp").cast("timestamp_ntz"))
    part = F.floor((day - 1) / PART_DAYS) + F.when(F.col("offset") % DELAY_EVERY == 0, 1).otherwise(0)
    return cdc_raw(spark, data_dir).withColumn("part", part.cast("int"))


@memo
def ballot_ages(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ballots per single year of age: (age, n).

    Ages come from the event row, so events are counted per (citizen, age) first and only then
    checked against the citizen table (a semi join: a ballot needs a known citizen).
    """
    per = ballot_events(spark, data_dir).filter("age IS NOT NULL").groupBy("user_id", "age").agg(F.count("*").alias("n"))
    known = citizen_areas(spark, data_dir).select(F.col("citizen_id").alias("user_id"))
    return per.join(known, "user_id", "left_semi").groupBy("age").agg(F.sum("n").cast("long").alias("n"))


# ---- registered voters ---------------------------------------------------------------------

@memo
def registered_l2_full(spark: SparkSession, data_dir: str) -> DataFrame:
    """Registered counts per area_l2 from citizens: sex by custkey parity, single age
    18 + custkey % 80, registration year by custkey % 10, all times 20."""
    cust = read_table(spark, data_dir, "customer", ["c_custkey", "c_nationkey"])
    f = REGISTERED_FACTOR
    cnt = lambda cond, name: F.expr(f"CAST({f} * count_if({cond}) AS BIGINT) AS {name}")
    aggs = [F.expr(f"CAST({f} * count(*) AS BIGINT) AS voters"),
            cnt("c_custkey % 2 = 0", "male_count"), cnt("c_custkey % 2 = 1", "female_count")]
    aggs += [cnt(f"(18 + c_custkey % 80) >= {lo}" + (f" AND (18 + c_custkey % 80) <= {hi}" if hi else ""), name)
             for name, lo, hi in C.SUMMARY_BINS]
    aggs += [cnt(f"c_custkey % 10 = {i}", f"ry_{y}") for i, y in enumerate(C.REG_YEARS)]
    return cust.groupBy(F.col("c_nationkey").cast("long").alias("area_id")).agg(*aggs)


@memo
def registered_l2(spark: SparkSession, data_dir: str) -> DataFrame:
    """As ``registered_l2_full`` with one area missing and one zero female count."""
    full = registered_l2_full(spark, data_dir)
    return (full.filter(F.col("area_id") != MISSING_L2)
                .withColumn("female_count", F.when(F.col("area_id") == ZERO_FEMALE_L2, F.lit(0).cast("long"))
                            .otherwise(F.col("female_count"))))


def _measure_sums(df: DataFrame, by: list) -> DataFrame:
    measures = [c for c in df.columns if c != "area_id"]
    aggs = [F.expr(f"CAST(sum({c}) AS BIGINT) AS {c}") for c in measures]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


@memo
def registered_l1(spark: SparkSession, data_dir: str) -> DataFrame:
    full = registered_l2_full(spark, data_dir)
    nation = read_table(spark, data_dir, "nation", ["n_nationkey", "n_regionkey"])
    j = full.join(nation, full.area_id == nation.n_nationkey).drop("n_nationkey")
    return _measure_sums(j.drop("area_id").withColumnRenamed("n_regionkey", "area_id")
                         .withColumn("area_id", F.col("area_id").cast("long")), ["area_id"])


@memo
def registered_nat(spark: SparkSession, data_dir: str) -> DataFrame:
    full = registered_l2_full(spark, data_dir)
    return _measure_sums(full, []).withColumn("area_id", F.lit(0).cast("long"))


@memo
def registered_single_ages(spark: SparkSession, data_dir: str) -> DataFrame:
    """Nation-level registered voters per single year of age: (age, n)."""
    cust = read_table(spark, data_dir, "customer", ["c_custkey"])
    return (cust.groupBy((18 + F.col("c_custkey") % 80).cast("long").alias("age"))
                .agg((F.count("*") * F.lit(REGISTERED_FACTOR)).cast("long").alias("n")))


# ---- prediction table and history --------------------------------------------------------

@memo
def prediction(spark: SparkSession, data_dir: str) -> DataFrame:
    """One forecast row per (area_l1, area_l2) but one: slot at 08:00-11:00 of two days by area, so that a
    region has several slots and an hour occurs on both days; counters = 2 x ballot sums in the
    history age classes folded to six.

    Counters come from the event row, so they are summed per citizen before the area lookup.
    """
    ev = ballot_events(spark, data_dir)
    folded = [("col_1", 20, 30), ("col_2", 30, 40), ("col_3", 40, 50), ("col_4", 50, 60),
              ("col_5", 60, 70), ("col_6", 70, None)]
    flags_sql = ([f"{flags.male_sql('sex')} AS male", f"{flags.female_sql('sex')} AS female"]
                 + [f"{flags.in_bin_sql('age', lo, hi)} AS {n}" for n, lo, hi in folded])
    rows = ev.selectExpr("user_id", *flags_sql)
    per = rows.groupBy("user_id").agg(*[F.expr(f"sum({c}) AS {c}") for c in C.PREDICTION_COUNTERS])
    areas = citizen_areas(spark, data_dir)
    j = per.join(areas, per.user_id == areas.citizen_id)
    p = j.groupBy("area_l1", "area_l2").agg(*[F.expr(f"CAST(2 * sum({c}) AS BIGINT) AS {c}") for c in C.PREDICTION_COUNTERS])
    slot = (F.lit(PREDICTION_BASE).cast("timestamp_ntz")
            + F.make_dt_interval(days=(F.col("area_l2") % 3 == 0).cast("int"), hours=(8 + F.col("area_l2") % 4).cast("int")))
    return p.filter(F.col("area_l2") != UNPREDICTED_L2).select("area_l1", "area_l2", slot.alias("time_slot"), *C.PREDICTION_COUNTERS)


@memo
def history(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ballots with dataset = day(ts) % 3, times cut to the minute, polling hours kept."""
    from turnout.functions.timeofday import truncated_minute_key
    b = ballots(spark, data_dir)
    t = truncated_minute_key(b.log_ms)
    return (b.withColumn("dataset", (F.dayofmonth("ts") % 3).cast("long"))
             .withColumn("time", t)
             .filter(F.col("time").between(C.POLL_START, C.POLL_END)))
