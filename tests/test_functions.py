"""Hand-made edge rows for the column functions."""

from pyspark.sql import functions as F

from turnout import constants as C
from turnout.functions import flags
from turnout.functions import percent as P
from turnout.functions import timeofday as tod
from turnout.sources import cdc


def test_live_history_summary_bins(spark):
    ages = [19, 20, 29, 30, 31, 40, 70, 71, 80, 81, 89, 90, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    rows = {r["age"]: r for r in df.select("age", *flags.age_flags("age", C.LIVE_BINS)).collect()}
    assert [rows[30][c] for c in ("col_1", "col_2")] == [0, 0]          # 30 falls in no live bin
    assert rows[31]["col_2"] == 1 and rows[81]["col_7"] == 1 and rows[90]["col_7"] == 0
    assert sum(rows[None][c] for c in ("col_1", "col_7")) == 0
    hist = {r["age"]: r for r in df.select("age", *flags.age_flags("age", C.HISTORY_BINS)).collect()}
    assert hist[30]["col_2"] == 1 and hist[90]["col_7"] == 1 and hist[19]["col_1"] == 0
    summ = {r["age"]: r for r in df.select("age", *flags.age_flags("age", C.SUMMARY_BINS, closed=True)).collect()}
    assert summ[30]["age_21_30"] == 1 and summ[20]["age_21_30"] == 0 and summ[90]["age_71_p"] == 1


def test_gender_rules(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "sex int")
    live = df.select("sex", flags.male_flag("sex").alias("m"), flags.female_flag("sex").alias("f")).collect()
    assert {(r["sex"], r["m"], r["f"]) for r in live} == {(0, 0, 0), (1, 1, 0), (2, 0, 1), (None, 0, 0)}
    hist = df.select("sex", flags.female_flag("sex", other_is_female=True).alias("f")).collect()
    assert {(r["sex"], r["f"]) for r in hist} == {(0, 1), (1, 0), (2, 1), (None, 1)}


def _ms(h, m, s):
    return ((h * 60 + m) * 60 + s) * 1000 + 999


def test_minute_rounding_carry_and_legacy(spark):
    df = spark.createDataFrame([(_ms(23, 59, 45),), (_ms(10, 59, 30),), (_ms(10, 59, 29),), (_ms(0, 0, 0),)], "ms long")
    out = df.select(tod.time_of_day(F.col("ms")).alias("t"), tod.minute_key(F.col("ms")).alias("c"),
                    tod.minute_key(F.col("ms"), carry=False).alias("n")).collect()
    got = {r["t"]: (r["c"], r["n"]) for r in out}
    assert got["23:59:45"] == ("23:59", "23:60")       # clamped inside the day / published defect
    assert got["10:59:30"] == ("11:00", "10:60")
    assert got["10:59:29"] == ("10:59", "10:59")
    assert got["00:00:00"] == ("00:00", "00:00")


def test_12_hour_labels_and_order(spark):
    df = spark.range(24).select(F.col("id").alias("h"))
    out = df.select("h", tod.hour_12h("h").alias("l")).withColumn(
        "legacy", tod.ampm_hour("l", legacy=True)).withColumn("fixed", tod.ampm_hour("l")).collect()
    by = {r["h"]: r for r in out}
    assert by[0]["l"] == "12 AM" and by[12]["l"] == "12 PM" and by[13]["l"] == "01 PM"
    assert by[12]["legacy"] == 24 and by[0]["legacy"] == 12          # published ordering defect
    assert [by[h]["fixed"] for h in range(24)] == list(range(24))


def test_rounding_modes_and_policies(spark):
    df = spark.createDataFrame([(1, 8), (5, 200), (3, 40), (7, 0), (1, None)], "n long, d long")
    out = df.select("n", "d",
                    P.percent("n", "d", P.EVEN).alias("e"),
                    P.percent("n", "d", P.UP).alias("u"),
                    P.percent("n", "d", P.EVEN, P.ZERO_ZERO).alias("z"),
                    P.percent("n", "d", P.EVEN, P.ZERO_ONE).alias("o"),
                    P.percent("n", "d", P.EVEN, P.ZERO_NULL, P.MISSING_PCT_ZERO).alias("mz"),
                    P.percent("n", "d", P.EVEN, P.ZERO_NULL, P.MISSING_DEN_ONE).alias("m1")).collect()
    r = {(x["n"], x["d"]): x for x in out}
    assert (r[(1, 8)]["e"], r[(1, 8)]["u"]) == (12, 13)       # 12.5
    assert (r[(5, 200)]["e"], r[(5, 200)]["u"]) == (2, 3)     # 2.5
    assert (r[(3, 40)]["e"], r[(3, 40)]["u"]) == (8, 8)       # 7.5 -> even is 8
    assert r[(7, 0)]["e"] is None and r[(7, 0)]["z"] == 0 and r[(7, 0)]["o"] == 1
    assert r[(1, None)]["mz"] == 0 and r[(1, None)]["m1"] == 100 and r[(1, None)]["e"] is None


def test_decode_envelopes(spark):
    good = ('{"payload":{"after":{"CITIZENID":5,"Age":33,"SEX":1,"VOTE_REG_YR":2011,"LOG_TIMESTAMP":1000,'
            '"REGIONID":1,"WILAYATID":3},"op":"c","ts_ms":1}}')
    delete = '{"payload":{"before":{"CITIZENID":5},"after":null,"op":"d","ts_ms":2}}'
    rows = [(0, 0, good), (0, 1, delete), (0, 2, "garbage"), (0, 3, None), (0, 4, good.replace('"c"', '"u"'))]
    log = spark.createDataFrame(rows, "partition int, offset long, value string").withColumn("value", F.col("value").cast("binary"))
    out = {r["offset"]: r for r in cdc.decode_cdc(log).collect()}
    assert out[0]["citizen_id"] == 5 and out[0]["area_l2"] == 3 and out[0]["op"] == "c"
    assert out[1]["citizen_id"] is None and out[1]["op"] == "d"
    assert out[2]["citizen_id"] is None and out[3]["citizen_id"] is None
    assert out[4]["op"] == "u" and out[4]["age"] == 33          # an update is one more ballot


def test_offset_range(spark):
    log = spark.createDataFrame([(p, o) for p in (0, 1) for o in range(10)], "partition int, offset long")
    got = cdc.offset_range(log, {0: 3, 1: 0}, {0: 5, 1: 2}).collect()
    assert sorted((r["partition"], r["offset"]) for r in got) == [(0, 3), (0, 4), (1, 0), (1, 1)]


def test_names_lookup_and_cleaning(spark):
    from turnout.sources.dims import clean_name, with_area_name
    names = spark.createDataFrame([("l1", 6, "Inner\u200b Region\ufeff "), ("l2", 3, "Town")], "level string, area_id long, area_name string")
    names = names.withColumn("area_name", clean_name(F.col("area_name")))
    rows = spark.createDataFrame([("l1", 6), ("l2", 3), ("l2", 99)], "level string, area_id long")
    got = {(r["level"], r["area_id"]): r["area_name"] for r in with_area_name(rows, names).collect()}
    assert got == {("l1", 6): "Inner Region", ("l2", 3): "Town", ("l2", 99): "99"}


def test_strict_lookup_raises_on_unknown_area(spark):
    import pytest
    from tests.conftest import MEDIUM
    from turnout.plans.live import area_lookup_strict
    ok = area_lookup_strict(spark, MEDIUM)
    assert 24 not in {r["area_id"] for r in ok.collect()}           # area 24 has no registered row
    strict = area_lookup_strict(spark, MEDIUM, raise_on_unknown=True)
    with pytest.raises(Exception, match="no registered voters: area_id 24"):  # the query fails, not its making
        strict.collect()
