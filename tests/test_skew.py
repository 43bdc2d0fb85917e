"""A citizen holding a third of all events: summaries stay exact and the hot key is combined
map-side before any join or shuffle of ballots."""

from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from turnout.operators.aggregate import summaries, summaries_eager
from turnout.sources import proof_views as pv


def test_hot_citizen_summaries(spark):
    events = pv.ballot_events(spark, MEDIUM).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    cit = pv.citizen_areas(spark, MEDIUM)
    ballots = events.join(cit, events.user_id == cit.citizen_id).drop("user_id")
    eager = summaries_eager(events, cit)
    plain = summaries(ballots)
    key = ["level", "area_id", "area_l1", "area_l2", "hour"]
    cols = key + ["total", "male", "female", "age_71_p", "ry_2023"]
    assert sorted(map(tuple, eager.select(*cols).collect())) == sorted(map(tuple, plain.select(*cols).collect()))
    plan = eager._jdf.queryExecution().executedPlan().toString()
    first_join = plan.find("Join")
    assert "partial_sum" in plan[first_join:]                     # events are combined below the join
    hot = eager.filter("level = 'nation'").first()["total"]
    assert hot == events.count()
