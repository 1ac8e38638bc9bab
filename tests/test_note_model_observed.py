"""A classifier of two categories in a session that has observed a query."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from carelake.plans import note_model as M


def test_two_categories_after_an_observed_query(spark):
    spark.range(3).observe(seen := Observation(), F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    two = M.train_note_model(spark.createDataFrame([("late", "TIMELY_FILING"), ("twice", "DUPLICATE_CLAIM")], "note string, category string"))
    got = M.classify_by_model(spark.createDataFrame([("Twice!",)], "note string"), two).collect()
    assert [r.category for r in got] == ["DUPLICATE_CLAIM"]
