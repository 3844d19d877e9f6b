"""A repeated hash that doesn't fit as a whole does not keep the mix from what is behind it."""

from pyspark.sql import functions as F

from quire.llm import mixing


def test_mix_goes_on_behind_a_repeated_hash(spark):
    rows = [(i, "s", 10, i * 10) for i in range(70)] + [(None, "s", 10, 255)] * 30
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, h long")
    goals = spark.createDataFrame([("s", 1000, 450.0, 0, 450.0)], "source string, source_size long, target double, copies long, budget double")
    own = mixing.thresholds(sized, goals).withColumnRenamed("source", "_s")
    taken = sized.join(own, F.col("source") == F.col("_s")).withColumn("times", mixing._times()).filter("times > 0")
    assert taken.agg(F.sum("size")).first()[0] == 450
    assert taken.filter("h = 255").count() == 0
