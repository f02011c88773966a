from collections import Counter

from pyspark.sql import functions as F

from tidewire.llm.common import skewed_join


def test_skewed_join_equals_a_plain_join(spark):
    """A hot key and many null keys; right rows repeat."""
    keys = ["hot"] * 300 + ["a", "b", "b"] + [None] * 200
    left = spark.createDataFrame(list(enumerate(keys)), "i int, k string").repartition(5)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("b", 3), ("c", 4), (None, 5)], "k string, v int")
    for how in ("inner", "left"):
        got = skewed_join(left, right, ["k"], how, floor=10)
        want = left.join(right, "k", how)
        assert Counter(got.select("i", "k", "v").collect()) == Counter(want.select("i", "k", "v").collect())
    assert skewed_join(left.limit(0), right, ["k"], "left").count() == 0


def test_hot_keys_are_dealt_to_many_parts(spark):
    left = spark.range(5000).select("id", F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    plan = skewed_join(left, right, ["k"], "inner", floor=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and "Cartesian" not in plan
    assert skewed_join(left, right, ["k"], "inner", floor=100).count() == 5000
