"""Bucketed lookups against brute force, with gaps, ties, keys and a hot key."""

import datetime as dt
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidewire.operators.ordered import DAY, SECOND, as_of, lag_by, trailing
from tidewire.operators.topn import top_n

START = dt.datetime(2024, 1, 1)
relaxed = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def ticks(spark, n, seed, keys=("a", "b"), spread_days=9):
    rng = random.Random(seed)
    seen, rows = set(), []
    for i in range(n):
        # Two thirds of the rows of one key fall into one minute.
        hot = rng.random() < 0.6
        key = keys[0] if hot else rng.choice(keys)
        offset = 3600.5 + rng.random() * 50 if hot else rng.random() * 86400 * spread_days
        at = START + dt.timedelta(microseconds=int(offset * 1e6))
        if (key, at) not in seen:
            seen.add((key, at))
            rows.append((i, key, at, None if rng.random() < 0.1 else rng.random()))
    return spark.createDataFrame(rows, "id int, k string, at timestamp, v double")


@given(seed=st.integers(0, 10**6), n=st.integers(1, 200), keyed=st.booleans())
@relaxed
def test_lag_equals_plain_lag(spark, seed, n, keyed):
    df = ticks(spark, n, seed, keys=("a", "b") if keyed else ("a",))
    keys = ["k"] if keyed else []
    plain = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("at")
    expected = df.withColumn("p", F.lag("v").over(plain))
    for span in (SECOND, DAY, 60 * SECOND, 1000):
        got = lag_by(df, keys, "at", {"v": "p"}, span)
        assert rows_of(got) == rows_of(expected)


def test_lag_keeps_rows_without_time(spark):
    df = spark.createDataFrame(
        [("a", START, 1.0), ("a", None, 2.0), ("a", None, 3.0), ("a", START + dt.timedelta(days=40), 4.0)],
        "k string, at timestamp, v double",
    )
    got = lag_by(df, ["k"], "at", {"v": "p"})
    assert sorted((r.v, r.p) for r in got.collect() if r.p is not None) == [(4.0, 1.0)]
    assert got.count() == 4


def brute_as_of(left, right, by):
    out = []
    for row in left:
        best = None
        for other in right:
            if by and other["k"] != row["k"] or row["at"] is None or other["at"] > row["at"]:
                continue
            if best is None or (other["at"], other["id"]) > (best["at"], best["id"]):
                best = other
        out.append((row["id"], best["id"] if best else None, best["v"] if best else None))
    return sorted(out)


@given(seed=st.integers(0, 10**6), keyed=st.booleans(), span=st.sampled_from([SECOND, 60 * SECOND, DAY]))
@relaxed
def test_as_of_equals_brute_force(spark, seed, keyed, span):
    rng = random.Random(seed)
    instants = [START + dt.timedelta(minutes=rng.choice([0, 1, 2, 700, 5000, 20000, 20001])) for _ in range(60)]
    right = [(i, rng.choice("ab"), at, rng.random()) for i, at in enumerate(instants[:30])]
    left = [(i, rng.choice("abc"), at, 0.0) for i, at in enumerate(instants[30:])] + [(99, "a", None, 0.0)]
    shape = "id int, k string, at timestamp, v double"
    left_df = spark.createDataFrame(left, shape)
    right_df = spark.createDataFrame(right, shape).withColumnRenamed("at", "seen")
    got = as_of(
        left_df.select("id", "k", "at"), right_df, "at", "seen", {"id": "tick", "v": "price"},
        ties=["id"], by=["k"] if keyed else [], span=span,
    )
    expected = brute_as_of(left_df.collect(), spark.createDataFrame(right, shape).collect(), keyed)
    assert sorted((r.id, r.tick, r.price) for r in got.collect()) == expected


def test_no_task_gets_a_whole_key(spark):
    """With no key, only rows counted by day meet in a single partition."""
    df = ticks(spark, 50, 1)
    keyed = lag_by(df, ["k"], "at", {"v": "p"})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in keyed
    lines = lag_by(df, [], "at", {"v": "p"})._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    below = [" ".join(lines[i + 1 : i + 6]) for i in single]
    assert single and all("HashAggregate" in part and "_day" in part for part in below)


def executed(df):
    """The plan that ran; the initial plans that stand beside it are left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"== Initial Plan ==.*?(== Final Plan ==|$)", "", plan, flags=re.S)


def test_inputs_are_read_once(spark, sf_dir):
    """Lookups and what they carry share one shuffle of the rows, and nothing is broadcast by hint."""
    from tidewire.catalog import inputs
    from tidewire.plans.speed import price_changes

    ticks = inputs.ticks(spark, sf_dir)
    plan = executed(price_changes(ticks, ["symbol"]))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 1
    asked = inputs.ticks(spark, sf_dir).select("tick_id", F.col("last_updated").alias("created_utc"))
    found = as_of(asked, ticks, "created_utc", "last_updated", {"price_usd": "p"}, ["tick_id"])
    assert "ResolvedHint" not in found._jdf.queryExecution().analyzed().toString()
    assert executed(found).count("FileScan") == 2  # one for each side


def test_hot_second_and_hot_instant(spark):
    """A third of all rows in one second of one key, a third of all questions at one instant."""
    from tidewire.operators import ordered

    n = 6000
    micros = F.when(F.col("id") % 3 == 0, F.col("id") * 100).otherwise(F.col("id") * 7_000_000)
    facts = spark.range(n, numPartitions=12).select(
        "id", F.lit("a").alias("k"), F.timestamp_micros(F.lit(1_704_067_200_000_000) + micros).alias("at"), F.rand(1).alias("v")
    )
    plain = Window.partitionBy("k").orderBy("at")
    expected = facts.withColumn("p", F.lag("v").over(plain))
    assert rows_of(lag_by(facts, ["k"], "at", {"v": "p"})) == rows_of(expected)

    hot = F.when(F.col("id") % 3 == 0, F.lit(1_704_067_200_000_000 + 9)).otherwise(
        F.lit(1_704_067_200_000_000) + F.col("id") * 5_000_000
    )
    asked = spark.range(n, numPartitions=48).select("id", F.lit("a").alias("k"), F.timestamp_micros(hot).alias("at"))
    got = as_of(asked, facts.withColumnRenamed("id", "fact"), "at", "at", {"fact": "fact"}, ["fact"], by=["k"])
    assert got.filter("id % 3 = 0").select("fact").distinct().count() == 1
    assert got.count() == n
    # The questions of the hot instant are dealt to SPREAD groups; none has a third of all.
    part = F.pmod(F.spark_partition_id(), F.lit(ordered.SPREAD))
    groups = asked.groupBy("at", part.alias("part")).count().agg(F.max("count")).first()[0]
    print(f"largest group of one instant: {groups} of {n} rows")
    assert groups <= n / 3 / ordered.SPREAD * 1.5


@pytest.mark.parametrize("spread", [None, 3])
def test_top_n(spark, spread):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("g"), F.hash("id").alias("x")).repartition(7)
    got = top_n(df, ["g"], [F.col("x").desc(), F.col("id")], 5, spread=spread)
    plain = Window.partitionBy("g").orderBy(F.col("x").desc(), F.col("id"))
    expected = df.withColumn("rank", F.row_number().over(plain)).filter("rank <= 5")
    assert rows_of(got.select(*expected.columns)) == rows_of(expected)


def brute_trailing(left, right, keyed, seconds):
    out = []
    for row in left:
        if row["at"] is None or keyed and row["k"] is None:
            out.append((row["id"], None, None))
            continue
        first = row["at"] - dt.timedelta(seconds=seconds)
        near = [r for r in right if r["seen"] and first <= r["seen"] <= row["at"] and (not keyed or r["k"] == row["k"])]
        values = [r["v"] for r in near if r["v"] is not None]
        out.append((row["id"], len(near), sum(values) if values else None))
    return sorted(out)


@given(seed=st.integers(0, 10**6), keyed=st.booleans(), hot=st.sampled_from([3, 100_000]))
@relaxed
def test_trailing_equals_brute_force(spark, seed, keyed, hot):
    """Ties, both ends of the range, a crowded minute that is split, gaps of days, NULLs."""
    rng = random.Random(seed)

    def instant():
        kind = rng.random()
        if kind < 0.05:
            return None
        if kind < 0.6:
            return START + dt.timedelta(seconds=rng.randrange(0, 60), microseconds=rng.choice([0, 1, 999_999]))
        return START + dt.timedelta(minutes=rng.choice([0, 1, 4, 5, 6, 1439, 1440, 20_000]), seconds=rng.choice([0, 30]))

    keys = ["a", "b", None]
    right = [(rng.choice(keys), instant(), rng.choice([None, 1, -2, 30])) for _ in range(60)]
    left = [(i, rng.choice([*keys, "c"]), instant()) for i in range(60)]
    right_df = spark.createDataFrame(right, "k string, seen timestamp, v bigint").repartition(3)
    left_df = spark.createDataFrame(left, "id int, k string, at timestamp").repartition(3)
    seconds = rng.choice([0, 1, 300, 90_000])
    by = ["k"] if keyed else []
    got = trailing(left_df, right_df, "at", "seen", seconds, "n", {"v": "total"}, by=by, hot=hot)
    expected = brute_trailing(left_df.collect(), right_df.collect(), keyed, seconds)
    assert sorted((r.id, r.n, r.total) for r in got.collect()) == expected


def test_trailing_over_nothing(spark):
    left = spark.createDataFrame([(1, START)], "id int, at timestamp")
    right = spark.createDataFrame([], "seen timestamp")
    assert [tuple(r) for r in trailing(left, right, "at", "seen", 5, "n").collect()] == [(1, START, 0)]
    assert trailing(left.limit(0), right, "at", "seen", 5, "n").count() == 0


def test_trailing_of_a_hot_instant_and_minute(spark):
    """Very many rows at one instant on both sides are added up before they meet."""
    left = spark.range(4000).select("id", F.lit(START).alias("at"))
    seen = F.timestamp_micros(F.unix_micros(F.lit(START)) - F.col("id") % 7)
    got = trailing(left, spark.range(5000).select(seen.alias("seen")), "at", "seen", 60, "n", hot=2)
    assert got.groupBy("n").count().collect() == [(5000, 4000)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
