"""Window states that batches add to: daily rows, corrections, newest rows, published days."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidewire import jobs
from tidewire.catalog import inputs
from tidewire.operators import messages as M
from tidewire.operators.topn import top_n
from tidewire.plans import daily, speed as batch_speed
from tidewire.plans import states as plans
from tidewire.schemas import POST_TOPIC, TICK_TOPIC, create_tables, refresh_tables
from tidewire.session import stream_session
from tidewire.streaming import newest, run, serving, states

START = dt.datetime(2024, 1, 10)
TIMED = "kind string, symbol string, at timestamp, price_usd double, sentiment struct<bullish double, bearish double, neutral double>"


def timed_rows(n, seed, days=4):
    rng, rows = random.Random(seed), []
    for i in range(n):
        at = START + dt.timedelta(seconds=i * 86400 * days // n, microseconds=i)
        if rng.random() < 0.6:
            rows.append(("tick", rng.choice("AB"), at, rng.choice([None, float(rng.randrange(100))]), None))
        else:
            rows.append(("post", None, at, None, None if rng.random() < 0.1 else tuple(rng.random() for _ in range(3))))
    return rows


def batch_daily(spark, rows):
    frame = spark.createDataFrame(rows, TIMED)
    ticks = frame.filter("kind = 'tick'").select("symbol", F.col("at").alias("last_updated"), "price_usd")
    posts = frame.filter("kind = 'post'").select(F.col("at").alias("created_utc"), "sentiment")
    speed = batch_speed.join_posts(batch_speed.latest_ticks(ticks), batch_speed.post_windows(posts))
    return speed, daily.daily_rows(speed)


def rounded(df):
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return rows_of(df.withColumns({name: F.round(name, 9) for name in doubles}).select(sorted(df.columns)))


def test_states_of_parts_merge_to_those_of_the_whole(spark):
    rows = timed_rows(400, 1)
    parts = [spark.createDataFrame(rows[i::3], TIMED) for i in range(3)]
    split = plans.window_states(parts[0])
    for part in parts[1:]:
        split = split.unionByName(plans.window_states(part))
    whole = plans.merged(plans.window_states(spark.createDataFrame(rows, TIMED)))
    assert rounded(plans.merged(split)) == rounded(whole)
    assert rounded(plans.speed_of(whole)) == rounded(batch_daily(spark, rows)[0])


def test_daily_rows_follow_every_batch(spark, tmp_path):
    """After each batch the view is the batch result; late rows, repeats and a compaction included."""
    rows, folder = timed_rows(600, 2, days=8), str(tmp_path)
    batches = [rows[:200], rows[200:500], rows[500:590], [], rows[590:]]
    # Rows of an early day come with the last batch.
    batches[-1] += batches[0][50:60]
    batches[0] = batches[0][:50] + batches[0][60:]
    seen = []
    for batch_id, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, TIMED)
        days = states.add_batch(frame, batch_id, folder)
        assert days == sorted({row[2].date() for row in batch})
        if batch_id == 1:  # it fails after the write and runs again
            assert states.add_batch(frame, batch_id, folder) == days
        if batch_id == 2:
            for _ in range(2):
                states.compact(spark, f"{folder}/states", F.lit(True))
        seen += batch
        assert rounded(states.daily_view(spark, folder)) == rounded(batch_daily(spark, seen)[1])
    compacted = spark.read.parquet(f"{folder}/states").filter("part = 'days'").count()
    assert 0 < compacted < len(seen)


def test_a_batch_reads_its_own_days_only(spark, tmp_path):
    rows, folder = timed_rows(200, 3, days=5), str(tmp_path)
    states.add_batch(spark.createDataFrame(rows, TIMED), 0, folder)
    day = START.date() + dt.timedelta(days=2)
    plan = states.days_of(spark, f"{folder}/states", [day])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters" in line and str(day) in line or "event_day" in line for line in scans)
    before = {f: f for f in spark.read.parquet(f"{folder}/days").inputFiles()}
    late = [("tick", "A", dt.datetime.combine(day, dt.time(23, 59)), 7.0, None)]
    assert states.add_batch(spark.createDataFrame(late, TIMED), 1, folder) == [day]
    after = spark.read.parquet(f"{folder}/days").inputFiles()
    # Files of the other days are untouched.
    assert {f for f in before if str(day) not in f} == {f for f in after if str(day) not in f}
    assert rounded(states.daily_view(spark, folder)) == rounded(batch_daily(spark, rows + late)[1])


def test_late_rows_become_corrections(spark, tmp_path):
    folder = str(tmp_path)
    write = states.late_writer(folder, delay_minutes=10)

    def minute(m, price):
        return ("tick", "A", START + dt.timedelta(minutes=m), float(price), None)

    batches = [[minute(0, 1), minute(30, 2)], [minute(21, 3), minute(19, 4), minute(60, 5)], [minute(52, 6), minute(1, 7)]]
    for batch_id, batch in enumerate(batches):
        for _ in range(2):  # as after a failure
            write(spark.createDataFrame(batch, TIMED), batch_id)
    late = states.corrections(spark, folder).select("timestamp", "bitcoin_price")
    assert [row[1] for row in rows_of(late)] == [7.0, 4.0]
    every = [row for batch in batches for row in batch]
    view = states.corrected_view(spark, folder).drop("change_from_kafka")
    assert rounded(view) == rounded(batch_daily(spark, every)[0])
    first = view.filter(F.col("window_start") == F.lit(START)).first()
    assert first["bitcoin_price"] == 7.0


def test_newest_rows_over_batches(spark, tmp_path):
    """A hot group, repeats over batches, a batch that runs again, a new checkpoint."""
    path, shape = f"{tmp_path}/newest", "forum string, at timestamp, id bigint"
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), START + dt.timedelta(minutes=rng.randrange(500)), i) for i in range(700)]
    kept = (["forum"], [F.col("at").desc(), F.col("id")], 12)
    schema = spark.createDataFrame([], shape).schema
    assert rows_of(spark.createDataFrame([], shape)) == []
    parts = [rows[:300], rows[300:310], [], rows[250:600], rows[600:]]
    for i, part in enumerate(parts):
        number, batch_id = (0, i) if i < 3 else (1, i - 3)
        write = newest.writer(path, *kept, run=number)
        for _ in range(2 if i in (1, 3) else 1):
            write(spark.createDataFrame(part, shape).repartition(3), batch_id)
    expected = top_n(spark.createDataFrame(rows, shape), *kept)
    assert rows_of(newest.view(spark, path, schema, *kept)) == rows_of(expected)
    sizes = spark.read.parquet(path).groupBy("run_id", "batch_id").count().collect()
    assert len(sizes) == len(parts) and all(row["count"] <= 4 * 12 for row in sizes)


def test_newest_rows_of_a_stream_without_rows(spark, tmp_path):
    session = stream_session(spark, 2)
    (tmp_path / "in").mkdir()
    feed = session.readStream.schema("forum string, id bigint").parquet(f"{tmp_path}/in")
    kept = (["forum"], [F.col("id")], 3)
    newest.writer(f"{tmp_path}/out", *kept)(spark.createDataFrame([], feed.schema), 0)
    run.drain(run.each_batch(feed, "append", newest.writer(f"{tmp_path}/out", *kept)), f"{tmp_path}/c")
    assert newest.view(spark, f"{tmp_path}/out", feed.schema, *kept).count() == 0


def lake(spark, folder, extra=()):
    sf_dir = "/root/testdata/sf0.001"
    sent = {TICK_TOPIC: inputs.tick_messages(spark, sf_dir), POST_TOPIC: inputs.post_messages(spark, sf_dir)}
    windows = batch_speed.latest_ticks(inputs.ticks(spark, sf_dir)).withColumns(
        {"kind": F.lit("tick"), "posts_last_5_minutes": F.lit(1), **{c: F.lit(None).cast("double") for c in _averages()}}
    )
    serving.append_batch(windows, 0, f"{folder}/speed_log", "window_start")
    for topic, rows in sent.items():
        serving.append_raw(M.landed(rows, topic), f"{folder}/{topic}")


def _averages():
    from tidewire.streaming.speed import AVERAGES

    return AVERAGES


def test_a_run_that_stops_between_the_writes_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    lake(spark, folder)
    jobs.run_daily(spark, folder, inputs.AS_OF)
    names = ("speed_layer", "batch_layer")
    before = {name: rows_of(jobs.stored_days(spark, folder, name)) for name in names}
    assert all(before.values())
    stage = serving.stage_days

    def stop(rows, path, *rest):
        if path.endswith("batch_layer"):
            raise RuntimeError("stopped")
        stage(rows.withColumn("bitcoin_price", F.lit(-1.0)), path, *rest)

    monkeypatch.setattr(serving, "stage_days", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        jobs.run_daily(spark, folder, inputs.AS_OF)
    assert {name: rows_of(jobs.stored_days(spark, folder, name)) for name in names} == before
    refresh_tables(spark, create_tables(spark, "published_test", location=folder))
    for name in names:
        columns = jobs.stored_days(spark, folder, name).columns
        assert rows_of(spark.table(f"published_test.{name}").select(columns)) == before[name]
    spark.sql("DROP NAMESPACE published_test CASCADE")


def test_copies_with_other_prices_give_one_result(spark, tmp_path):
    """Two ticks of an asset and instant: the one that came last; of one file, always the same."""
    sf_dir, results = "/root/testdata/sf0.001", []
    ticks = M.landed(inputs.tick_messages(spark, sf_dir), TICK_TOPIC)
    for i in range(2):
        path = f"{tmp_path}/{i}/{TICK_TOPIC}"
        other = ticks.withColumn("price_usd", F.col("price_usd") + 1)
        both = ticks.unionByName(other).orderBy(F.rand(i))
        serving.append_raw(both, path)
        from tidewire.sources.tables import read_topic_table

        kept = jobs.newest_copies(read_topic_table(spark, path, TICK_TOPIC))
        results.append(rows_of(kept.select("id", "price_usd")))
    assert results[0] == results[1]
    assert max(Counter(row[0] for row in results[0]).values()) == 1
