"""What the physical plans must and must not contain."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidewire import catalog
from tidewire.catalog import inputs, streams
from tidewire.functions.sentiment import constant_scorer
from tidewire.plans import daily, speed

# Streams and queries that write tables run on being called; model queries are Python by nature.
SKIP = ("stream_", "upsert", "append", "publish", "landed", "sentiment_model", "forecast_model")
SKIP += ("daily_job", "serving_tables")
BATCH = [name for name in catalog.all_queries() if not name.startswith(SKIP)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_pairs(spark, sf_dir, name):
    plan = plan_of(catalog.all_queries()[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_range_reaches_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(catalog.all_queries()["day_range"](spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(ts" in line and "LessThan(ts" in line for line in pushed), pushed


def test_only_used_columns_are_read(spark, sf_dir):
    plan = plan_of(catalog.all_queries()["daily_ohlc"](spark, sf_dir))
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "props" not in schema and "user_id" not in schema


def test_day_folders_are_pruned(spark, sf_dir, tmp_path):
    ticks = inputs.ticks(spark, sf_dir).withColumn("event_day", F.col("last_updated").cast("date"))
    ticks.write.partitionBy("event_day").parquet(f"{tmp_path}/ticks")
    stored = spark.read.parquet(f"{tmp_path}/ticks")
    rows = daily.day_range(stored, "last_updated", inputs.AS_OF)
    assert "event_day" in plan_of(rows).split("PartitionFilters: [")[1].split("]")[0]
    assert rows.count() == daily.day_range(inputs.ticks(spark, sf_dir), "last_updated", inputs.AS_OF).count()


def test_group_limit_prunes_before_the_shuffle(spark, sf_dir):
    plan = plan_of(catalog.all_queries()["newest30_per_forum"](spark, sf_dir))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for name in ("daily_ohlc", "latest_tick", "change_prev_row", "batch_rows"):
        plan = plan_of(catalog.all_queries()[name](spark, sf_dir))
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_max_by" in plan, name


def tables(spark, folder):
    """Eight events and three documents, one without a text; two of them share an event."""
    rows = [(i, dt.datetime(2024, 1, 1 + 4 * i, 9, i), i, "view", 1.0 + i, f'{{"k": {i}}}') for i in range(8)]
    shape = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, shape).write.parquet(f"{folder}/events.parquet")
    rows = [(1, "the and it", "en", "src0"), (3, None, "en", "src1"), (9, "of", None, "src0")]
    shape = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, shape).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_scores_are_shuffled_and_no_texts(spark, tmp_path, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = streams.timed(spark, tables(spark, tmp_path))
    rows.explain("formatted")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = [part.splitlines()[1] for part in capsys.readouterr().out.split(") Exchange")[1:]]
    shuffled = [line for line in shuffled if line.startswith("Input [")]
    assert shuffled and not [line for line in shuffled if "text" in line or "title" in line], shuffled
    scores = {tuple(row["sentiment"]) for row in rows.filter("kind = 'post'").collect()}
    assert rows.count() == 8 + 3 and scores == {(0.6, 0.2, 0.4), (1 / 3, 2 / 3, 1 / 3), (None, None, None)}


def test_batches_are_dealt_from_stored_rows(spark, tmp_path, monkeypatch):
    read = []

    class Stop(Exception):
        pass

    def stop(rows, *rest):
        read.extend(rows.inputFiles())
        raise Stop

    monkeypatch.setattr(streams.states, "add_batch", stop)
    with pytest.raises(Stop):
        streams.daily_incremental(spark, tables(spark, tmp_path))
    assert read and not [name for name in read if "documents" in name or "events" in name]


POSTS = "title string, selftext string, created_utc timestamp"
TICKS = "symbol string, last_updated timestamp, price_usd double"


def at(minute, second=0):
    return dt.datetime(2024, 1, 17, 10, minute, second)


def test_speed_rows_by_hand(spark):
    ticks = spark.createDataFrame(
        [("BTC", at(1), 100.0), ("BTC", at(4), 110.0), ("BTC", at(7), 0.0), ("BTC", at(21), 55.0)], TICKS
    )
    posts = spark.createDataFrame([("T", None, at(2)), ("U", "", at(3)), ("V", None, at(12))], POSTS)
    rows = speed.speed_rows(ticks, posts, constant_scorer(0.25)).orderBy("timestamp").collect()
    got = [
        (r.timestamp, r.bitcoin_price, r.posts_last_5_minutes, r.change_from_kafka, r.avg_sentiment_bullish)
        for r in rows
    ]
    assert got == [
        (at(4), 110.0, 2, 0.0, 0.25),  # first row: change 0
        (at(7), 0.0, 0, -100.0, 0.5),  # no posts: 0 and 0.5
        (at(21), 55.0, 0, 0.0, 0.5),  # zero before: change 0
    ]  # the window with a post only gives no row


def test_order_of_input_does_not_matter(spark, sf_dir):
    ticks, posts = inputs.ticks(spark, sf_dir), inputs.posts(spark, sf_dir)
    straight = speed.draft_rows(ticks, posts)
    shuffled = speed.draft_rows(ticks.repartition(13).orderBy(F.rand(1)), posts.repartition(5))
    names = ["last_updated", F.round("bitcoin_price", 6), "number_of_posts", F.round("change_percent", 6)]
    assert rows_of(straight.select(*names)) == rows_of(shuffled.select(*names))


SPEED = (
    "symbol string, timestamp timestamp, bitcoin_price double, posts_last_5_minutes int, "
    "avg_sentiment_bullish double, avg_sentiment_bearish double, avg_sentiment_neutral double"
)


def test_unreadable_prices(spark):
    """The newest price is NULL: rows close with the newest that can be read."""
    ticks = spark.createDataFrame(
        [("BTC", at(1), None), ("BTC", at(2), 105.0), ("BTC", at(3), 110.0), ("BTC", at(4), None), ("BTC", at(9), None),
         ("BTC", at(11), 121.0)], TICKS
    )
    rows = speed.with_change(speed.latest_ticks(ticks)).orderBy("timestamp").collect()
    assert [(r.timestamp, r.bitcoin_price, round(r.change_from_kafka, 6)) for r in rows] == [
        (at(4), 110.0, 0.0), (at(9), None, 0.0), (at(11), 121.0, 10.0),
    ]
    day = daily.daily_prices(ticks, "last_updated", "price_usd", ["symbol"]).collect()[0]
    assert (day.open_price, day.close_price, day.max_price, day.min_price) == (105.0, 121.0, 121.0, 105.0)


def test_five_days_by_the_calendar(spark):
    """Days without a price are no closes of 0, and older closes do not stand in for them."""
    prices = {1: 10.0, 2: 20.0, 3: 30.0, 4: 40.0, 5: 50.0, 6: None, 20: 60.0}
    rows = [("BTC", dt.datetime(2024, 1, d, 10), p, 0, 0.5, 0.5, 0.5) for d, p in prices.items()]
    speed_rows = spark.createDataFrame(rows, SPEED)
    got = {r.day.day: r for r in daily.daily_rows(speed_rows).collect()}
    forecasts = [round(got[d].predicted_bitcoin_price, 6) for d in prices]
    assert forecasts == [0.0, 0.0, 0.0, 0.0, 60.0, 0.0, 0.0]
    assert (got[6].close_price, got[6].open_price) == (0.0, 0.0)
    for day in prices:
        as_of = dt.datetime(2024, 1, day, 23, 59)
        row = daily.daily_row_as_of(speed_rows, as_of).collect()[0]
        assert row.predicted_bitcoin_price == got[day].predicted_bitcoin_price


def test_latest_speed_row_scores_its_own_posts_only(spark, sf_dir):
    ticks, posts = inputs.ticks(spark, sf_dir), inputs.posts(spark, sf_dir)
    whole = speed.speed_rows(ticks, posts).orderBy(F.col("timestamp").desc(), "symbol").limit(1)
    one = speed.latest_speed_row(ticks, posts)
    assert rows_of(one.select(*whole.columns)) == rows_of(whole)


def test_copies_that_arrive_together(spark):
    from tidewire.operators.posts import drop_repeats

    rows = [("p", 1, 5), ("p", 2, 3), ("p", 2, 9), ("q", 1, 1)]
    df = spark.createDataFrame(rows * 2, "id string, seen int, score int").repartition(5)
    kept = drop_repeats(df, F.col("seen"), [F.col("score").desc()])
    assert rows_of(kept.select("id", "score")) == [("p", 9), ("q", 1)]


def test_daily_defaults(spark):
    row = daily.daily_rows(spark.createDataFrame([("BTC", at(1), None, None, None, None, None)], SPEED)).collect()[0]
    assert (row.open_price, row.close_price, row.posts_last_day) == (0.0, 0.0, 0)
    assert (row.avg_sentiment_bullish, row.predicted_bitcoin_price, row.change_from_kafka) == (0.0, 0.0, None)
