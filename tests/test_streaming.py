"""Several micro-batches, restarts, late rows, repeats; sources, tables and jobs."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidewire import jobs
from tidewire.catalog import inputs, streams
from tidewire.functions.sentiment import lexicon_scorer
from tidewire.operators import messages as M
from tidewire.plans import daily, speed as batch_speed
from tidewire.schemas import POST_TOPIC, TICK_TOPIC, create_tables, struct
from tidewire.session import stream_session
from tidewire.sources import tables, topics
from tidewire.streaming import ingest, run, serving, speed

TICK = "symbol string, last_updated timestamp, price_usd double"


def at(minute, second=0):
    return dt.datetime(2024, 1, 17, 10, 0) + dt.timedelta(minutes=minute, seconds=second)


def land(spark, path, rows, shape=TICK):
    spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)


def stream_of(spark, path, shape=TICK):
    session = stream_session(spark, 4)
    return session.readStream.schema(shape).option("maxFilesPerTrigger", "1").parquet(path)


def test_change_is_carried_over_micro_batches_and_restarts(spark, tmp_path):
    source, log = f"{tmp_path}/in", f"{tmp_path}/log"
    prices = [100.0, 110.0, 0.0, 55.0, 66.0]

    def drain():
        rows = speed.price_windows(stream_of(spark, source))
        writer = run.each_batch(rows, "update", serving.log_writer(log, "window_start"))
        run.drain(writer, f"{tmp_path}/checkpoint", timeout=120)

    for i, price in enumerate(prices[:3]):
        land(spark, source, [("A", at(i * 5), price + 1), ("A", at(i * 5, 30), price), ("B", at(i * 5), 5.0)])
    drain()
    for i, price in enumerate(prices[3:], start=3):
        land(spark, source, [("A", at(i * 5, 30), price)])
    drain()  # the last windows are still open
    rows = speed.change_view(spark, log)
    got = sorted((r.symbol, r.window_start, round(r.change_from_kafka, 6)) for r in rows.collect())
    expected = [("A", at(5 * i), c) for i, c in enumerate([0.0, 10.0, -100.0, 0.0, 20.0])]
    assert got == expected + [("B", at(5 * i), 0.0) for i in range(3)]


def test_late_rows_are_dropped_on_the_stream_only(spark, tmp_path):
    source = f"{tmp_path}/in"
    land(spark, source, [("A", at(0), 1.0)])
    land(spark, source, [("A", at(60), 2.0)])
    land(spark, source, [("A", at(70), 4.0)])
    land(spark, source, [("A", at(1), 3.0)])
    windows = speed.price_windows(stream_of(spark, source))
    run.drain(run.each_batch(windows, "update", serving.log_writer(f"{tmp_path}/log", "window_start")), f"{tmp_path}/c")
    schema = struct({"symbol": "string", "window_start": "timestamp", "timestamp": "timestamp", "bitcoin_price": "double"})
    rows = serving.latest(spark, f"{tmp_path}/log", schema, ["symbol", "window_start"])
    assert [r.bitcoin_price for r in rows.orderBy("window_start").collect()] == [1.0, 2.0, 4.0]
    stored = spark.read.schema(TICK).parquet(source)
    prices = batch_speed.latest_ticks(stored).orderBy("window_start").collect()
    assert [r.bitcoin_price for r in prices] == [3.0, 2.0, 4.0]


@pytest.mark.parametrize("spread", [None, 3])
def test_repeats_over_micro_batches(spark, tmp_path, spread):
    shape = "id string, created_utc timestamp, n int"
    for i in range(3):
        land(spark, f"{tmp_path}/in", [("p", at(0), i), (f"q{i}", at(i), i)], shape)
    rows = ingest.without_repeats(stream_of(spark, f"{tmp_path}/in", shape), POST_TOPIC, spread=spread)
    rows = rows.withColumn("event_day", F.col("created_utc").cast("date"))
    run.drain(run.append_to(rows, f"{tmp_path}/out"), f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(stored.select("id")) == [("p",), ("q0",), ("q1",), ("q2",)]


def test_speed_log_over_micro_batches_equals_batch(spark, sf_dir, tmp_path):
    """Batches cut windows in two; the view still equals the batch result."""
    events = inputs.events(spark, sf_dir).filter("ts < timestamp '2024-01-07'")
    cuts = ["2024-01-01", "2024-01-03 10:02:30", "2024-01-05 20:13:07", "2024-01-07"]
    for low, high in zip(cuts, cuts[1:]):
        part = events.filter(f"ts >= timestamp '{low}' AND ts < timestamp '{high}'")
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = stream_of(spark, f"{tmp_path}/in", schema)
    documents = inputs.read(spark, sf_dir, "documents")
    scorer = lexicon_scorer(inputs.DOCUMENT_WORDS)
    scored = batch_speed.scored_posts(inputs.as_posts(stream, documents, events), scorer)
    windows = speed.speed_windows(inputs.as_ticks(stream), scored)
    writer = run.each_batch(windows, "update", serving.log_writer(f"{tmp_path}/log", "window_start"))
    run.drain(writer, f"{tmp_path}/checkpoint")
    names = ["symbol", "timestamp", "bitcoin_price", "posts_last_5_minutes"]
    names += [F.round(c, 9) for c in ["change_from_kafka", *speed.AVERAGES]]
    expected = batch_speed.speed_rows(inputs.as_ticks(events), inputs.as_posts(events, documents, events), scorer)
    batches = spark.read.parquet(f"{tmp_path}/log").select("batch_id").distinct().count()
    assert batches >= 3
    assert rows_of(speed.speed_view(spark, f"{tmp_path}/log").select(*names)) == rows_of(expected.select(*names))


def test_sliding_posts(spark, tmp_path):
    shape = "created_utc timestamp"
    land(spark, f"{tmp_path}/in", [(at(0),), (at(2),)], shape)
    counts = speed.post_counts(stream_of(spark, f"{tmp_path}/in", shape), slide="1 minute")
    run.drain(run.each_batch(counts, "update", serving.log_writer(f"{tmp_path}/log", "window_start")), f"{tmp_path}/c")
    schema = struct({"window_start": "timestamp", "posts": "long"})
    rows = serving.latest(spark, f"{tmp_path}/log", schema, ["window_start"])
    expected = [(at(m), 2 if -2 <= m <= 0 else 1) for m in range(-4, 3)]
    assert sorted((r.window_start, r.posts) for r in rows.collect()) == expected


def test_memory_table(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("A", at(0), 1.0), ("A", at(1), 3.0)])
    stream = stream_of(spark, f"{tmp_path}/in")
    means = stream.groupBy().agg(F.avg("price_usd").alias("mean"))
    run.drain(run.memory_table(means, "result_table"), f"{tmp_path}/c", timeout=60)
    assert stream.sparkSession.sql("SELECT mean FROM result_table").collect()[-1].mean == 2.0


def test_replayed_batch_changes_nothing(spark, tmp_path):
    log, schema = f"{tmp_path}/log", struct({"k": "string", "at": "timestamp", "v": "integer"})
    first = spark.createDataFrame([("a", at(0), 1), ("b", at(0), 1)], schema)
    second = spark.createDataFrame([("a", at(0), 2)], schema)
    for batch_id, rows in [(0, first), (1, second)]:
        serving.append_batch(rows, batch_id, log, "at")
    view = rows_of(serving.latest(spark, log, schema, ["k"]))
    assert [(r[0], r[2]) for r in view] == [("a", 2), ("b", 1)]
    for batch_id, rows in [(0, first), (1, second)]:
        serving.append_batch(rows, batch_id, log, "at")
    assert rows_of(serving.latest(spark, log, schema, ["k"])) == view
    assert spark.read.parquet(log).count() == 3


def test_rewritten_days(spark, tmp_path):
    """Rewriting a day, also twice, leaves the view alone; a later row still wins."""
    log, schema = f"{tmp_path}/log", struct({"k": "string", "at": "timestamp", "v": "integer"})
    next_day = at(24 * 60)
    serving.append_batch(spark.createDataFrame([("a", at(0), 1), ("b", at(0), 1), ("c", next_day, 1)], schema), 0, log, "at")
    serving.append_batch(spark.createDataFrame([("a", at(0), 2)], schema), 1, log, "at")
    view = rows_of(serving.latest(spark, log, schema, ["k"]))
    over = F.col("event_day") == F.lit(at(0).date())
    for _ in range(2):
        serving.rewrite_days(spark, log, schema, ["k"], over)
    assert rows_of(serving.latest(spark, log, schema, ["k"])) == view
    rewritten = spark.read.schema(schema).parquet(f"{log}/part={serving.DAYS}")
    assert rows_of(rewritten.select("k", "at", "v")) == [r for r in view if r[0] != "c"]
    late = spark.createDataFrame([("b", at(0), 9)], schema)
    serving.append_batch(late, 2, log, "at")
    expected = {"a": 2, "b": 9, "c": 1}
    for _ in range(2):
        assert {r.k: r.v for r in serving.latest(spark, log, schema, ["k"]).collect()} == expected
        serving.rewrite_days(spark, log, schema, ["k"], over)
    batches = spark.read.parquet(log).filter("part = 'days'").select("batch_id").distinct()
    assert sorted(r.batch_id for r in batches.collect()) == [1, 2]


def test_reading_a_log_leaves_its_schema_alone(spark, tmp_path):
    before = speed.PRICE_SCHEMA.fieldNames()
    row = [("A", at(0), at(0), 1.0)]
    serving.append_batch(spark.createDataFrame(row, speed.PRICE_SCHEMA), 0, f"{tmp_path}/log", "window_start")
    for _ in range(2):
        assert serving.latest(spark, f"{tmp_path}/log", speed.PRICE_SCHEMA, ["symbol"]).columns == before
    assert speed.PRICE_SCHEMA.fieldNames() == before


def test_a_new_checkpoint_over_an_old_log(spark, tmp_path):
    """Batches of a later run win, although they count from 0 again."""
    log, schema = f"{tmp_path}/log", struct({"k": "string", "at": "timestamp", "v": "integer"})
    old, new = (serving.run_number(spark, f"{tmp_path}/checkpoint{i}") for i in (1, 2))
    assert old < new and serving.run_number(spark, f"{tmp_path}/checkpoint1") == old
    for run_id, batch_id, value in [(old, 7, 1), (new, 0, 2)]:
        rows = spark.createDataFrame([("a", at(0), value)], schema)
        serving.append_batch(rows, batch_id, log, "at", run_id)
    over = F.col("event_day") == F.lit(at(0).date())
    for _ in range(2):
        assert [r.v for r in serving.latest(spark, log, schema, ["k"]).collect()] == [2]
        serving.rewrite_days(spark, log, schema, ["k"], over)


def test_a_day_is_written_by_several_tasks(spark, tmp_path):
    schema = struct({"k": "string", "at": "timestamp"})
    rows = spark.createDataFrame([(str(i), at(i % 60)) for i in range(200)], schema)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a stream
    serving.append_batch(rows, 0, f"{tmp_path}/log", "at", files=3)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = spark.read.parquet(f"{tmp_path}/log").select(F.input_file_name()).distinct().count()
    assert 2 <= files <= 3


def test_log_is_read_once(spark, tmp_path):
    shape = speed.WINDOW_SCHEMA
    rows = spark.createDataFrame([], shape)
    serving.append_batch(rows, 0, f"{tmp_path}/log", "window_start")
    plan = speed.speed_view(spark, f"{tmp_path}/log")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def messages(spark, sf_dir):
    tick = M.tick_message(inputs.ticks(spark, sf_dir))
    post = M.post_message(inputs.posts(spark, sf_dir))
    odd = [(TICK_TOPIC, bytearray(b"oops")), ("other", bytearray(b"{}"))]
    bad = spark.createDataFrame(odd, "topic string, value binary")
    return M.union_topics(tick, post, bad)


def test_jobs_end_to_end(spark, tmp_path):
    """Topics landed as files, each message sent three times: speed job, then daily job, twice."""
    sf_dir, folder = "/root/testdata/sf0.001", f"{tmp_path}/lake"
    for _ in range(3):
        topics.write_topic(messages(spark, sf_dir), fmt="parquet", path=f"{tmp_path}/feed")
    for _ in range(2):  # the second run finds nothing new
        jobs.run_speed(
            spark, folder, "parquet", available_now=True, spread=2, state_partitions=4, path=f"{tmp_path}/feed"
        )
    ticks = tables.read_topic_table(spark, f"{folder}/{TICK_TOPIC}", TICK_TOPIC)
    posts = tables.read_topic_table(spark, f"{folder}/{POST_TOPIC}", POST_TOPIC)
    sent = inputs.ticks(spark, sf_dir).count()
    assert ticks.count() == 3 * sent and ticks.dropDuplicates(["id"]).count() == sent
    bad = tables.read_quarantine(spark, f"{folder}/{TICK_TOPIC}", TICK_TOPIC)
    assert rows_of(bad) == [("oops",)] * 3
    once = batch_speed.speed_rows(ticks.dropDuplicates(["id"]), posts.dropDuplicates(["id"]))
    names = ["symbol", "timestamp", "bitcoin_price", "posts_last_5_minutes", F.round("avg_sentiment_bullish", 9)]
    assert rows_of(speed.speed_view(spark, f"{folder}/speed_log").select(*names)) == rows_of(once.select(*names))

    before = inputs.AS_OF.date() - dt.timedelta(days=1)
    names = ["symbol", "open_price", "close_price", "posts_last_day", F.round("predicted_bitcoin_price", 6), "Max_Price", "Min_Price"]
    for _ in range(2):
        stored = jobs.run_daily(spark, folder, inputs.AS_OF)
        jobs.run_upkeep(spark, folder, inputs.AS_OF)
        today = stored.filter(F.col("event_day") == F.lit(inputs.AS_OF.date()))
        expected = daily.daily_row_as_of(once, inputs.AS_OF)
        assert rows_of(today.select("timestamp", *names)) == rows_of(expected.select("timestamp", *names))
        assert today.count() > 0
        over = stored.filter(F.col("event_day") == F.lit(before))
        whole = daily.daily_rows(once).filter(F.col("day") == F.lit(before))
        assert rows_of(over.select(*names)) == rows_of(whole.select(*names)) and over.count() > 0
    closed = tables.read_topic_table(spark, f"{folder}/{TICK_TOPIC}", TICK_TOPIC, closed_before=inputs.AS_OF.date())
    two_days = F.col("event_day") >= F.lit(before)
    assert rows_of(closed.filter(two_days).select("id")) == rows_of(ticks.filter(two_days).select("id"))


def test_messages_are_made_once_for_both_drains(spark, tmp_path, monkeypatch):
    """Each drain has its part of the feed, of which the second is late for the first's stream."""
    made, paths = [], []
    rows = [(TICK_TOPIC, bytearray(f"message {i}", "ascii")) for i in range(40)]
    sent = spark.createDataFrame(rows, "topic string, value binary")
    write = streams.topics.write_topic
    monkeypatch.setattr(streams, "damaged_messages", lambda *of: sent)
    monkeypatch.setattr(streams.topics, "write_topic", lambda *of, **kw: (made.append(kw["path"]), write(*of, **kw)))
    monkeypatch.setattr(streams.jobs, "run_speed", lambda *of, path, **kw: paths.append(path))
    monkeypatch.setattr(streams.jobs, "run_daily", lambda *of, **kw: None)
    streams._job_folder(spark, str(tmp_path))
    assert len(made) == 1 and len(set(paths)) == 2
    first, second = ({bytes(r.value) for r in topics.read_topics(spark, [TICK_TOPIC], "parquet", path=p).collect()} for p in paths)
    assert first and second and first | second == {bytes(value) for _, value in rows} and not first & second


@pytest.mark.parametrize("spread", [None, 2])
def test_last_shuffle_before_the_windows_has_no_texts(spark, tmp_path, capsys, spread):
    shape = "topic string, value binary"
    land(spark, f"{tmp_path}/in", [(POST_TOPIC, bytearray(b"{}"))], shape)
    posts = ingest.typed_rows(stream_of(spark, f"{tmp_path}/in", shape), POST_TOPIC)
    rows = ingest.without_repeats(posts, POST_TOPIC, spread=spread, make=lambda few: batch_speed.scored_posts(few))
    rows.select("created_utc", "sentiment").explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1]
    last = plan.split("DeduplicateWithinWatermark [id")[1].splitlines()[1]
    assert ("sentiment" in last and "title#" not in last.split("sentiment")[-1]) == bool(spread), plan


def test_raw_tables_are_packed(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("A", at(0), 1.0)])
    rows = stream_of(spark, f"{tmp_path}/in").withColumn("event_day", F.col("last_updated").cast("date"))
    run.drain(run.append_to(rows, f"{tmp_path}/out"), f"{tmp_path}/c")
    assert list(tmp_path.glob("out/*/*.zstd.parquet")) and not list(tmp_path.glob("out/*/*.snappy.parquet"))


def test_interval_trigger_keeps_running(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [("A", at(0), 1.0)])
    rows = stream_of(spark, f"{tmp_path}/in").withColumn("event_day", F.col("last_updated").cast("date"))
    query = run.start(run.append_to(rows, f"{tmp_path}/out"), f"{tmp_path}/c", interval="1 second")
    query.processAllAvailable()
    land(spark, f"{tmp_path}/in", [("B", at(1), 2.0)])
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert rows_of(spark.read.parquet(f"{tmp_path}/out").select("symbol")) == [("A",), ("B",)]


def test_topics_as_files(spark, tmp_path):
    topics.write_topic(messages(spark, "/root/testdata/sf0.001"), fmt="parquet", path=f"{tmp_path}/feed")
    read = topics.read_topics(spark, [TICK_TOPIC], "parquet", path=f"{tmp_path}/feed")
    assert {r.topic for r in read.select("topic").distinct().collect()} == {TICK_TOPIC}
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topics_stream(spark, [TICK_TOPIC], **{"kafka.bootstrap.servers": "nowhere:1"})


def test_landed_payloads(spark, tmp_path):
    (tmp_path / "listings").mkdir()
    (tmp_path / "posts").mkdir()
    (tmp_path / "listings" / "a.json").write_text('{"data":\n[{"symbol":"BTC",\n"name":"B"}]}')
    (tmp_path / "posts" / "a.json").write_text(
        '{"created_utc": 1705449600, "subreddit": {"display_name": "btc"}, "title": "T"}\n'
    )
    from tidewire.operators import listing, posts as P

    payloads = tables.read_listings(spark, f"{tmp_path}/listings")
    assert [r["Name"] for r in listing.extract_asset(payloads).collect()] == ["B"]
    landed = tables.read_submissions(stream_session(spark, 2), f"{tmp_path}/posts", streaming=True)
    allowed = P.of_forums(P.project_submissions(landed)).withColumn("event_day", F.lit("2024-01-17").cast("date"))
    run.drain(run.append_to(allowed, f"{tmp_path}/out"), f"{tmp_path}/c")
    assert [r.title for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["T"]


def test_tables_are_created_once(spark, tmp_path):
    for _ in range(2):
        names = create_tables(spark, "market_test", location=f"{tmp_path}/db")
    assert len(names) == 4
    columns = spark.table("market_test.batch_layer").columns
    assert columns[:3] == ["symbol", "timestamp", "open_price"] and columns[-1] == "event_day"
    spark.sql("DROP NAMESPACE market_test CASCADE")


def test_table_of_any_connector(spark, tmp_path):
    spark.range(3).write.csv(f"{tmp_path}/t", header=True)
    assert tables.read_table(spark, "csv", path=f"{tmp_path}/t", header="true").count() == 3


def test_command_line(spark, tmp_path, sf_dir):
    windows = batch_speed.latest_ticks(inputs.ticks(spark, sf_dir)).withColumns(
        {"kind": F.lit("tick"), "posts_last_5_minutes": F.lit(1), **{c: F.lit(None).cast("double") for c in speed.AVERAGES}}
    )
    serving.append_batch(windows, 0, f"{tmp_path}/speed_log", "window_start")
    sent = [inputs.tick_messages(spark, sf_dir), inputs.post_messages(spark, sf_dir)]
    for topic, rows in zip(jobs.TOPICS, sent):
        serving.append_raw(M.landed(rows, topic), f"{tmp_path}/{topic}")
    jobs.main(["daily", "--folder", str(tmp_path), "--as-of", "2024-01-15 23:59:00"])
    stored = spark.read.parquet(f"{tmp_path}/batch_layer").groupBy("event_day").count().collect()
    assert sorted((str(r.event_day), r["count"]) for r in stored) == [("2024-01-14", 5), ("2024-01-15", 5)]
    jobs.main(["upkeep", "--folder", str(tmp_path), "--as-of", "2024-01-15 23:59:00"])
    days = spark.read.parquet(f"{tmp_path}/speed_log").filter("part = 'days'").select("event_day").distinct()
    assert sorted(str(r.event_day) for r in days.collect()) == ["2024-01-13", "2024-01-14"]
