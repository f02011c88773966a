"""Streams over the given tables, drained and read back; the SQL twin is the batch form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import jobs
from tidewire.catalog.inputs import (
    DOCUMENT_WORDS,
    POSTS_SQL,
    SCORED_SQL,
    SPEED_INPUT_SQL,
    SPEED_SQL,
    TICKS_SQL,
    as_posts,
    as_ticks,
    events as batch_events,
    ntz,
    post_texts,
    posts as batch_posts,
    posts_at_events,
    read,
    rounded,
    ticks as batch_ticks,
)
from tidewire.catalog.ingest import POST_ID_SQL, TICK_ID_SQL
from tidewire.catalog.market import DAILY_SQL, SPEED_VIEW_SQL, daily_sql_view, speed_view as market_view
from tidewire.catalog.social import _AVERAGES_SQL, AVERAGES, SQL as SOCIAL_SQL
from tidewire.functions.sentiment import lexicon_scorer
from tidewire.operators import messages as M
from tidewire.operators.posts import NEWEST_PER_FORUM
from tidewire.plans import daily, speed as batch_speed, states as window_states
from tidewire.plans.speed import scored_posts
from tidewire.schemas import POST_TOPIC, TICK_TOPIC, create_tables, refresh_tables, struct
from tidewire.session import configure, run_folder, stream_session
from tidewire.sources import topics
from tidewire.sources.tables import read_quarantine, read_topic_table
from tidewire.streaming import ingest, newest, run, serving, speed, states

# State partitions of the queries' streams, which are small.
STATE_PARTITIONS = 8
# Files that hold one drain of the stream with late rows.
LATE_FILES = 3
JOBS_AS_OF = dt.datetime(2024, 1, 25, 12, 0)


def events(session: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream."""
    schema = session.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = session.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def ticks(session: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(events(session, sf_dir))


def posts(session: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(
        events(session, sf_dir), read(session, sf_dir, "documents"), read(session, sf_dir, "events")
    )


def scored(session: SparkSession, sf_dir: str) -> DataFrame:
    return scored_posts(posts(session, sf_dir), lexicon_scorer(DOCUMENT_WORDS))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of both topics, as the producers send them."""
    return M.union_topics(M.tick_message(batch_ticks(spark, sf_dir)), M.post_message(batch_posts(spark, sf_dir)))


def session_for(spark: SparkSession) -> SparkSession:
    return stream_session(spark, STATE_PARTITIONS)


def stream_global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    folder = run_folder(spark, "global_avg")
    session = session_for(spark)
    means = speed.running_means(scored(session, sf_dir)).withColumn("scope_day", F.lit("1970-01-01").cast("date"))
    write = serving.log_writer(f"{folder}/log", "scope_day")
    run.drain(run.each_batch(means, "update", write), f"{folder}/checkpoint")
    schema = struct({"scope_day": "date", **{name: "double" for name in AVERAGES}})
    rows = serving.latest(spark, f"{folder}/log", schema, ["scope_day"])
    return rounded(rows.drop("scope_day"), 6, *AVERAGES)


def stream_posts_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _post_counts(spark, sf_dir, None)


def stream_posts_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of the last five minutes, once a minute."""
    return _post_counts(spark, sf_dir, "1 minute")


def _post_counts(spark: SparkSession, sf_dir: str, slide: str | None) -> DataFrame:
    configure(spark)
    folder = run_folder(spark, "posts_5m")
    counts = speed.post_counts(posts(session_for(spark), sf_dir), slide=slide)
    write = serving.log_writer(f"{folder}/log", "window_start")
    run.drain(run.each_batch(counts, "update", write), f"{folder}/checkpoint")
    schema = struct({"window_start": "timestamp", "posts": "long"})
    return ntz(serving.latest(spark, f"{folder}/log", schema, ["window_start"]), "window_start")


def stream_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows still open at the end of the stream are in the result like others."""
    configure(spark)
    folder = run_folder(spark, "change")
    windows = speed.price_windows(ticks(session_for(spark), sf_dir))
    write = serving.log_writer(f"{folder}/log", "window_start")
    run.drain(run.each_batch(windows, "update", write), f"{folder}/checkpoint")
    rows = speed.change_view(spark, f"{folder}/log")
    return ntz(rounded(rows, 6, "change_from_kafka"), "window_start", "timestamp")


def stream_speed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    folder = run_folder(spark, "speed")
    session = session_for(spark)
    windows = speed.speed_windows(ticks(session, sf_dir), scored(session, sf_dir))
    write = serving.log_writer(f"{folder}/log", "window_start")
    run.drain(run.each_batch(windows, "update", write), f"{folder}/checkpoint")
    return market_view(speed.speed_view(spark, f"{folder}/log"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every post arrives twice."""
    configure(spark)
    folder = run_folder(spark, "dedup")
    session = session_for(spark)
    copies = [posts(session, sf_dir), posts(session, sf_dir)]
    typed = [c.select(M.natural_id(POST_TOPIC).alias("id"), "post_id", "created_utc", "title") for c in copies]
    once = ingest.without_repeats(typed[0].unionByName(typed[1]), POST_TOPIC)
    once = once.withColumn("event_day", F.col("created_utc").cast("date"))
    run.drain(run.append_to(once, f"{folder}/posts"), f"{folder}/checkpoint")
    schema = struct({"id": "string", "post_id": "long", "created_utc": "timestamp", "title": "string", "event_day": "date"})
    rows = spark.read.schema(schema).parquet(f"{folder}/posts")
    return ntz(rows.select("post_id", "created_utc", "title"), "created_utc")


def _raw_table(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Both topics published as files, each streamed into its raw table; one of the tables."""
    configure(spark)
    folder = run_folder(spark, "raw")
    topics.write_topic(messages(spark, sf_dir), "parquet", path=f"{folder}/feed")
    session = session_for(spark)
    feeds = {t: topics.read_topics_stream(session, [t], "parquet", path=f"{folder}/feed") for t in jobs.TOPICS}
    run.drain_all(ingest.raw_writers(feeds, folder))
    return read_topic_table(spark, f"{folder}/{topic}", topic)


def stream_raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two append streams side by side, each off its own topic; the tick table."""
    return ntz(_raw_table(spark, sf_dir, TICK_TOPIC), "last_updated")


def stream_raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same streams; the post table."""
    rows = _raw_table(spark, sf_dir, POST_TOPIC)
    rows = rows.withColumn("upvote_ratio", F.col("upvote_ratio").cast("double"))
    return ntz(rounded(rows, 4, "upvote_ratio"), "created_utc", "created")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages end up as text in the quarantine folders of the raw table."""
    configure(spark)
    folder = run_folder(spark, "quarantine")
    session = session_for(spark)
    sent = M.tick_message(ticks(session, sf_dir), "tick_id")
    text = F.col("value").cast("string")
    cut = F.when(F.col("tick_id") % 5 == 0, F.concat(F.lit("cut "), F.col("tick_id"))).otherwise(text)
    sent = sent.withColumn("value", cut.cast("binary"))
    run.drain_all(ingest.raw_writers({TICK_TOPIC: sent}, folder))
    rows = read_quarantine(spark, f"{folder}/{TICK_TOPIC}", TICK_TOPIC)
    return rows.select(F.col(M.CORRUPT).alias("message"))


def _job_folder(spark: SparkSession, sf_dir: str) -> str:
    """Both jobs over damaged and late messages.

    Every third price is text that is no number, and so are all after 22:00. The first
    drain gets all messages but every fifth, the second the rest, which are late for
    the stream. The messages are made once, each drain's in a folder of its own. The daily job runs for every day of the last week, then twice for the last.
    """
    configure(spark)
    folder = run_folder(spark, "jobs")
    number = F.pmod(F.xxhash64("value"), F.lit(5))
    sent = damaged_messages(spark, sf_dir).withColumn("late", number == 0)
    topics.write_topic(sent, "parquet", parts=["late"], path=f"{folder}/feed", compression="zstd")
    for late in ("false", "true"):
        jobs.run_speed(
            spark, folder, "parquet", available_now=True, scorer=lexicon_scorer(DOCUMENT_WORDS),
            state_partitions=STATE_PARTITIONS, path=f"{folder}/feed/late={late}",
        )
    for days in (7, 7):
        jobs.run_daily(spark, folder, JOBS_AS_OF, scorer=lexicon_scorer(DOCUMENT_WORDS), late_days=days)
    return folder


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batch_ticks(spark, sf_dir)
    tick = M.tick_message(rows, "tick_id", "last_updated")
    text = F.col("value").cast("string")
    broken = F.regexp_replace(text, r'"Price \(USD\)":[^,}]*', '"Price (USD)":"n/a"')
    is_broken = (F.col("tick_id") % 3 == 0) | (F.hour("last_updated") >= 22)
    tick = tick.withColumn("value", F.when(is_broken, broken).otherwise(text).cast("binary"))
    return M.union_topics(tick.select("topic", "value"), M.post_message(batch_posts(spark, sf_dir)))


def _daily_view(rows: DataFrame) -> DataFrame:
    averages = ["avg_sentiment_bullish", "avg_sentiment_bearish", "avg_sentiment_neutral"]
    return ntz(rounded(rows, 6, "change_from_kafka", "predicted_bitcoin_price", *averages), "timestamp")


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily rows of the days that are over: late rows count, bad prices do not."""
    folder = _job_folder(spark, sf_dir)
    rows = jobs.stored_days(spark, folder, "batch_layer")
    return _daily_view(rows.filter(F.col("event_day") < F.lit(JOBS_AS_OF.date())))


def daily_rows_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages through the batch plans, every day of the table."""
    configure(spark)
    sent = damaged_messages(spark, sf_dir)
    tick, post = (M.conform(M.parse(M.of_topic(sent, t), t), t) for t in jobs.TOPICS)
    speed_rows = batch_speed.speed_rows(tick, post, lexicon_scorer(DOCUMENT_WORDS))
    return _daily_view(daily.daily_rows(speed_rows))


def serving_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs' tables by name: created over the jobs' folder and read by SQL."""
    folder = _job_folder(spark, sf_dir)
    space = "market_" + folder.rsplit("-", 1)[1]
    refresh_tables(spark, create_tables(spark, space, location=folder))
    rows = spark.sql(
        f"""SELECT b.event_day, b.symbol, b.close_price, b.Max_Price, count(*) AS speed_rows
            FROM {space}.batch_layer b JOIN {space}.speed_layer s USING (symbol, event_day)
            WHERE b.event_day < DATE '{JOBS_AS_OF.date()}'
            GROUP BY ALL"""
    )
    return rows


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks and scored posts as rows of one table.

    Posts are scored before they meet their events, so that scores are shuffled and no texts.
    """
    rows = batch_events(spark, sf_dir)
    texts = scored_posts(post_texts(read(spark, sf_dir, "documents")), lexicon_scorer(DOCUMENT_WORDS))
    return window_states.timed_rows(as_ticks(rows), posts_at_events(rows, texts, rows, "sentiment"))


def daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows kept up by four batches: three of ten days, the second with a part of the first's
    rows, and one with a tenth of all rows, late. The second runs twice, and days are compacted.

    The rows that the batches are dealt from are made once and stored."""
    configure(spark)
    folder = run_folder(spark, "incremental")
    made = timed(spark, sf_dir)
    made.write.parquet(f"{folder}/feed")
    rows = spark.read.schema(made.schema).parquet(f"{folder}/feed")
    draw = F.pmod(F.xxhash64("kind", "symbol", "at", "price_usd"), F.lit(10))
    start = rows.agg(F.min(F.to_date("at")).alias("d")).scalar()
    third = F.least(F.floor(F.date_diff(F.to_date("at"), start) / 10), F.lit(2))
    batch = F.when(draw == 0, 3).when(draw == 1, F.least(third + 1, F.lit(2))).otherwise(third)
    dealt = rows.withColumn("batch", batch.cast("int"))
    for batch_id in (0, 1, 1, 2, 3):
        states.add_batch(dealt.filter(F.col("batch") == batch_id).drop("batch"), batch_id, folder)
        if batch_id == 2:
            states.compact(spark, f"{folder}/states", F.lit(True))
    return _daily_view(states.daily_view(spark, folder))


def stream_late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the rows arrives after all others, behind the watermark; two drains of several
    micro-batches. The view has them all."""
    folder = _late_folder(spark, sf_dir, files=1)
    return market_view(states.corrected_view(spark, folder))


def stream_corrections_made(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one micro-batch a drain: late rows of each kind and day that the corrections hold."""
    found = states.corrections(spark, _late_folder(spark, sf_dir, files=LATE_FILES))
    return found.groupBy("kind", F.to_date("window_start").alias("day")).agg(F.sum("n_rows").alias("late_rows"))


def _late_folder(spark: SparkSession, sf_dir: str, files: int) -> str:
    configure(spark)
    folder = run_folder(spark, "late")
    session = session_for(spark)
    rows = timed(spark, sf_dir).withColumn("late", F.second("at") % 5 == 0)
    schema = rows.drop("late").schema
    for late in (False, True):
        part = rows.filter(F.col("late") == late).drop("late")
        part.repartition(LATE_FILES).write.mode("append").parquet(f"{folder}/feed")
        feed = session.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed")
        run.drain(run.each_batch(feed, "append", states.late_writer(folder, 10)), f"{folder}/checkpoint")
    return folder


def stream_newest30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 30 posts of each forum, kept up over several micro-batches and a restart."""
    configure(spark)
    folder = run_folder(spark, "newest30")
    session = session_for(spark)
    rows = batch_posts(spark, sf_dir).select("post_id", "subreddit", "created_utc", "url")
    kept = (["subreddit"], [F.col("created_utc").desc(), F.col("post_id")], NEWEST_PER_FORUM)
    for part in (0, 1):
        some = rows.filter(F.col("post_id") % 2 == part)
        some.repartition(4, "post_id").write.mode("append").parquet(f"{folder}/feed")
        feed = session.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/feed")
        run.drain(run.each_batch(feed, "append", newest.writer(f"{folder}/newest", *kept)), f"{folder}/checkpoint")
    return ntz(newest.view(spark, f"{folder}/newest", rows.schema, *kept, rank="newest_rank"), "created_utc")


def stream_result_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean scores in a named result table, read by SQL after a bounded wait."""
    configure(spark)
    folder = run_folder(spark, "result")
    session = session_for(spark)
    means = speed.running_means(scored(session, sf_dir))
    name = "result_" + folder.rsplit("-", 1)[1]
    run.drain(run.memory_table(means, name, "complete"), f"{folder}/checkpoint", timeout=600)
    return rounded(session.sql(f"SELECT * FROM {name}"), 6, *AVERAGES)


QUERIES = {
    "stream_global_avg": stream_global_avg,
    "stream_posts_5m": stream_posts_5m,
    "stream_posts_sliding": stream_posts_sliding,
    "stream_change": stream_change,
    "stream_speed_rows": stream_speed_rows,
    "stream_dedup": stream_dedup,
    "stream_raw_sink": stream_raw_sink,
    "stream_raw_posts": stream_raw_posts,
    "stream_quarantine": stream_quarantine,
    "stream_result_table": stream_result_table,
    "stream_newest30": stream_newest30,
    "stream_late_corrections": stream_late_corrections,
    "stream_corrections_made": stream_corrections_made,
    "daily_incremental": daily_incremental,
    "daily_job": daily_job,
    "daily_rows_damaged": daily_rows_damaged,
    "serving_tables": serving_tables,
}

# Ticks as the messages carry them, prices that can't be read as NULL.
_DAMAGED = TICKS_SQL.replace("value AS price_usd", "CASE WHEN NOT (event_id % 3 = 0 OR hour(ts) >= 22) THEN value END AS price_usd")
_DAMAGED_POSTS = POSTS_SQL.replace("e.ts AS created_utc", "date_trunc('second', e.ts) AS created_utc")
_DAMAGED_SPEED = SPEED_SQL.replace(
    "lag(bitcoin_price) OVER (PARTITION BY symbol ORDER BY timestamp)",
    "last_value(bitcoin_price IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
)
_DAMAGED_INPUT = f"{_DAMAGED},\n{_DAMAGED_POSTS},\n{SCORED_SQL},\n{_DAMAGED_SPEED},\n{DAILY_SQL}"
_OVER = f"day BETWEEN DATE '{JOBS_AS_OF.date()}' - 7 AND DATE '{JOBS_AS_OF.date()}' - 1"

SQL = {
    "stream_global_avg": f"WITH {POSTS_SQL},\n{SCORED_SQL}\nSELECT {_AVERAGES_SQL} FROM scored",
    "stream_posts_5m": f"""WITH {POSTS_SQL}
SELECT time_bucket(INTERVAL '5 minutes', created_utc) AS window_start, count(*) AS posts
FROM posts GROUP BY ALL""",
    "stream_posts_sliding": f"""WITH {POSTS_SQL}
SELECT date_trunc('minute', created_utc) - to_minutes(i) AS window_start, count(*) AS posts
FROM posts, range(5) r(i)
GROUP BY ALL""",
    "stream_change": f"""WITH {TICKS_SQL},
rows AS (SELECT symbol, time_bucket(INTERVAL '5 minutes', last_updated) AS window_start,
                max(last_updated) AS timestamp, arg_max(price_usd, last_updated) AS bitcoin_price
         FROM ticks GROUP BY ALL),
lagged AS (SELECT *, lag(bitcoin_price) OVER (PARTITION BY symbol ORDER BY timestamp) AS p FROM rows)
SELECT symbol, window_start, timestamp, bitcoin_price,
       round(coalesce((bitcoin_price - p) / nullif(p, 0) * 100, 0) + 1e-10, 6) AS change_from_kafka
FROM lagged""",
    "stream_speed_rows": f"WITH {SPEED_INPUT_SQL}\n{SPEED_VIEW_SQL}",
    "stream_dedup": f"WITH {POSTS_SQL} SELECT post_id, created_utc, title FROM posts",
    "stream_raw_sink": f"""WITH {TICKS_SQL}
SELECT {TICK_ID_SQL} AS id, name, symbol, num_market_pairs, max_supply, infinite_supply, last_updated,
       price_usd, market_cap_usd, volume_24h_usd, percent_change_24h, percent_change_1h,
       CAST(last_updated AS DATE) AS event_day
FROM ticks""",
    "stream_raw_posts": f"""WITH {POSTS_SQL}
SELECT {POST_ID_SQL} AS id, date_trunc('second', created_utc) AS created_utc, subreddit, selftext, title,
       subreddit_name_prefixed, round(CAST(score / 100.0 AS DOUBLE) + 1e-10, 4) AS upvote_ratio, category, score,
       created, num_comments, url, view_count, send_replies, CAST(created_utc AS DATE) AS event_day
FROM posts""",
    "stream_quarantine": f"""WITH {TICKS_SQL}
SELECT 'cut ' || tick_id AS message FROM ticks WHERE tick_id % 5 = 0""",
    "stream_result_table": f"WITH {POSTS_SQL},\n{SCORED_SQL}\nSELECT {_AVERAGES_SQL} FROM scored",
    "stream_newest30": SOCIAL_SQL["newest30_per_forum"],
    "stream_late_corrections": f"WITH {SPEED_INPUT_SQL}\n{SPEED_VIEW_SQL}",
    "stream_corrections_made": f"""WITH {TICKS_SQL},
{POSTS_SQL},
timed AS (
  SELECT 'tick' AS kind, last_updated AS moment FROM ticks UNION ALL SELECT 'post', created_utc FROM posts),
marked AS (SELECT *, second(moment) % 5 = 0 AS held FROM timed)
SELECT kind, CAST(moment AS DATE) AS day, CAST(count(*) AS BIGINT) AS late_rows
FROM marked WHERE held AND moment < (SELECT max(moment) FROM marked WHERE NOT held) - INTERVAL 10 MINUTES
GROUP BY ALL""",
    "daily_incremental": f"WITH {SPEED_INPUT_SQL},\n{DAILY_SQL}\n{daily_sql_view('timestamp')}",
    "daily_job": f"""WITH {_DAMAGED_INPUT}
SELECT symbol, timestamp, open_price, close_price, posts_last_day, change_from_kafka, avg_sentiment_bullish,
       avg_sentiment_bearish, avg_sentiment_neutral, predicted_bitcoin_price, Max_Price, Min_Price, day AS event_day
FROM ({daily_sql_view("CAST(day + 1 AS TIMESTAMP) - INTERVAL 1 SECOND")}) WHERE {_OVER}""",
    "daily_rows_damaged": f"WITH {_DAMAGED_INPUT}\n{daily_sql_view('timestamp')}",
    "serving_tables": f"""WITH {_DAMAGED_INPUT}
SELECT day AS event_day, symbol, close_price, Max_Price, count(*) AS speed_rows
FROM ({daily_sql_view('timestamp')}) d
JOIN (SELECT symbol, CAST(timestamp AS DATE) AS day FROM speed) USING (symbol, day)
WHERE {_OVER} GROUP BY ALL""",
}
