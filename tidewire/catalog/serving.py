"""Serving and raw tables written in batches and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.ingest import LISTING_SQL, TICK_ID_SQL, payloads
from tidewire.catalog.inputs import (
    FORUM_LIST,
    FORUM_LIST_SQL,
    POSTS_SQL,
    TICKS_SQL,
    ntz,
    posts,
    tick_messages,
    ticks,
)
from tidewire.operators import listing, messages as M, posts as P
from tidewire.plans.speed import latest_ticks
from tidewire.schemas import TICK_TOPIC, struct
from tidewire.session import run_folder
from tidewire.sources import tables, topics
from tidewire.sources.tables import read_topic_table
from tidewire.streaming import serving

ROW = struct({"symbol": "string", "window_start": "timestamp", "timestamp": "timestamp", "bitcoin_price": "double"})


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches with keys in common; the second runs twice, as after a failure."""
    rows = latest_ticks(ticks(spark, sf_dir)).select(*ROW.fieldNames())
    log = f"{run_folder(spark, 'upsert')}/log"
    even_hour = F.hour("window_start") % 2 == 0
    higher = rows.filter(even_hour).withColumn("bitcoin_price", F.col("bitcoin_price") + 1)
    zero = rows.filter(F.hour("window_start") == 0).withColumn("bitcoin_price", F.lit(0.0))
    for batch_id, batch in [(0, rows), (1, higher), (2, zero), (1, higher)]:
        serving.append_batch(batch, batch_id, log, "window_start")
    return ntz(serving.latest(spark, log, ROW, ["symbol", "window_start"]), "window_start", "timestamp")


def append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick messages typed, given an id and appended to the raw table."""
    path = f"{run_folder(spark, 'append')}/{TICK_TOPIC}"
    serving.append_raw(M.landed(tick_messages(spark, sf_dir), TICK_TOPIC), path)
    rows = read_topic_table(spark, path, TICK_TOPIC)
    return ntz(rows.select("id", "symbol", "last_updated", "price_usd", "event_day"), "last_updated")


def publish_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick messages published to a topic kept as files, read back and typed."""
    path = f"{run_folder(spark, 'publish')}/feed"
    topics.write_topic(tick_messages(spark, sf_dir), fmt="parquet", path=path)
    feed = topics.read_topics(spark, [TICK_TOPIC], fmt="parquet", path=path)
    typed = M.conform(M.parse(feed, TICK_TOPIC), TICK_TOPIC)
    return ntz(typed.select("id", "symbol", "last_updated", "price_usd"), "last_updated")


def landed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing payloads landed as text files; every entry of every payload."""
    path = f"{run_folder(spark, 'listings')}/landed"
    payloads(spark, sf_dir).select("value").write.text(path)
    found = listing.extract_all(tables.read_listings(spark, path, per_line=True))
    rows = listing.table_names(found).select("symbol", "last_updated", "price_usd", "market_cap_usd")
    return ntz(rows, "last_updated")


def landed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum posts landed as JSON lines with the forum as an object; allowed forums only."""
    path = f"{run_folder(spark, 'submissions')}/landed"
    rows = posts(spark, sf_dir)
    forum = F.struct(F.col("subreddit").alias("display_name")).alias("subreddit")
    seconds = F.unix_seconds("created_utc").cast("double").alias("created_utc")
    rows.select(seconds, forum, "title", "selftext", "url").write.json(path, ignoreNullFields=False)
    landed = P.project_submissions(tables.read_submissions(spark, path))
    return P.of_forums(landed, FORUM_LIST).select("created_utc", "subreddit", "title", "selftext", "url")


QUERIES = {
    "upsert_latest": upsert_latest,
    "append_raw": append_raw,
    "publish_ticks": publish_ticks,
    "landed_listings": landed_listings,
    "landed_posts": landed_posts,
}

SQL = {
    "upsert_latest": f"""WITH {TICKS_SQL}
SELECT symbol, window_start, max(last_updated) AS timestamp,
       CASE WHEN hour(window_start) = 0 THEN 0 WHEN hour(window_start) % 2 = 0
            THEN arg_max(price_usd, last_updated) + 1 ELSE arg_max(price_usd, last_updated) END AS bitcoin_price
FROM (SELECT *, time_bucket(INTERVAL '5 minutes', last_updated) AS window_start FROM ticks)
GROUP BY symbol, window_start""",
    "append_raw": f"""WITH {TICKS_SQL}
SELECT {TICK_ID_SQL} AS id, symbol, last_updated, price_usd, CAST(last_updated AS DATE) AS event_day
FROM ticks""",
    "publish_ticks": f"""WITH {TICKS_SQL}
SELECT {TICK_ID_SQL} AS id, symbol, last_updated, price_usd FROM ticks""",
    "landed_listings": f"""SELECT symbol, last_updated, price_usd, market_cap_usd
FROM ({LISTING_SQL} GROUP BY symbol, polled_at)""",
    "landed_posts": f"""WITH {POSTS_SQL}
SELECT strftime(created_utc, '%Y-%m-%d %H:%M:%S') AS created_utc, subreddit, title, selftext, url
FROM posts WHERE subreddit IN ({FORUM_LIST_SQL})""",
}
