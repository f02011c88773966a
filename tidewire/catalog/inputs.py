"""The given tables seen as ticks, posts and messages, in Spark and in SQL.

Ticks are the events, the event type being the asset. Posts are the documents, each at
the time of an event; the whole text of every document is used, as the body or (for posts
without one) as the title.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import messages as M
from tidewire.session import configure

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.datetime(2024, 1, 15, 23, 59)
AS_OF_SQL = "TIMESTAMP '2024-01-15 23:59:00'"
# A poll with posts in its five minutes.
POLL_AT = dt.datetime(2024, 1, 15, 4, 10)
POLL_AT_SQL = "TIMESTAMP '2024-01-15 04:10:00'"
FORUM_LIST = ["src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7"]
FORUM_LIST_SQL = ", ".join(f"'{name}'" for name in FORUM_LIST)
ASSET = "purchase"
# Documents in a row are so many events apart; a prime, so that they meet different events.
SPACING = 7919

# Words that occur in the given documents, standing in for market words.
DOCUMENT_WORDS = {
    "bullish": ["the", "and", "for", "with", "les", "und", "los"],
    "bearish": ["of", "to", "from", "at", "des", "der", "del"],
    "neutral": ["is", "it", "was", "are", "est", "ist", "una"],
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def props_k() -> Column:
    return F.from_json("props", "k int")["k"]


def as_ticks(event_rows: DataFrame) -> DataFrame:
    k = props_k()
    return event_rows.select(
        F.col("event_id").alias("tick_id"),
        F.concat(F.lit("Asset "), "event_type").alias("name"),
        F.col("event_type").alias("symbol"),
        k.alias("num_market_pairs"),
        (F.col("user_id") * 1000).alias("max_supply"),
        (F.col("user_id") % 2 == 0).alias("infinite_supply"),
        F.col("ts").alias("last_updated"),
        F.col("value").alias("price_usd"),
        (F.col("value") * 1000000).alias("market_cap_usd"),
        (F.col("value") * 1000).alias("volume_24h_usd"),
        (k - 50).cast("double").alias("percent_change_24h"),
        ((k - 50) / F.lit(10.0)).alias("percent_change_1h"),
    )


def post_texts(documents: DataFrame) -> DataFrame:
    """Documents with the title and the body of their posts, which no event has a part in."""
    doc_id = F.col("doc_id")
    selftext = (
        F.when(doc_id % 3 == 0, F.lit(None)).when(doc_id % 7 == 0, F.lit("")).otherwise(F.col("text"))
    )
    has_body = F.length(selftext) > 0
    title = F.when(has_body, F.concat(F.lit("Document "), doc_id)).otherwise(F.col("text"))
    return documents.select("doc_id", title.alias("title"), selftext.alias("selftext"), "lang", "source")


def as_posts(event_rows: DataFrame, documents: DataFrame, all_events: DataFrame) -> DataFrame:
    """``event_rows`` may be a part of the events, or a stream of them."""
    return posts_at_events(event_rows, post_texts(documents), all_events)


def posts_at_events(event_rows: DataFrame, texts: DataFrame, all_events: DataFrame, *keep: str) -> DataFrame:
    """Posts from ``post_texts``, with columns that these have got since, as scores.

    A caller that takes such columns instead of the texts has none of the texts shuffled.
    """
    event_count = all_events.agg(F.count("*").alias("n")).scalar()
    doc_id, k = F.col("doc_id"), props_k()
    sent = event_rows.select("event_id", "ts", "user_id", k.alias("k"))
    texts = texts.withColumn("event_id", doc_id * SPACING % event_count)
    return sent.join(texts, "event_id").select(
        doc_id.alias("post_id"),
        F.col("ts").alias("created_utc"),
        F.col("source").alias("subreddit"),
        "selftext",
        "title",
        F.concat(F.lit("r/"), "source").alias("subreddit_name_prefixed"),
        (F.col("k") / 100).cast("float").alias("upvote_ratio"),
        F.col("lang").alias("category"),
        F.col("k").alias("score"),
        F.date_trunc("second", "ts").alias("created"),
        (F.col("user_id") % 100).cast("int").alias("num_comments"),
        F.concat(F.lit("https://example.org/p/"), doc_id).alias("url"),
        F.col("user_id").cast("int").alias("view_count"),
        (F.col("user_id") % 2 == 0).alias("send_replies"),
        *keep,
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(events(spark, sf_dir))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return as_posts(rows, read(spark, sf_dir, "documents"), rows)


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.tick_message(ticks(spark, sf_dir), "tick_id")


def post_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.post_message(posts(spark, sf_dir), "post_id")


def ntz(df: DataFrame, *names: str) -> DataFrame:
    """Zoned timestamps back to the zone-less type of the given tables."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Rounded for comparison with the SQL twin, which does the same.

    Exact halves at the last digit are common among shares and ratios, and the
    order of a sum then decides which way they go. The small shift settles that.
    """
    return df.withColumns({name: F.round(F.col(name) + 1e-10, digits) for name in names})


# SQL twins.

TICKS_SQL = """ticks AS (
  SELECT event_id AS tick_id, 'Asset ' || event_type AS name, event_type AS symbol,
         k AS num_market_pairs, user_id * 1000 AS max_supply, user_id % 2 = 0 AS infinite_supply,
         ts AS last_updated, value AS price_usd, value * 1000000 AS market_cap_usd,
         value * 1000 AS volume_24h_usd, CAST(k - 50 AS DOUBLE) AS percent_change_24h,
         (k - 50) / 10.0::DOUBLE AS percent_change_1h
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events))"""

POSTS_SQL = f"""posts AS (
  SELECT post_id, created_utc, subreddit, selftext,
         CASE WHEN length(selftext) > 0 THEN 'Document ' || post_id ELSE text END AS title,
         'r/' || subreddit AS subreddit_name_prefixed, CAST(k / 100.0 AS FLOAT) AS upvote_ratio,
         category, k AS score, date_trunc('second', created_utc) AS created,
         CAST(user_id % 100 AS INTEGER) AS num_comments,
         'https://example.org/p/' || post_id AS url, CAST(user_id AS INTEGER) AS view_count,
         user_id % 2 = 0 AS send_replies
  FROM (
    SELECT d.doc_id AS post_id, e.ts AS created_utc, d.source AS subreddit, d.text,
           d.lang AS category, e.user_id, CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS k,
           CASE WHEN d.doc_id % 3 = 0 THEN NULL WHEN d.doc_id % 7 = 0 THEN '' ELSE d.text END
             AS selftext
    FROM documents d JOIN events e ON e.event_id = d.doc_id * {SPACING} % (SELECT count(*) FROM events)))"""

POST_TEXT_SQL = "CASE WHEN selftext IS NULL THEN title ELSE title || ' : ' || selftext END"


def _hits_sql(label: str) -> str:
    words = ", ".join(f"'{word}'" for word in DOCUMENT_WORDS[label])
    return f"len([x for x in tokens if x IN ({words})])"


SCORED_SQL = f"""counted AS (
  SELECT post_id, created_utc, subreddit, {_hits_sql('bullish')} AS up,
         {_hits_sql('bearish')} AS down, {_hits_sql('neutral')} AS same
  FROM (SELECT *, regexp_split_to_array(lower({POST_TEXT_SQL}), '[^a-z]+') AS tokens FROM posts)),
scored AS (
  SELECT post_id, created_utc, subreddit, (up + 1) / CAST(up + down + same + 2 AS DOUBLE) AS bullish,
         (down + 1) / CAST(up + down + same + 2 AS DOUBLE) AS bearish,
         (same + 1) / CAST(up + down + same + 2 AS DOUBLE) AS neutral
  FROM counted)"""

SPEED_SQL = """speed AS (
  SELECT symbol, window_start, timestamp, bitcoin_price,
         CAST(coalesce(n, 0) AS INTEGER) AS posts_last_5_minutes,
         coalesce((bitcoin_price - prev) / nullif(prev, 0) * 100, 0) AS change_from_kafka,
         coalesce(up, 0.5) AS avg_sentiment_bullish, coalesce(down, 0.5) AS avg_sentiment_bearish,
         coalesce(same, 0.5) AS avg_sentiment_neutral
  FROM (SELECT *, lag(bitcoin_price) OVER (PARTITION BY symbol ORDER BY timestamp) AS prev
        FROM (SELECT symbol, time_bucket(INTERVAL '5 minutes', last_updated) AS window_start,
                     max(last_updated) AS timestamp, arg_max(price_usd, last_updated) AS bitcoin_price
              FROM ticks GROUP BY ALL))
  LEFT JOIN (SELECT time_bucket(INTERVAL '5 minutes', created_utc) AS window_start, count(*) AS n,
                    avg(bullish) AS up, avg(bearish) AS down, avg(neutral) AS same
             FROM scored GROUP BY ALL) USING (window_start))"""

SPEED_INPUT_SQL = f"{TICKS_SQL},\n{POSTS_SQL},\n{SCORED_SQL},\n{SPEED_SQL}"

