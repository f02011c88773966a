"""Messages, listings, landed posts: parse, conform, quarantine, split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.inputs import (
    ASSET,
    POSTS_SQL,
    TICKS_SQL,
    as_ticks,
    events,
    ntz,
    post_messages,
    posts,
    rounded,
    tick_messages,
    ticks,
)
from tidewire.functions import scalars as S
from tidewire.operators import listing, messages as M, posts as P
from tidewire.schemas import POST_TOPIC, SUBMISSION_SCHEMA, TICK_KEYS, TICK_TOPIC

ISO_SQL = "strftime(last_updated, '%Y-%m-%dT%H:%M:%S.%fZ')"
NUMBERS = [column for column, kind in TICK_KEYS.values() if kind == "double"]


def parse_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = M.parse(tick_messages(spark, sf_dir), TICK_TOPIC, "tick_id")
    # The text form of large numbers is the writer's choice, so numbers are compared as numbers.
    columns = [
        (F.col(f"`{key}`").cast("double") if kind == "double" else F.col(f"`{key}`")).alias(column)
        for key, (column, kind) in TICK_KEYS.items()
    ]
    return parsed.select("tick_id", *columns)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("at", S.timestamp_text(F.col("ts")))
    rows = rows.withColumn("k", F.from_json("props", "k int")["k"])
    body = F.struct("event_id", "user_id", "event_type", "value", "at", F.struct("k").alias("props"))
    shape = "event_id bigint, user_id bigint, event_type string, value double, at string, props struct<k: int>"
    back = rows.select(F.from_json(F.to_json(body), shape).alias("data"))
    return back.select("data.event_id", "data.user_id", "data.event_type", "data.value", "data.at", "data.props.k")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages: a third of the counter values get a cut, a list or plain text."""
    damaged = M.tick_message(as_ticks(events(spark, sf_dir)), "tick_id", "num_market_pairs")
    text, kind = F.col("value").cast("string"), F.col("num_market_pairs") % 10
    value = (
        F.when(kind == 0, F.substring(text, F.lit(1), F.length(text) - 1))
        .when(kind == 1, F.concat(F.lit("[1, "), F.col("tick_id"), F.lit("]")))
        .when(kind == 2, F.concat(F.lit("not json "), F.col("tick_id")))
        .otherwise(text)
    )
    flagged = M.parse_or_flag(
        damaged.withColumn("value", value.cast("binary")), TICK_TOPIC, "tick_id"
    )
    # Both branches read one parse.
    return flagged.select(
        "tick_id",
        F.col(M.CORRUPT).isNotNull().alias("is_quarantined"),
        F.when(F.col(M.CORRUPT).isNull(), F.col("`Price (USD)`").try_cast("double")).alias("price_usd"),
    )


def select_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = M.parse(tick_messages(spark, sf_dir), TICK_TOPIC)
    chosen = M.select_fields(parsed, TICK_TOPIC)
    return chosen.select("last_updated", F.col("`Price (USD)`").cast("double").alias("price_usd"))


def select_fields_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.select_fields(M.parse(post_messages(spark, sf_dir), POST_TOPIC), POST_TOPIC)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per hour holding the newest entry of each asset: one element per asset."""
    newest = (
        ticks(spark, sf_dir)
        .groupBy(F.date_trunc("hour", "last_updated").alias("polled_at"), "symbol")
        .agg(
            F.max("last_updated").alias("last_updated"),
            *[F.max_by(c, "last_updated").alias(c) for c in ["num_market_pairs", "max_supply", "infinite_supply", *NUMBERS]],
        )
    )
    usd = F.struct(
        F.col("price_usd").alias("price"),
        F.col("market_cap_usd").alias("market_cap"),
        F.col("volume_24h_usd").alias("volume_24h"),
        "percent_change_24h",
        "percent_change_1h",
    )
    entry = F.struct(
        "symbol",
        F.concat(F.lit("Asset "), "symbol").alias("name"),
        "num_market_pairs",
        "max_supply",
        "infinite_supply",
        F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("last_updated"),
        F.struct(usd.alias("USD")).alias("quote"),
    )
    data = F.sort_array(F.collect_list(entry)).alias("data")
    return newest.groupBy("polled_at").agg(data).select("polled_at", F.to_json(F.struct("data")).alias("value"))


def listing_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.extract_asset(payloads(spark, sf_dir), ASSET, "polled_at")
    return ntz(listing.table_names(found, "polled_at"), "polled_at", "last_updated")


def listing_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.extract_all(payloads(spark, sf_dir), "polled_at")
    return ntz(listing.table_names(found, "polled_at"), "polled_at", "last_updated")


LISTING_SQL = f"""WITH {TICKS_SQL}
SELECT date_trunc('hour', last_updated) AS polled_at, arg_max(name, last_updated) AS name, symbol,
       arg_max(num_market_pairs, last_updated) AS num_market_pairs,
       arg_max(max_supply, last_updated) AS max_supply,
       arg_max(infinite_supply, last_updated) AS infinite_supply,
       max(last_updated) AS last_updated, arg_max(price_usd, last_updated) AS price_usd,
       arg_max(market_cap_usd, last_updated) AS market_cap_usd,
       arg_max(volume_24h_usd, last_updated) AS volume_24h_usd,
       arg_max(percent_change_24h, last_updated) AS percent_change_24h,
       arg_max(percent_change_1h, last_updated) AS percent_change_1h
FROM ticks"""


def currency_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly listings that quote each asset in its own currencies; those of five o'clock are cut short."""
    newest = (
        ticks(spark, sf_dir)
        .groupBy(F.date_trunc("hour", "last_updated").alias("polled_at"), "symbol")
        .agg(
            F.max("last_updated").alias("last_updated"),
            *[F.max_by(c, "last_updated").alias(c) for c in ("num_market_pairs", "price_usd")],
        )
    )
    pairs, price = F.col("num_market_pairs"), F.col("price_usd")
    quotes = F.create_map(
        F.lit("USD"), F.struct(price.alias("price")),
        F.lit("EUR"), F.when(pairs % 2 == 0, F.struct((price * 2).alias("price"))),
        F.concat(F.lit("X"), pairs % 7), F.struct((price * 4).alias("price")),
    )
    entry = F.struct(
        "symbol",
        F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("last_updated"),
        F.map_filter(quotes, lambda _, quote: quote.isNotNull()).alias("quote"),
    )
    text = F.to_json(F.struct(F.collect_list(entry).alias("data")))
    rows = newest.groupBy("polled_at").agg(text.alias("value"))
    cut = F.when(F.hour("polled_at") == 5, F.left("value", F.length("value") - 2)).otherwise(F.col("value"))
    return rows.select("polled_at", cut.alias("value"))


def listing_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.extract_currencies(currency_payloads(spark, sf_dir), "polled_at")
    return ntz(found.select("polled_at", "symbol", "last_updated", "currency", "price"), "polled_at", "last_updated")


def listing_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(listing.unreadable(currency_payloads(spark, sf_dir)).select("polled_at"), "polled_at")


def post_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed posts with the forum as an object and an attribute nobody asked for."""
    rows = posts(spark, sf_dir)
    landed = rows.select(
        "post_id",
        F.to_json(
            F.struct(
                F.unix_seconds("created_utc").cast("double").alias("created_utc"),
                F.struct(F.col("subreddit").alias("display_name"), F.lit(1).alias("subscribers")).alias("subreddit"),
                "selftext", "title", "subreddit_name_prefixed", "upvote_ratio", "category", "score",
                F.unix_seconds("created").alias("created"), "num_comments", "url", "view_count",
                "send_replies", F.lit("x").alias("author_flair"),
            )
        ).alias("value"),
    )
    submissions = landed.select("post_id", F.from_json("value", SUBMISSION_SCHEMA).alias("s")).select("post_id", "s.*")
    projected = P.project_submissions(submissions, "post_id")
    return projected.withColumn("upvote_ratio", F.round(F.col("upvote_ratio").cast("double"), 4))


def conform_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = M.parse(tick_messages(spark, sf_dir), TICK_TOPIC, "tick_id")
    return ntz(M.conform(parsed, TICK_TOPIC, "tick_id"), "last_updated")


def conform_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = M.parse(post_messages(spark, sf_dir), POST_TOPIC, "post_id")
    typed = ntz(M.conform(parsed, POST_TOPIC, "post_id"), "created_utc", "created")
    return rounded(typed.withColumn("upvote_ratio", F.col("upvote_ratio").cast("double")), 4, "upvote_ratio")


def content_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = posts(spark, sf_dir).withColumn("created_utc", S.timestamp_text(F.col("created_utc")))
    return rows.select("post_id", M.natural_id(POST_TOPIC).alias("id"))


def _part(expression: str) -> str:
    return f"coalesce(length({expression}) || ':' || {expression}, '-')"


POST_ID_SQL = "sha256(" + " || '|' || ".join(
    _part(e) for e in ["subreddit", "strftime(created_utc, '%Y-%m-%d %H:%M:%S')", "title", "url"]
) + ")"
# Spark writes a timestamp as text without trailing zeros in the fraction.
TICK_ID_SQL = "sha256(" + " || '|' || ".join(
    _part(e) for e in [
        "symbol",
        "regexp_replace(regexp_replace(strftime(last_updated, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')",
    ]
) + ")"


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics on one feed, and a topic nobody knows."""
    tick = M.tick_message(ticks(spark, sf_dir), "tick_id")
    tick = tick.withColumnRenamed("tick_id", "message_id")
    post = M.post_message(posts(spark, sf_dir), "post_id").withColumnRenamed("post_id", "message_id")
    stray = events(spark, sf_dir).filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("message_id"),
        F.lit("audit").alias("topic"),
        F.col("props").cast("binary").alias("value"),
    )
    return M.union_topics(tick, post, stray)


def topic_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_messages(spark, sf_dir).groupBy("topic").agg(
        F.count("*").alias("messages"), F.countDistinct("message_id").alias("distinct_messages")
    )


def topic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message by the branch that takes it."""
    feed = mixed_messages(spark, sf_dir)
    branches = [
        M.of_topic(feed, TICK_TOPIC),
        M.of_topic(feed, POST_TOPIC),
        M.unsupported(feed),
    ]
    routed = [b.select("message_id", M.route(F.col("topic")).alias("branch")) for b in branches]
    return M.union_topics(*routed)


QUERIES = {
    "parse_ticks": parse_ticks,
    "json_roundtrip": json_roundtrip,
    "quarantine": quarantine,
    "select_fields": select_fields,
    "select_fields_posts": select_fields_posts,
    "listing_extract": listing_extract,
    "listing_all": listing_all,
    "listing_currencies": listing_currencies,
    "listing_unreadable": listing_unreadable,
    "post_project": post_project,
    "conform_ticks": conform_ticks,
    "conform_posts": conform_posts,
    "content_id": content_id,
    "topic_union": topic_union,
    "topic_split": topic_split,
}

_TYPED_TICK_SQL = """name, symbol, num_market_pairs, max_supply, infinite_supply, last_updated,
       price_usd, market_cap_usd, volume_24h_usd, percent_change_24h, percent_change_1h"""

SQL = {
    "parse_ticks": f"""WITH {TICKS_SQL}
SELECT tick_id, name, symbol, CAST(num_market_pairs AS VARCHAR) AS num_market_pairs,
       CAST(max_supply AS VARCHAR) AS max_supply, CAST(infinite_supply AS VARCHAR) AS infinite_supply,
       {ISO_SQL} AS last_updated, price_usd, market_cap_usd, volume_24h_usd,
       percent_change_24h, percent_change_1h
FROM ticks""",
    "json_roundtrip": """SELECT event_id, user_id, event_type, value,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
FROM events""",
    "quarantine": f"""WITH {TICKS_SQL}
SELECT tick_id, num_market_pairs % 10 IN (0, 1, 2) AS is_quarantined,
       CASE WHEN num_market_pairs % 10 NOT IN (0, 1, 2) THEN price_usd END AS price_usd
FROM ticks""",
    "select_fields": f"WITH {TICKS_SQL} SELECT {ISO_SQL} AS last_updated, price_usd FROM ticks",
    "select_fields_posts": f"WITH {POSTS_SQL} SELECT selftext, title FROM posts",
    "listing_extract": f"{LISTING_SQL} WHERE symbol = '{ASSET}' GROUP BY symbol, polled_at",
    "listing_all": f"{LISTING_SQL} GROUP BY symbol, polled_at",
    "listing_currencies": f"""WITH {TICKS_SQL},
newest AS (
  SELECT date_trunc('hour', last_updated) AS polled_at, symbol, max(last_updated) AS newest_at,
         arg_max(num_market_pairs, last_updated) AS pairs, arg_max(price_usd, last_updated) AS price
  FROM ticks GROUP BY ALL),
quoted AS (
  SELECT *, 'USD' AS currency, 1 AS rate FROM newest
  UNION ALL SELECT *, 'EUR', 2 FROM newest WHERE pairs % 2 = 0
  UNION ALL SELECT *, 'X' || pairs % 7, 4 FROM newest)
SELECT polled_at, symbol, newest_at AS last_updated, currency, price * rate AS price
FROM quoted WHERE hour(polled_at) <> 5""",
    "listing_unreadable": f"""WITH {TICKS_SQL}
SELECT DISTINCT date_trunc('hour', last_updated) AS polled_at FROM ticks WHERE hour(last_updated) = 5""",
    "post_project": f"""WITH {POSTS_SQL}
SELECT post_id, strftime(created_utc, '%Y-%m-%d %H:%M:%S') AS created_utc, subreddit, selftext, title,
       subreddit_name_prefixed, CAST(NULL AS VARCHAR) AS _comments_by_id,
       round(CAST(score / 100.0 AS DOUBLE), 4) AS upvote_ratio, category, CAST(score AS VARCHAR) AS score,
       CAST(CAST(epoch(created) AS BIGINT) AS VARCHAR) AS created,
       CAST(num_comments AS VARCHAR) AS num_comments, url, CAST(view_count AS VARCHAR) AS view_count,
       CAST(send_replies AS VARCHAR) AS send_replies
FROM posts""",
    "conform_ticks": f"""WITH {TICKS_SQL}
SELECT tick_id, {TICK_ID_SQL} AS id, {_TYPED_TICK_SQL}
FROM ticks""",
    "conform_posts": f"""WITH {POSTS_SQL}
SELECT post_id, {POST_ID_SQL} AS id, date_trunc('second', created_utc) AS created_utc, subreddit,
       selftext, title, subreddit_name_prefixed, round(CAST(score / 100.0 AS DOUBLE), 4) AS upvote_ratio,
       category, score, created, num_comments, url, view_count, send_replies
FROM posts""",
    "content_id": f"WITH {POSTS_SQL} SELECT post_id, {POST_ID_SQL} AS id FROM posts",
    "topic_union": f"""WITH {POSTS_SQL}
SELECT topic, count(*) AS messages, count(DISTINCT id) AS distinct_messages
FROM (SELECT 'bitcoin_data' AS topic, event_id AS id FROM events
      UNION ALL SELECT 'reddit_data', post_id FROM posts
      UNION ALL SELECT 'audit', event_id FROM events WHERE event_type = 'error')
GROUP BY topic""",
    "topic_split": f"""WITH {POSTS_SQL}
SELECT event_id AS message_id, 'bitcoin_data' AS branch FROM events
UNION ALL SELECT post_id, 'reddit_data' FROM posts
UNION ALL SELECT event_id, 'unsupported' FROM events WHERE event_type = 'error'""",
}
