"""Prices: ranges, latest rows, changes, daily rows, forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.catalog.inputs import (
    AS_OF,
    AS_OF_SQL,
    DOCUMENT_WORDS,
    SPEED_INPUT_SQL,
    TICKS_SQL,
    POSTS_SQL,
    events,
    ntz,
    posts,
    rounded,
    ticks,
)
from tidewire.functions import scalars as S
from tidewire.functions.forecast import model_forecaster, trend_forecaster
from tidewire.functions.sentiment import lexicon_scorer
from tidewire.operators.ordered import DAY, as_of, trailing
from tidewire.plans import daily, speed

SENTIMENTS = ["avg_sentiment_bullish", "avg_sentiment_bearish", "avg_sentiment_neutral"]


def speed_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed.speed_rows(ticks(spark, sf_dir), posts(spark, sf_dir), lexicon_scorer(DOCUMENT_WORDS))


def day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.day_range(ticks(spark, sf_dir), "last_updated", AS_OF)
    return ntz(rows.select("tick_id", "symbol", "last_updated", "price_usd"), "last_updated")


def five_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.day_range(ticks(spark, sf_dir), "last_updated", AS_OF, days_back=5)
    return ntz(rows.select("tick_id", "symbol", "last_updated", "price_usd"), "last_updated")


def day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts")
    rows = events(spark, sf_dir).select(
        "event_id",
        S.start_of_day(at).alias("start_of_day"),
        S.days_before(at, 1).alias("start_of_previous_day"),
        S.days_before(at, 5).alias("five_days_ago"),
    )
    return ntz(rows, "start_of_day", "start_of_previous_day", "five_days_ago")


def epoch_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("epoch_seconds", S.utc_to_epoch(F.col("ts")))
    back = S.epoch_to_utc(F.col("epoch_seconds"))
    rows = rows.select("event_id", "epoch_seconds", back.alias("at"), S.timestamp_text(back).alias("at_text"))
    return ntz(rows, "at")


def latest_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ticks(spark, sf_dir).groupBy("symbol").agg(
        F.max("last_updated").alias("last_updated"),
        speed.newest("price_usd", "last_updated").alias("price_usd"),
    )
    return ntz(newest, "last_updated")


def latest_speed_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = lexicon_scorer(DOCUMENT_WORDS)
    return speed_view(speed.latest_speed_row(ticks(spark, sf_dir), posts(spark, sf_dir), scorer))


def speed_view(rows: DataFrame) -> DataFrame:
    rows = rows.select(
        "symbol", "window_start", "timestamp", "bitcoin_price", "posts_last_5_minutes",
        "change_from_kafka", *SENTIMENTS,
    )
    return ntz(rounded(rows, 6, "change_from_kafka", *SENTIMENTS), "window_start", "timestamp")


def speed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_view(speed_input(spark, sf_dir))


def change_prev_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = speed.with_change(speed.latest_ticks(ticks(spark, sf_dir)))
    rows = rows.select("symbol", "timestamp", "bitcoin_price", "change_from_kafka")
    return ntz(rounded(rows, 6, "change_from_kafka"), "timestamp")


def pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of each value against its counter, which is 0 for some events."""
    k = F.from_json("props", "k int")["k"].cast("double")
    rows = events(spark, sf_dir).select(
        "event_id",
        S.pct_change(F.col("value"), k, 0.0).alias("change_or_zero"),
        S.pct_change(F.col("value"), k).alias("change_or_null"),
    )
    return rounded(rows, 6, "change_or_zero", "change_or_null")


def _changes(rows: DataFrame) -> DataFrame:
    return ntz(rounded(rows, 6, "change_percent", "price_usd", "previous_price"), "last_updated")


def pct_change_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(speed.price_changes(ticks(spark, sf_dir), ["symbol"]))


def pct_change_lag_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(speed.price_changes(ticks(spark, sf_dir), []))


def pct_change_lag_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with buckets of a day, so that many rows meet in each."""
    return _changes(speed.price_changes(ticks(spark, sf_dir), ["symbol"], span=DAY))


def avg_price_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ticks(spark, sf_dir).groupBy("last_updated").agg(F.avg("price_usd").alias("bitcoin_price"))
    return ntz(rounded(rows, 6, "bitcoin_price"), "last_updated")


def posts_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = posts(spark, sf_dir).groupBy(S.window_start(F.col("created_utc")).alias("window_start")).agg(
        F.count("selftext").alias("number_of_posts"), F.count("*").alias("all_posts")
    )
    return ntz(rows, "window_start")


def join_window_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = speed.draft_rows(ticks(spark, sf_dir), posts(spark, sf_dir))
    return ntz(rounded(rows, 6, "bitcoin_price", "change_percent"), "last_updated")


def asof_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = posts(spark, sf_dir).select("post_id", "created_utc")
    rows = as_of(
        asked,
        ticks(spark, sf_dir),
        "created_utc",
        "last_updated",
        {"tick_id": "tick_id", "price_usd": "price_usd"},
        ties=["tick_id"],
    )
    return ntz(rows, "created_utc")


def asof_price_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each post with the newest tick at or before it that the same user caused."""
    asked = posts(spark, sf_dir).select("post_id", "created_utc", F.col("view_count").cast("bigint").alias("user_id"))
    seen = ticks(spark, sf_dir).withColumn("user_id", F.expr("max_supply div 1000"))
    rows = as_of(
        asked, seen, "created_utc", "last_updated", {"tick_id": "tick_id", "price_usd": "price_usd"},
        by=["user_id"], ties=["tick_id"],
    )
    return ntz(rows, "created_utc")


def posts_trailing_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tick with the posts of the five minutes up to it."""
    asked = ticks(spark, sf_dir).select("tick_id", "symbol", "last_updated")
    sent = posts(spark, sf_dir).select("created_utc")
    rows = trailing(asked, sent, "last_updated", "created_utc", 5 * 60, "posts_last_5_minutes")
    return ntz(rows, "last_updated")


def scores_trailing_week_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tick with the posts of the same user in the week up to it, and the sum of their scores."""
    asked = ticks(spark, sf_dir).select("tick_id", F.expr("max_supply div 1000").alias("user_id"), "last_updated")
    sent = posts(spark, sf_dir).select(
        F.col("view_count").cast("bigint").alias("user_id"), "created_utc", F.col("score").cast("bigint").alias("score")
    )
    rows = trailing(
        asked, sent, "last_updated", "created_utc", 7 * 86_400, "posts_last_week", {"score": "score_last_week"}, by=["user_id"]
    )
    return ntz(rows, "last_updated")


def daily_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.daily_prices(ticks(spark, sf_dir), "last_updated", "price_usd", ["symbol"])
    return rounded(rows, 6, "change_from_kafka")


def sentiment_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.weighted_sentiment(speed_input(spark, sf_dir), ["symbol"])
    return rounded(rows, 6, *[f"weighted_{name.removeprefix('avg_')}" for name in SENTIMENTS])


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.daily_rows(speed_input(spark, sf_dir))
    return ntz(rounded(rows, 6, "change_from_kafka", "predicted_bitcoin_price", *SENTIMENTS), "timestamp")


def batch_row_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.daily_row_as_of(speed_input(spark, sf_dir), AS_OF)
    return ntz(rounded(rows, 6, "change_from_kafka", "predicted_bitcoin_price", *SENTIMENTS), "timestamp")


def _closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily.daily_prices(ticks(spark, sf_dir), "last_updated", "price_usd", ["symbol"])
    return daily.last_closes(days, ["symbol"])


def last5_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = F.col("last_closes")
    return _closes(spark, sf_dir).select(
        "symbol",
        "day",
        F.size(closes).alias("n_closes"),
        *[F.get(closes, F.lit(i)).alias(f"close_{i + 1}") for i in range(5)],
    )


def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = F.col("last_closes")
    rows = _closes(spark, sf_dir).filter(F.size(closes) == 5).withColumn("scaled", S.minmax_scale(closes))
    rows = rows.select(
        "symbol",
        "day",
        *[F.col("scaled")[i].alias(f"scaled_{i + 1}") for i in range(5)],
        S.minmax_restore(F.col("scaled")[4], closes).alias("restored_5"),
    )
    return rounded(rows, 6, *[f"scaled_{i + 1}" for i in range(5)], "restored_5")


def forecast_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = trend_forecaster()(F.col("last_closes")).alias("predicted_price")
    return rounded(_closes(spark, sf_dir).select("symbol", "day", forecast), 6, "predicted_price")


def _load_mean_model():
    """Stands in for a user model: the mean of the scaled closes."""
    return lambda data: data.mean(axis=1)


def forecast_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = model_forecaster(_load_mean_model)(F.col("last_closes")).alias("predicted_price")
    return rounded(_closes(spark, sf_dir).select("symbol", "day", forecast), 6, "predicted_price")


QUERIES = {
    "day_range": day_range,
    "five_day_range": five_day_range,
    "day_bounds": day_bounds,
    "epoch_utc": epoch_utc,
    "latest_tick": latest_tick,
    "latest_speed_row": latest_speed_row,
    "speed_rows": speed_rows,
    "change_prev_row": change_prev_row,
    "pct_change": pct_change,
    "pct_change_lag": pct_change_lag,
    "pct_change_lag_global": pct_change_lag_global,
    "pct_change_lag_crowded": pct_change_lag_crowded,
    "avg_price_by_time": avg_price_by_time,
    "posts_by_time": posts_by_time,
    "join_window_inner": join_window_inner,
    "asof_price": asof_price,
    "asof_price_by_user": asof_price_by_user,
    "posts_trailing_5m": posts_trailing_5m,
    "scores_trailing_week_by_user": scores_trailing_week_by_user,
    "daily_ohlc": daily_ohlc,
    "sentiment_weighted": sentiment_weighted,
    "batch_rows": batch_rows,
    "batch_row_as_of": batch_row_as_of,
    "last5_closes": last5_closes,
    "minmax_scale": minmax_scale,
    "forecast_trend": forecast_trend,
    "forecast_model": forecast_model,
}

SPEED_VIEW_SQL = """SELECT symbol, window_start, timestamp, bitcoin_price, posts_last_5_minutes,
       round(change_from_kafka + 1e-10, 6) AS change_from_kafka,
       round(avg_sentiment_bullish + 1e-10, 6) AS avg_sentiment_bullish,
       round(avg_sentiment_bearish + 1e-10, 6) AS avg_sentiment_bearish,
       round(avg_sentiment_neutral + 1e-10, 6) AS avg_sentiment_neutral
FROM speed"""


def _change_sql(partition: str, keys: str) -> str:
    return f"""WITH {TICKS_SQL},
by_time AS (SELECT {keys} last_updated, avg(price_usd) AS price_usd FROM ticks GROUP BY ALL),
lagged AS (SELECT *, lag(price_usd) OVER ({partition} ORDER BY last_updated) AS previous_price FROM by_time)
SELECT {keys} last_updated, round(price_usd + 1e-10, 6) AS price_usd, round(previous_price + 1e-10, 6) AS previous_price,
       round((price_usd - previous_price) / nullif(previous_price, 0) * 100 + 1e-10, 6) AS change_percent
FROM lagged"""


CLOSES_SQL = f"""{TICKS_SQL},
days AS (SELECT symbol, CAST(last_updated AS DATE) AS day, arg_max(price_usd, last_updated) AS close_price
         FROM ticks GROUP BY ALL),
closes AS (SELECT symbol, day, list(close_price) FILTER (close_price IS NOT NULL) OVER (
             PARTITION BY symbol ORDER BY day RANGE BETWEEN INTERVAL 4 DAYS PRECEDING AND CURRENT ROW) AS c
           FROM days)"""

DAILY_SQL = """daily AS (
  SELECT symbol, CAST(timestamp AS DATE) AS day, max(timestamp) AS timestamp,
         arg_min(bitcoin_price, timestamp) AS open_price,
         arg_max(bitcoin_price, timestamp) AS close_price,
         CAST(sum(posts_last_5_minutes) AS BIGINT) AS posts_last_day,
         avg(avg_sentiment_bullish) AS up, avg(avg_sentiment_bearish) AS down,
         avg(avg_sentiment_neutral) AS same, max(bitcoin_price) AS hi, min(bitcoin_price) AS lo
  FROM speed GROUP BY ALL),
numbered AS (SELECT *, day - DATE '2024-01-01' AS i FROM daily),
fitted AS (
  SELECT *, CASE WHEN count(close_price) OVER w = 5
              THEN regr_intercept(close_price, i) OVER w + regr_slope(close_price, i) OVER w * (i + 1)
              ELSE 0 END AS predicted
  FROM numbered
  WINDOW w AS (PARTITION BY symbol ORDER BY i RANGE BETWEEN 4 PRECEDING AND CURRENT ROW))"""


def daily_sql_view(timestamp: str) -> str:
    return f"""SELECT symbol, day, {timestamp} AS timestamp, coalesce(open_price, 0) AS open_price,
       coalesce(close_price, 0) AS close_price, posts_last_day,
       round((close_price - open_price) / nullif(open_price, 0) * 100 + 1e-10, 6) AS change_from_kafka,
       round(up + 1e-10, 6) AS avg_sentiment_bullish, round(down + 1e-10, 6) AS avg_sentiment_bearish,
       round(same + 1e-10, 6) AS avg_sentiment_neutral, round(predicted + 1e-10, 6) AS predicted_bitcoin_price,
       coalesce(hi, 0) AS Max_Price, coalesce(lo, 0) AS Min_Price
FROM fitted"""


SQL = {
    "day_range": f"""WITH {TICKS_SQL}
SELECT tick_id, symbol, last_updated, price_usd FROM ticks
WHERE last_updated >= date_trunc('day', {AS_OF_SQL}) AND last_updated < {AS_OF_SQL}""",
    "five_day_range": f"""WITH {TICKS_SQL}
SELECT tick_id, symbol, last_updated, price_usd FROM ticks
WHERE last_updated >= CAST(date_trunc('day', {AS_OF_SQL}) AS TIMESTAMP) - INTERVAL 5 DAYS
  AND last_updated < {AS_OF_SQL}""",
    "day_bounds": """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS start_of_day,
       CAST(date_trunc('day', ts) AS TIMESTAMP) - INTERVAL 1 DAY AS start_of_previous_day,
       CAST(date_trunc('day', ts) AS TIMESTAMP) - INTERVAL 5 DAYS AS five_days_ago
FROM events""",
    "epoch_utc": """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_seconds,
       date_trunc('second', ts) AS at, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_text
FROM events""",
    "latest_tick": f"""WITH {TICKS_SQL}
SELECT symbol, max(last_updated) AS last_updated, arg_max(price_usd, last_updated) AS price_usd
FROM ticks GROUP BY symbol""",
    "latest_speed_row": f"WITH {SPEED_INPUT_SQL}\n{SPEED_VIEW_SQL} ORDER BY timestamp DESC, symbol LIMIT 1",
    "speed_rows": f"WITH {SPEED_INPUT_SQL}\n{SPEED_VIEW_SQL}",
    "change_prev_row": f"""WITH {TICKS_SQL},
rows AS (SELECT symbol, time_bucket(INTERVAL '5 minutes', last_updated) AS w, max(last_updated) AS timestamp,
                arg_max(price_usd, last_updated) AS bitcoin_price FROM ticks GROUP BY ALL),
lagged AS (SELECT *, lag(bitcoin_price) OVER (PARTITION BY symbol ORDER BY timestamp) AS p FROM rows)
SELECT symbol, timestamp, bitcoin_price,
       round(coalesce((bitcoin_price - p) / nullif(p, 0) * 100, 0) + 1e-10, 6) AS change_from_kafka
FROM lagged""",
    "pct_change": """SELECT event_id, round(coalesce((value - k) / nullif(k, 0) * 100, 0) + 1e-10, 6) AS change_or_zero,
       round((value - k) / nullif(k, 0) * 100 + 1e-10, 6) AS change_or_null
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k FROM events)""",
    "pct_change_lag": _change_sql("PARTITION BY symbol", "symbol,"),
    "pct_change_lag_global": _change_sql("", ""),
    "pct_change_lag_crowded": _change_sql("PARTITION BY symbol", "symbol,"),
    "avg_price_by_time": f"""WITH {TICKS_SQL}
SELECT last_updated, round(avg(price_usd) + 1e-10, 6) AS bitcoin_price FROM ticks GROUP BY last_updated""",
    "posts_by_time": f"""WITH {POSTS_SQL}
SELECT time_bucket(INTERVAL '5 minutes', created_utc) AS window_start, count(selftext) AS number_of_posts,
       count(*) AS all_posts
FROM posts GROUP BY ALL""",
    # Row by row, as the draft job writes it.
    "join_window_inner": f"""WITH {TICKS_SQL},
{POSTS_SQL},
grouped AS (
  SELECT last_updated, avg(price_usd) AS bitcoin_price, count(title) AS number_of_posts
  FROM (SELECT *, time_bucket(INTERVAL '5 minutes', last_updated) AS w FROM ticks)
  JOIN (SELECT *, time_bucket(INTERVAL '5 minutes', created_utc) AS w FROM posts) USING (w)
  GROUP BY last_updated),
lagged AS (SELECT *, lag(bitcoin_price) OVER (ORDER BY last_updated) AS p FROM grouped)
SELECT last_updated, round(bitcoin_price + 1e-10, 6) AS bitcoin_price, number_of_posts,
       round((bitcoin_price - p) / nullif(p, 0) * 100 + 1e-10, 6) AS change_percent
FROM lagged""",
    "asof_price": f"""WITH {TICKS_SQL},
{POSTS_SQL}
SELECT post_id, created_utc, tick_id, price_usd
FROM posts ASOF LEFT JOIN ticks ON posts.created_utc >= ticks.last_updated""",
    "asof_price_by_user": f"""WITH {TICKS_SQL},
{POSTS_SQL}
SELECT post_id, created_utc, p.user_id, tick_id, price_usd
FROM (SELECT post_id, created_utc, CAST(view_count AS BIGINT) AS user_id FROM posts) p
ASOF LEFT JOIN (SELECT tick_id, price_usd, last_updated, max_supply // 1000 AS user_id FROM ticks) t
  ON p.user_id = t.user_id AND p.created_utc >= t.last_updated""",
    "posts_trailing_5m": f"""WITH {TICKS_SQL},
{POSTS_SQL},
both_kinds AS (
  SELECT tick_id, symbol, last_updated, NULL AS post_id FROM ticks
  UNION ALL SELECT NULL, NULL, created_utc, post_id FROM posts),
counted AS (
  SELECT *, count(post_id) OVER (ORDER BY last_updated RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)
           AS posts_last_5_minutes
  FROM both_kinds)
SELECT tick_id, symbol, last_updated, posts_last_5_minutes FROM counted WHERE tick_id IS NOT NULL""",
    "scores_trailing_week_by_user": f"""WITH {TICKS_SQL},
{POSTS_SQL},
both_kinds AS (
  SELECT tick_id, max_supply // 1000 AS user_id, last_updated, NULL AS post_id, NULL AS score FROM ticks
  UNION ALL SELECT NULL, CAST(view_count AS BIGINT), created_utc, post_id, score FROM posts),
counted AS (
  SELECT *, count(post_id) OVER w AS posts_last_week, CAST(sum(score) OVER w AS BIGINT) AS score_last_week
  FROM both_kinds
  WINDOW w AS (PARTITION BY user_id ORDER BY last_updated RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW))
SELECT tick_id, user_id, last_updated, posts_last_week, score_last_week FROM counted WHERE tick_id IS NOT NULL""",
    "daily_ohlc": f"""WITH {TICKS_SQL}
SELECT *, round((close_price - open_price) / nullif(open_price, 0) * 100 + 1e-10, 6) AS change_from_kafka
FROM (SELECT symbol, CAST(last_updated AS DATE) AS day, arg_min(price_usd, last_updated) AS open_price,
             arg_max(price_usd, last_updated) AS close_price, max(price_usd) AS max_price,
             min(price_usd) AS min_price
      FROM ticks GROUP BY ALL)""",
    "sentiment_weighted": f"""WITH {SPEED_INPUT_SQL}
SELECT symbol, CAST(timestamp AS DATE) AS day, CAST(sum(posts_last_5_minutes) AS BIGINT) AS posts_last_day,
       round(sum(avg_sentiment_bullish * posts_last_5_minutes) / nullif(sum(posts_last_5_minutes), 0) + 1e-10, 6)
         AS weighted_sentiment_bullish,
       round(sum(avg_sentiment_bearish * posts_last_5_minutes) / nullif(sum(posts_last_5_minutes), 0) + 1e-10, 6)
         AS weighted_sentiment_bearish,
       round(sum(avg_sentiment_neutral * posts_last_5_minutes) / nullif(sum(posts_last_5_minutes), 0) + 1e-10, 6)
         AS weighted_sentiment_neutral
FROM speed GROUP BY ALL""",
    "batch_rows": f"WITH {SPEED_INPUT_SQL},\n{DAILY_SQL}\n{daily_sql_view('timestamp')}",
    "batch_row_as_of": f"""WITH {SPEED_INPUT_SQL.replace('speed AS (', 'all_speed AS (')},
speed AS (SELECT * FROM all_speed
          WHERE timestamp >= CAST(date_trunc('day', {AS_OF_SQL}) AS TIMESTAMP) - INTERVAL 4 DAYS
            AND timestamp < {AS_OF_SQL}),
{DAILY_SQL}
{daily_sql_view(AS_OF_SQL)} WHERE day = CAST({AS_OF_SQL} AS DATE)""",
    "last5_closes": f"""WITH {CLOSES_SQL}
SELECT symbol, day, CAST(len(c) AS INTEGER) AS n_closes, c[1] AS close_1, c[2] AS close_2, c[3] AS close_3,
       c[4] AS close_4, c[5] AS close_5
FROM closes""",
    "minmax_scale": f"""WITH {CLOSES_SQL},
ranged AS (SELECT *, list_min(c) AS lo, list_max(c) AS hi FROM closes WHERE len(c) = 5),
spans AS (SELECT *, CASE WHEN hi > lo THEN hi - lo ELSE 1 END AS span FROM ranged)
SELECT symbol, day, round((c[1] - lo) / span + 1e-10, 6) AS scaled_1, round((c[2] - lo) / span + 1e-10, 6) AS scaled_2,
       round((c[3] - lo) / span + 1e-10, 6) AS scaled_3, round((c[4] - lo) / span + 1e-10, 6) AS scaled_4,
       round((c[5] - lo) / span + 1e-10, 6) AS scaled_5, round(c[5] + 1e-10, 6) AS restored_5
FROM spans""",
    "forecast_model": f"""WITH {CLOSES_SQL}
SELECT symbol, day, round(CASE WHEN len(c) < 5 THEN 0 ELSE list_avg(c) END + 1e-10, 6) AS predicted_price
FROM closes""",
    "forecast_trend": f"""WITH {CLOSES_SQL}
SELECT symbol, day, round(CASE WHEN len(c) < 5 THEN 0
         ELSE list_avg(c) + 3 * (-2 * c[1] - c[2] + c[4] + 2 * c[5]) / 10 END + 1e-10, 6) AS predicted_price
FROM closes""",
}
