"""Speed layer as a batch plan: one row per asset and five-minute window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.scalars import pct_change, post_text, window_start
from tidewire.functions.sentiment import (
    LABELS,
    NO_POSTS_SCORE,
    Scorer,
    lexicon_scorer,
    mean_scores,
)
from tidewire.operators.ordered import SECOND, lag_by

WINDOW_MINUTES = 5


def newest(value: str, at: str) -> Column:
    """The value at the latest time that has one; a price that can't be read is no price."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at)))


def oldest(value: str, at: str) -> Column:
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(at)))


def scored_posts(posts: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Posts with a struct of three scores over title and body."""
    scorer = scorer or lexicon_scorer()
    return posts.withColumn("sentiment", scorer(post_text(F.col("title"), F.col("selftext"))))


def latest_ticks(ticks: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Newest tick per asset and window."""
    return ticks.groupBy("symbol", window_start(F.col("last_updated"), minutes).alias("window_start")).agg(
        F.max("last_updated").alias("timestamp"),
        newest("price_usd", "last_updated").alias("bitcoin_price"),
    )


def post_windows(scored: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Number of posts and mean scores per window."""
    return scored.groupBy(window_start(F.col("created_utc"), minutes).alias("window_start")).agg(
        F.count("*").alias("posts_last_5_minutes"), *mean_scores(F.col("sentiment"))
    )


def join_posts(tick_windows: DataFrame, windows: DataFrame) -> DataFrame:
    """Tick windows with their posts.

    Both sides are already one row per window (and asset), so no pair of single
    rows is ever built.
    """
    return with_defaults(tick_windows.join(windows, "window_start", "left"))


def with_defaults(rows: DataFrame) -> DataFrame:
    """0 posts and score 0.5 where a window has none."""
    return rows.select(
        "symbol",
        "window_start",
        "timestamp",
        "bitcoin_price",
        F.coalesce("posts_last_5_minutes", F.lit(0)).cast("int").alias("posts_last_5_minutes"),
        *[
            F.coalesce(f"avg_sentiment_{label}", F.lit(NO_POSTS_SCORE)).alias(f"avg_sentiment_{label}")
            for label in LABELS
        ],
    )


def with_change(rows: DataFrame) -> DataFrame:
    """Percent change against the price of the speed row before; 0 for the first.

    Rows without a readable price are passed over. An asset has at most 288 speed rows
    per day, whatever the tick rate.
    """
    before = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last("bitcoin_price", ignorenulls=True).over(before)
    return rows.withColumn("change_from_kafka", pct_change(F.col("bitcoin_price"), previous, 0.0))


def speed_rows(ticks: DataFrame, posts: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    return with_change(join_posts(latest_ticks(ticks), post_windows(scored_posts(posts, scorer))))


def latest_speed_row(ticks: DataFrame, posts: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """The newest speed row. Only the posts of its window are scored."""
    row = with_change(latest_ticks(ticks)).orderBy(F.col("timestamp").desc(), "symbol").limit(1)
    of_window = posts.withColumn("window_start", window_start(F.col("created_utc"), WINDOW_MINUTES))
    # One row, whatever the input.
    wanted = of_window.join(F.broadcast(row.select("window_start")), "window_start", "left_semi")
    joined = join_posts(row, post_windows(scored_posts(wanted.drop("window_start"), scorer)))
    return joined.join(F.broadcast(row.select("symbol", "change_from_kafka")), "symbol")


def draft_rows(ticks: DataFrame, posts: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Ticks joined to the posts of their window, by tick time: mean price, post count, change.

    A join row by row would build every tick-post pair of a window. The mean over
    those pairs is the mean over the ticks, and their number is ticks times
    posts, so both sides are reduced before they meet.
    """
    by_time = ticks.groupBy("last_updated").agg(
        F.avg("price_usd").alias("bitcoin_price"), F.count("*").alias("_ticks")
    )
    windows = posts.groupBy(window_start(F.col("created_utc"), minutes).alias("window_start")).agg(
        F.count("title").alias("_posts")
    )
    joined = (
        by_time.withColumn("window_start", window_start(F.col("last_updated"), minutes))
        .join(windows, "window_start", "inner")
        .select(
            "last_updated",
            "bitcoin_price",
            (F.col("_ticks") * F.col("_posts")).alias("number_of_posts"),
        )
    )
    lagged = lag_by(joined, [], "last_updated", {"bitcoin_price": "_previous_price"})
    return lagged.withColumn(
        "change_percent", pct_change(F.col("bitcoin_price"), F.col("_previous_price"))
    ).drop("_previous_price")


def price_changes(ticks: DataFrame, keys: list[str], span: int = SECOND) -> DataFrame:
    """Mean price per time and its percent change from the time before; NULL for the first."""
    by_time = ticks.groupBy(*keys, "last_updated").agg(F.avg("price_usd").alias("price_usd"))
    lagged = lag_by(by_time, keys, "last_updated", {"price_usd": "previous_price"}, span)
    return lagged.withColumn("change_percent", pct_change(F.col("price_usd"), F.col("previous_price")))
