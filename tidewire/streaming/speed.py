"""Speed layer on streams: windowed rows, running means, change against the row before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions.sentiment import LABELS, mean_scores
from tidewire.plans.speed import WINDOW_MINUTES, newest, with_change, with_defaults
from tidewire.schemas import struct
from tidewire.streaming.ingest import WATERMARK
from tidewire.streaming.serving import latest

AVERAGES = [f"avg_sentiment_{label}" for label in LABELS]
WINDOW_KEY = ["kind", "symbol", "window_start"]
WINDOW_SCHEMA = struct(
    {
        "kind": "string",
        "symbol": "string",
        "window_start": "timestamp",
        "timestamp": "timestamp",
        "bitcoin_price": "double",
        "posts_last_5_minutes": "long",
        **{name: "double" for name in AVERAGES},
    }
)
PRICE_SCHEMA = struct(
    {
        "symbol": "string",
        "window_start": "timestamp",
        "timestamp": "timestamp",
        "bitcoin_price": "double",
    }
)


def speed_windows(
    ticks: DataFrame,
    scored: DataFrame,
    watermark: str | None = WATERMARK,
    minutes: int = WINDOW_MINUTES,
) -> DataFrame:
    """Ticks and posts in one windowed aggregate with one state store.

    Rows carry their kind instead of being joined: a tick row per asset and
    window, a post row per window. ``speed_view`` puts them together.
    ``watermark`` is None for inputs that have theirs, as after dropping repeats.
    """
    tick_part = ticks.select(
        F.lit("tick").alias("kind"), "symbol", F.col("last_updated").alias("at"), "price_usd"
    )
    post_part = scored.select(F.lit("post").alias("kind"), F.col("created_utc").alias("at"), "sentiment")
    both = tick_part.unionByName(post_part, allowMissingColumns=True)
    if watermark:
        both = both.withWatermark("at", watermark)
    windows = both.groupBy(F.window("at", f"{minutes} minutes"), "kind", "symbol").agg(
        F.max("at").alias("timestamp"),
        newest("price_usd", "at").alias("bitcoin_price"),
        F.count("*").alias("posts_last_5_minutes"),
        *mean_scores(F.col("sentiment")),
    )
    return windows.select("kind", "symbol", F.col("window.start").alias("window_start"), *WINDOW_SCHEMA.fieldNames()[3:])


def speed_view(spark: SparkSession, log: str, days: Column | None = None) -> DataFrame:
    """Speed rows read off the log of window rows, which is read and ranked once.

    Ticks take the posts of their window over a window's rows, one for each asset.
    With ``days``, a condition on ``event_day``, the first row of that range has
    no predecessor and its change is 0.
    """
    windows = latest(spark, log, WINDOW_SCHEMA, WINDOW_KEY, days)
    names = ["posts_last_5_minutes", *AVERAGES]
    is_post = F.col("kind") == "post"
    of_window = Window.partitionBy("window_start")
    posts = {name: F.max(F.when(is_post, F.col(name))).over(of_window) for name in names}
    return with_change(with_defaults(windows.withColumns(posts).filter(~is_post)))


def change_view(spark: SparkSession, log: str, days: Column | None = None) -> DataFrame:
    """Live change of each asset against its window before, open windows included."""
    ticks = latest(spark, log, PRICE_SCHEMA, ["symbol", "window_start"], days)
    return with_change(ticks)


def post_counts(
    posts: DataFrame, watermark: str = WATERMARK, minutes: int = WINDOW_MINUTES, slide: str | None = None
) -> DataFrame:
    """Posts per window, tumbling or sliding."""
    window = F.window("created_utc", f"{minutes} minutes", slide)
    counted = posts.withWatermark("created_utc", watermark).groupBy(window).agg(F.count("*").alias("posts"))
    return counted.select(F.col("window.start").alias("window_start"), "posts")


def running_means(scored: DataFrame) -> DataFrame:
    """Means over all posts so far; a running total, so without a watermark."""
    return scored.groupBy().agg(*mean_scores(F.col("sentiment")))


def price_windows(ticks: DataFrame, watermark: str = WATERMARK, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Newest readable price per asset and window. In update mode open windows appear at once."""
    windows = (
        ticks.withWatermark("last_updated", watermark)
        .groupBy(F.window("last_updated", f"{minutes} minutes"), "symbol")
        .agg(
            F.max("last_updated").alias("timestamp"),
            newest("price_usd", "last_updated").alias("bitcoin_price"),
        )
    )
    return windows.select("symbol", F.col("window.start").alias("window_start"), "timestamp", "bitcoin_price")
