"""Batch layer: one row per asset and day, from the speed rows, in one plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.forecast import TIME_STEP, Forecaster, trend_forecaster
from tidewire.functions.scalars import event_day, pct_change
from tidewire.functions.sentiment import LABELS
from tidewire.plans.speed import newest, oldest


def day_range(df: DataFrame, at: str, as_of: dt.datetime, days_back: int = 0) -> DataFrame:
    """Rows from the start of the day ``days_back`` days before ``as_of``, up to ``as_of``.

    The bounds are literals, so they reach the scan, and on a table partitioned
    by event day only the folders of those days are read.
    """
    start = dt.datetime.combine(as_of.date(), dt.time()) - dt.timedelta(days=days_back)
    if "event_day" in df.columns:
        df = df.filter(F.col("event_day").between(F.lit(start.date()), F.lit(as_of.date())))
    return df.filter((F.col(at) >= F.lit(start)) & (F.col(at) < F.lit(as_of)))


def daily_prices(df: DataFrame, at: str, price: str, keys: list[str]) -> DataFrame:
    """Open, close, high, low and change per key and day."""
    days = df.groupBy(*keys, event_day(F.col(at)).alias("day")).agg(
        oldest(price, at).alias("open_price"),
        newest(price, at).alias("close_price"),
        F.max(price).alias("max_price"),
        F.min(price).alias("min_price"),
    )
    return days.withColumn("change_from_kafka", pct_change(F.col("close_price"), F.col("open_price")))


def last_closes(days: DataFrame, keys: list[str], steps: int = TIME_STEP) -> DataFrame:
    """Closes of the last ``steps`` calendar days up to each day, oldest first.

    Days without a row or a readable price have no close, and a forecast takes all
    ``steps``. Ordered per key over one row per day: bounded by the calendar.
    """
    number = F.unix_date("day")
    window = Window.partitionBy(*keys).orderBy(number).rangeBetween(1 - steps, 0)
    return days.withColumn("last_closes", F.collect_list("close_price").over(window))


def day_rows(speed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key and day, without the forecast: one grouped aggregate over the speed rows."""
    keys = ["symbol"] if keys is None else keys
    return speed.groupBy(*keys, event_day(F.col("timestamp")).alias("day")).agg(
        F.max("timestamp").alias("timestamp"),
        oldest("bitcoin_price", "timestamp").alias("open_price"),
        newest("bitcoin_price", "timestamp").alias("close_price"),
        F.coalesce(F.sum(F.col("posts_last_5_minutes").cast("bigint")), F.lit(0)).alias("posts_last_day"),
        *[
            F.coalesce(F.avg(f"avg_sentiment_{label}"), F.lit(0.0)).alias(f"avg_sentiment_{label}")
            for label in LABELS
        ],
        F.coalesce(F.max("bitcoin_price"), F.lit(0.0)).alias("Max_Price"),
        F.coalesce(F.min("bitcoin_price"), F.lit(0.0)).alias("Min_Price"),
    )


def with_forecast(
    days: DataFrame, forecaster: Forecaster | None = None, keys: list[str] | None = None
) -> DataFrame:
    """The whole daily row from ``day_rows``: change, and the forecast from the last closes."""
    keys = ["symbol"] if keys is None else keys
    forecaster = forecaster or trend_forecaster()
    # Prices default in the output only: a close that is not there is no close of 0.
    return last_closes(days, keys).select(
        *keys,
        "day",
        "timestamp",
        F.coalesce("open_price", F.lit(0.0)).alias("open_price"),
        F.coalesce("close_price", F.lit(0.0)).alias("close_price"),
        "posts_last_day",
        pct_change(F.col("close_price"), F.col("open_price")).alias("change_from_kafka"),
        *[f"avg_sentiment_{label}" for label in LABELS],
        forecaster(F.col("last_closes")).alias("predicted_bitcoin_price"),
        "Max_Price",
        "Min_Price",
    )


def daily_rows(
    speed: DataFrame,
    forecaster: Forecaster | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """The whole daily row: one grouped aggregate over the speed rows, then the forecast."""
    return with_forecast(day_rows(speed, keys), forecaster, keys)


def daily_row_as_of(
    speed: DataFrame, as_of: dt.datetime, forecaster: Forecaster | None = None
) -> DataFrame:
    """What the daily job stores at ``as_of``: the row of that day, stamped with the run time.

    The four days before are read for the forecast.
    """
    recent = day_range(speed, "timestamp", as_of, days_back=TIME_STEP - 1)
    rows = daily_rows(recent, forecaster)
    return rows.filter(F.col("day") == F.lit(as_of.date())).withColumn("timestamp", F.lit(as_of))


def weighted_sentiment(speed: DataFrame, keys: list[str]) -> DataFrame:
    """Daily scores weighted by posts; NULL on a day without posts."""
    posts = F.col("posts_last_5_minutes")
    return speed.groupBy(*keys, event_day(F.col("timestamp")).alias("day")).agg(
        F.sum(posts.cast("bigint")).alias("posts_last_day"),
        *[
            F.try_divide(F.sum(F.col(f"avg_sentiment_{label}") * posts), F.sum(posts)).alias(
                f"weighted_sentiment_{label}"
            )
            for label in LABELS
        ],
    )
