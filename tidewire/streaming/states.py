"""Stored window states: batches add to them, daily rows and late rows follow from them.

``states`` has a folder for each day and batch with the partial states of that batch's
windows. A batch that runs again replaces its own folders, so every input row counts
once; a new run over the same input needs a folder of its own. Days with many batches are
compacted into one state for each window: the reader then leaves out the batches that a
compacted day holds already.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.forecast import Forecaster
from tidewire.functions.scalars import event_day
from tidewire.plans import daily, speed
from tidewire.plans.states import STATE_SCHEMA, merged, speed_of, window_states
from tidewire.schemas import struct
from tidewire.streaming import serving

DAY_SCHEMA = struct(
    {
        "symbol": "string",
        "day": "date",
        "timestamp": "timestamp",
        "open_price": "double",
        "close_price": "double",
        "posts_last_day": "long",
        "avg_sentiment_bullish": "double",
        "avg_sentiment_bearish": "double",
        "avg_sentiment_neutral": "double",
        "Max_Price": "double",
        "Min_Price": "double",
    }
)


def _batch() -> Column:
    return F.struct("run_id", "batch_id")


def stored_states(spark: SparkSession, path: str, days: Column | None = None) -> DataFrame:
    """Partial states of all batches, each row of the input counted once.

    ``days`` is a condition on ``event_day`` and prunes folders.
    """
    stored = serving._read(spark, path, STATE_SCHEMA, days)
    is_compact = F.col("part") == serving.DAYS
    closed = stored.filter(is_compact).groupBy("event_day").agg(F.max(_batch()).alias("_closed"))
    open_rows = F.col("_closed").isNull() | F.when(is_compact, _batch() == F.col("_closed")).otherwise(
        _batch() > F.col("_closed")
    )
    return stored.join(closed, "event_day", "left").filter(open_rows).select(*STATE_SCHEMA.fieldNames())


def compact(spark: SparkSession, path: str, days: Column) -> None:
    """Rewrite the given days as one state for each window, stamped with the last batch they hold."""
    stored = serving._read(spark, path, STATE_SCHEMA, days)
    last = {part: F.max(F.when(F.col("part") == part, _batch())) for part in (serving.LOG, serving.DAYS)}
    news = stored.groupBy("event_day").agg(last[serving.LOG].alias("_log"), last[serving.DAYS].alias("_days"))
    news = news.filter(F.col("_log").isNotNull() & (F.col("_days").isNull() | (F.col("_log") > F.col("_days"))))
    whole = merged(stored_states(spark, path, days)).withColumn("event_day", event_day(F.col("window_start")))
    rows = whole.join(news.select("event_day", "_log.*"), "event_day")
    serving._write(rows.hint("rebalance", "event_day"), path, serving.DAYS)


def add_batch(rows: DataFrame, batch_id: int, folder: str, run: int = 0) -> list[dt.date]:
    """Add a batch of ``timed_rows`` and compute the days anew that it has rows of.

    Only those days' states are read, never a raw row of an earlier batch. Returns the days.
    """
    spark = rows.sparkSession
    path = f"{folder}/states"
    serving.append_batch(window_states(rows), batch_id, path, "window_start", run)
    own = (F.col("run_id") == run) & (F.col("batch_id") == batch_id)
    # Folder names alone, and as many as a batch has days.
    found = serving._read(spark, path, STATE_SCHEMA, own).select("event_day").distinct().collect()
    days = sorted(row["event_day"] for row in found)
    if days:
        serving.replace_days(days_of(spark, path, days), f"{folder}/days", "timestamp")
    return days


def days_of(spark: SparkSession, path: str, days: Sequence[dt.date]) -> DataFrame:
    """Day rows, without the forecast, of the given days."""
    wanted = F.col("event_day").isin([F.lit(day) for day in days])
    rows = daily.day_rows(speed_of(merged(stored_states(spark, path, wanted))))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in DAY_SCHEMA.fields])


def batch_writer(folder: str, run: int = 0) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: daily rows that follow the stream."""

    def write(rows: DataFrame, batch_id: int) -> None:
        add_batch(rows, batch_id, folder, run)

    return write


def daily_view(spark: SparkSession, folder: str, forecaster: Forecaster | None = None) -> DataFrame:
    """All daily rows. Forecasts are made on reading, from the stored closes of five days:
    a change of one day reaches those of the next four without touching them."""
    stored = spark.read.schema(T.StructType([*DAY_SCHEMA.fields]).add("event_day", "date")).parquet(f"{folder}/days")
    return daily.with_forecast(stored.drop("event_day"), forecaster)


def late_writer(folder: str, delay_minutes: int, run: int = 0) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` over ``timed_rows``: rows behind the watermark become correction rows.

    The watermark of a batch is the newest time of the batches before it, less the delay,
    read off their states. So a batch that runs again after a failure is split as before.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        mark = watermark(rows.sparkSession, folder, batch_id, delay_minutes, run)
        late = F.lit(False) if mark is None else F.col("at") < F.lit(mark)
        serving.append_batch(window_states(rows, late), batch_id, f"{folder}/states", "window_start", run)

    return write


def watermark(spark: SparkSession, folder: str, batch_id: int, delay_minutes: int, run: int = 0) -> dt.datetime | None:
    """The newest time that batches of the run before ``batch_id`` have seen, less the delay."""
    if batch_id == 0:
        return None
    earlier = (F.col("run_id") == run) & (F.col("batch_id") < batch_id) & (F.col("part") == serving.LOG)
    seen = serving._read(spark, f"{folder}/states", STATE_SCHEMA, earlier)
    # The newest day follows from folder names; only its rows are read.
    day = seen.agg(F.max("event_day")).first()[0]
    newest = seen.filter(F.col("event_day") == F.lit(day)).agg(F.max("timestamp")).first()[0]
    return None if newest is None else newest - dt.timedelta(minutes=delay_minutes)


def corrections(spark: SparkSession, folder: str, days: Column | None = None) -> DataFrame:
    """The partial states of late rows."""
    return stored_states(spark, f"{folder}/states", days).filter("late")


def corrected_view(spark: SparkSession, folder: str, days: Column | None = None) -> DataFrame:
    """Speed rows with late rows counted, as a batch over all rows would give them."""
    return speed.with_change(speed_of(merged(stored_states(spark, f"{folder}/states", days))))
