"""Raw layer on streams: topic messages to tables, repeats."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewire.operators import messages as M
from tidewire.schemas import RAW_PARTITIONS
from tidewire.streaming.run import append_to

WATERMARK = "10 minutes"
# Parts in which repeats are dropped first.
SPREAD = 8


def typed_rows(feed: DataFrame, topic: str, only: Sequence[str] | None = None) -> DataFrame:
    """Good messages of one topic as typed rows; of ``id`` and the columns ``only``, if given."""
    return M.conform(M.good(M.parse_or_flag(M.of_topic(feed, topic), topic, only=only)), topic, only=only)


def raw_writers(feeds: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, DataStreamWriter]:
    """One append stream for each topic off its own feed, keyed by checkpoint folder."""
    return {
        f"{folder}/checkpoint/{topic}": append_to(
            M.landed(M.of_topic(feed, topic), topic), f"{folder}/{topic}", fmt, RAW_PARTITIONS
        )
        for topic, feed in feeds.items()
    }


def without_repeats(
    rows: DataFrame,
    topic: str,
    watermark: str = WATERMARK,
    spread: int | None = SPREAD,
    make: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """First copy of each row; ids are forgotten once the watermark has passed them.

    Copies are many: every poll sends a post again while it is recent. They are dropped
    in ``spread`` parts by input partition first, so that at most as many copies of a
    row are left to meet in one task. That costs one more shuffle and state for each
    part; None leaves it out.

    ``make`` adds columns to a row, as scores of its text. With parts it gets the rows that
    the first shuffle leaves, at most ``spread`` copies of each, so that the second one
    carries the new columns and none that only they are made from.
    """
    make = make or (lambda once: once)
    timed = rows.withWatermark(M.event_time(topic), watermark)
    if spread:
        parted = timed.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(spread)))
        few = parted.dropDuplicatesWithinWatermark(["id", "_part"]).drop("_part")
        return make(few).dropDuplicatesWithinWatermark(["id"])
    return make(timed.dropDuplicatesWithinWatermark(["id"]))
