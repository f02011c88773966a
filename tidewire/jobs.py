"""The jobs: the streaming speed layer, the daily batch, and upkeep of the tables.

``spark-submit run_job.py speed --folder F --format kafka --option kafka.bootstrap.servers=H:P``
``spark-submit run_job.py daily --folder F [--as-of "2024-01-15 23:59:00"]``
``spark-submit run_job.py upkeep --folder F [--as-of "2024-01-15 23:59:00"]``
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidewire.functions.forecast import TIME_STEP, Forecaster
from tidewire.functions.sentiment import Scorer
from tidewire.operators.posts import drop_repeats
from tidewire.plans.daily import daily_rows
from tidewire.plans.speed import scored_posts, speed_rows as batch_speed_rows
from tidewire.schemas import BATCH_COLUMNS, POST_TOPIC, SPEED_COLUMNS, TICK_TOPIC, struct, table_schemas
from tidewire.session import build_session, stream_session
from tidewire.sources.tables import read_topic_table
from tidewire.sources.topics import read_topics_stream
from tidewire.streaming import ingest, run, serving, speed

TOPICS = [TICK_TOPIC, POST_TOPIC]
# Columns that speed rows and the natural keys are made from.
SPEED_INPUT = {
    TICK_TOPIC: ["symbol", "last_updated", "price_usd"],
    POST_TOPIC: ["created_utc", "subreddit", "title", "selftext", "url"],
}
# State partitions of a job's streams; a checkpoint keeps the number it was started with.
STATE_PARTITIONS = 200


def speed_writers(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    folder: str,
    scorer: Scorer | None = None,
    spread: int | None = ingest.SPREAD,
) -> dict[str, DataStreamWriter]:
    """Two raw tables and the speed log, each with its own checkpoint.

    ``feeds`` has the messages of each topic. A raw table subscribes to its topic
    alone, and the speed query parses each topic once.
    """
    writers = ingest.raw_writers(feeds, folder)
    ticks, posts = (ingest.typed_rows(feeds[topic], topic, SPEED_INPUT[topic]) for topic in TOPICS)
    ticks = ingest.without_repeats(ticks, TICK_TOPIC, spread=spread)
    scored = ingest.without_repeats(posts, POST_TOPIC, spread=spread, make=lambda few: scored_posts(few, scorer))
    windows = speed.speed_windows(ticks, scored, watermark=None)
    checkpoint = f"{folder}/checkpoint/speed"
    write = serving.log_writer(f"{folder}/speed_log", "window_start", serving.run_number(spark, checkpoint))
    writers[checkpoint] = run.each_batch(windows, "update", write)
    return writers


def run_speed(
    spark: SparkSession,
    folder: str,
    fmt: str = "kafka",
    available_now: bool = False,
    scorer: Scorer | None = None,
    spread: int | None = ingest.SPREAD,
    state_partitions: int = STATE_PARTITIONS,
    **options: str,
) -> None:
    session = stream_session(spark, state_partitions)
    feeds = {topic: read_topics_stream(session, [topic], fmt, **options) for topic in TOPICS}
    writers = speed_writers(spark, feeds, folder, scorer, spread)
    if available_now:
        run.drain_all(writers)
        return
    for checkpoint, writer in writers.items():
        run.start(writer, checkpoint)
    session.streams.awaitAnyTermination()


def speed_rows_to(
    spark: SparkSession, folder: str, as_of: dt.datetime, days_back: int, scorer: Scorer | None = None
) -> DataFrame:
    """Speed rows of the days up to ``as_of``.

    Days that are over come from the raw tables, which have the rows that were too late
    for the stream; the open day comes from the speed log.
    """
    today = as_of.date()
    over = F.col("event_day").between(F.lit(today - dt.timedelta(days=days_back)), F.lit(today - dt.timedelta(days=1)))
    ticks, posts = (newest_copies(read_topic_table(spark, f"{folder}/{topic}", topic).filter(over)) for topic in TOPICS)
    past = batch_speed_rows(ticks, posts, scorer)
    live = speed.speed_view(spark, f"{folder}/speed_log", F.col("event_day") == F.lit(today))
    return past.unionByName(live).filter(F.col("timestamp") < F.lit(as_of))


def newest_copies(rows: DataFrame) -> DataFrame:
    """One copy of each row of a raw table: the newest by its file's time, then by a hash of its values.

    So two ticks of an asset and instant with different prices give the same row in every run.
    """
    names = rows.columns
    arrived = rows.select("*", F.col("_metadata.file_modification_time").alias("_arrived"))
    return drop_repeats(arrived, F.col("_arrived"), [F.xxhash64(*names)]).select(*names)


def run_daily(
    spark: SparkSession,
    folder: str,
    as_of: dt.datetime,
    forecaster: Forecaster | None = None,
    scorer: Scorer | None = None,
    late_days: int = 1,
) -> DataFrame:
    """Store speed and daily rows of the day of ``as_of`` and of the ``late_days`` before.

    The daily row of a day that is over is stamped with its last second, that of the
    open day with ``as_of``. A later run replaces the days that it computes, with what
    has come in late by then.

    Speed rows are computed once and written; daily rows are made from what was written.
    Both are staged under the run's number and published together.
    """
    first = as_of.date() - dt.timedelta(days=late_days)
    number = serving.new_run(spark)

    def stage(rows: DataFrame, table: str, shape: dict[str, str]) -> None:
        columns = [F.col(f.name).cast(f.dataType) for f in struct({"symbol": "string", **shape}).fields]
        serving.stage_days(rows.select(*columns), f"{folder}/{table}", "timestamp", number)

    # With the days before that the forecasts need; those are not published.
    stage(speed_rows_to(spark, folder, as_of, late_days + TIME_STEP - 1, scorer), "speed_layer", SPEED_COLUMNS)
    staged = T.StructType([*table_schemas()["speed_layer"].fields]).add("run_id", "long")
    rows = spark.read.schema(staged).parquet(f"{folder}/speed_layer").filter(F.col("run_id") == number)
    days = daily_rows(rows, forecaster).filter(F.col("day") >= F.lit(first))
    end = F.timestamp_seconds(F.unix_seconds((F.date_add("day", 1)).cast("timestamp")) - 1)
    days = days.withColumn("timestamp", F.when(F.col("day") == F.lit(as_of.date()), F.lit(as_of)).otherwise(end))
    stage(days, "batch_layer", BATCH_COLUMNS)
    serving.publish(spark, folder, number, serving.staged_days(spark, f"{folder}/batch_layer", number))
    return stored_days(spark, folder, "batch_layer")


def stored_days(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The published rows of ``speed_layer`` or ``batch_layer``."""
    return serving.published(spark, folder, table, table_schemas()[table])


def run_upkeep(spark: SparkSession, folder: str, as_of: dt.datetime, days_back: int = 2) -> None:
    """Rewrite the days before ``as_of`` of raw tables and speed log into few files."""
    last = as_of.date() - dt.timedelta(days=1)
    first = as_of.date() - dt.timedelta(days=days_back)
    for topic in TOPICS:
        serving.close_raw_days(spark, f"{folder}/{topic}", topic, first, last)
    over = F.col("event_day").between(F.lit(first), F.lit(last))
    serving.rewrite_days(spark, f"{folder}/speed_log", speed.WINDOW_SCHEMA, speed.WINDOW_KEY, over)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=["speed", "daily", "upkeep"])
    parser.add_argument("--folder", required=True, help="root of tables, logs and checkpoints")
    parser.add_argument("--format", default="kafka")
    parser.add_argument("--option", action="append", default=[], help="source option key=value")
    parser.add_argument("--available-now", action="store_true", help="work off what is there, then stop")
    parser.add_argument("--spread", type=int, default=ingest.SPREAD, help="parts in which repeats are dropped first")
    parser.add_argument("--state-partitions", type=int, default=STATE_PARTITIONS)
    parser.add_argument("--late-days", type=int, default=1, help="days before that the daily job computes again")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat)
    args = parser.parse_args(argv)
    spark = build_session(f"tidewire-{args.job}")
    if args.job == "speed":
        options = dict(option.split("=", 1) for option in args.option)
        run_speed(
            spark, args.folder, args.format, args.available_now,
            spread=args.spread or None, state_partitions=args.state_partitions, **options,
        )
        return
    as_of = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if args.job == "daily":
        run_daily(spark, args.folder, as_of, late_days=args.late_days)
    else:
        run_upkeep(spark, args.folder, as_of)
