"""Serving tables: an append-only log, a view with the latest row per key, tables by day.

A batch writes only below its own ``run_id`` and ``batch_id``. Running it again after
a failure replaces those files and changes nothing in the view. Batches count from 0
again under a new checkpoint; the run number, which grows with each checkpoint, is
compared first. Days that are over are rewritten beside the log as one batch each, and
the view reads both, so that the many small files of such days may expire at any time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.scalars import event_day
from tidewire.operators.topn import top_n
from tidewire.schemas import PUBLISHED, PUBLISHED_SCHEMA, RAW_PARTITIONS, raw_table_schema
from tidewire.sources.tables import closed_path

# Top folders of a serving table: batches as they came, and days that are over.
LOG, DAYS = "log", "days"
FOLDERS = ("part", "event_day", "run_id", "batch_id")
# Files that a batch writes for a day, at most.
FILES = 4


def append_batch(
    rows: DataFrame, batch_id: int, path: str, at: str, run: int = 0, files: int = FILES
) -> None:
    """Write one batch of serving rows; the same batch again replaces itself.

    A day's rows go to ``files`` tasks by a hash of the row: few files for each batch,
    and no task with all rows of a day. (Streams run without AQE, which the
    ``rebalance`` hint would need.)
    """
    stamps = {
        "event_day": event_day(F.col(at)),
        "run_id": F.lit(run).cast("bigint"),
        "batch_id": F.lit(batch_id).cast("bigint"),
    }
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(files)).alias("_share")
    dealt = rows.withColumns(stamps).select("*", share).repartition("event_day", "_share")
    _write(dealt.drop("_share"), path, LOG)


def _write(stamped: DataFrame, path: str, part: str) -> None:
    """Replaces only the folders that get rows."""
    (
        stamped.withColumn("part", F.lit(part))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FOLDERS)
        .parquet(path)
    )


def log_writer(path: str, at: str, run: int = 0, files: int = FILES) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch_id: append_batch(rows, batch_id, path, at, run, files)


def run_number(spark: SparkSession, checkpoint: str) -> int:
    """The run number of a checkpoint: the time of its first start, which is kept in it."""
    kept = f"{checkpoint}/run_number"
    try:
        return spark.read.schema("run bigint").parquet(kept).first()["run"]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.sql("SELECT unix_micros(now()) AS run").coalesce(1).write.parquet(kept)
    return run_number(spark, checkpoint)


def replace_days(rows: DataFrame, path: str, at: str, files: int = FILES) -> None:
    """Write rows into a table by ``event_day``; days that get rows are replaced whole."""
    _write_days(rows, path, at, ["event_day"], files)


def stage_days(rows: DataFrame, path: str, at: str, run: int, files: int = FILES) -> None:
    """Write rows below their day and the run's own folder, where no reader looks before ``publish``."""
    _write_days(rows.withColumn("run_id", F.lit(run).cast("bigint")), path, at, ["event_day", "run_id"], files)


def _write_days(rows: DataFrame, path: str, at: str, folders: list[str], files: int) -> None:
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(files)).alias("_share")
    dealt = rows.withColumn("event_day", event_day(F.col(at))).select("*", share)
    (
        dealt.repartition("event_day", "_share")
        .drop("_share")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def new_run(spark: SparkSession) -> int:
    """A number greater than those of earlier runs."""
    return spark.sql("SELECT unix_micros(now()) AS run").first()["run"]


def staged_days(spark: SparkSession, path: str, run: int) -> list[dt.date]:
    """The days that a run has staged rows of: as many as it computes."""
    stamps = spark.read.schema("event_day date, run_id bigint").parquet(path)
    found = stamps.filter(F.col("run_id") == run).select("event_day").distinct().collect()
    return sorted(row["event_day"] for row in found)


def publish(spark: SparkSession, folder: str, run: int, days: Sequence[dt.date]) -> None:
    """Make the run's rows of these days those of every table in ``folder``, in one commit.

    One file lists the days, so readers see all of them or none, and a run that failed
    before leaves all tables as they were.
    """
    rows = spark.createDataFrame([(day, run) for day in days], PUBLISHED_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{folder}/{PUBLISHED}")


def published(spark: SparkSession, folder: str, table: str, schema: T.StructType) -> DataFrame:
    """A table's rows of the newest published run of each day. ``schema`` ends with ``event_day``."""
    full = T.StructType([*schema.fields]).add("run_id", "long")
    newest = spark.read.schema(PUBLISHED_SCHEMA).parquet(f"{folder}/{PUBLISHED}")
    newest = newest.groupBy("event_day").agg(F.max("run_id").alias("run_id"))
    stored = spark.read.schema(full).parquet(f"{folder}/{table}")
    return stored.join(newest, ["event_day", "run_id"]).select(*schema.fieldNames())


def latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    days: Column | None = None,
) -> DataFrame:
    """Latest row per key. ``days`` is a condition on ``event_day`` and prunes folders.

    A key must always fall on the same day, as a window start does.
    """
    return _newest(_read(spark, path, schema, days), keys).select(*schema.fieldNames())


def _read(spark: SparkSession, path: str, schema: T.StructType, days: Column | None) -> DataFrame:
    """Every stored row with its ``FOLDERS`` columns."""
    # A copy of the field list: adding to a StructType extends the list it was given.
    full = T.StructType([*schema.fields]).add("part", "string")
    full = full.add("event_day", "date").add("run_id", "long").add("batch_id", "long")
    stored = spark.read.schema(full).parquet(path)
    return stored if days is None else stored.filter(days)


def _newest(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    return top_n(stored, keys, [F.col("run_id").desc(), F.col("batch_id").desc()], 1)


def rewrite_days(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], days: Column
) -> None:
    """Rewrite the given days as one batch each, those with anything new.

    The batch takes the number of the last batch seen for the day: rows that
    come in later have a higher one and still win. No folder that is being read
    is written.
    """
    stored = _read(spark, path, schema, days)
    batch = F.struct("run_id", "batch_id")
    last = {part: F.max(F.when(F.col("part") == part, batch)) for part in (LOG, DAYS)}
    news = stored.groupBy("event_day").agg(last[LOG].alias("_log"), last[DAYS].alias("_days"))
    news = news.filter(F.col("_days").isNull() | (F.col("_log") > F.col("_days")))
    rows = _newest(stored, keys).select(*schema.fieldNames(), "event_day")
    rows = rows.join(news.select("event_day", "_log.*"), "event_day")
    _write(rows.hint("rebalance", "event_day"), path, DAYS)


def close_raw_days(spark: SparkSession, path: str, topic: str, first: dt.date, last: dt.date) -> None:
    """Rewrite days of a raw table that are over into few files, in the table's ``_days`` folder.

    Running it again replaces the days, with what has come in late. Readers that name
    a day before which the table is closed take those days from there.
    """
    stored = spark.read.schema(raw_table_schema(topic)).parquet(path)
    over = stored.filter(F.col("event_day").between(F.lit(first), F.lit(last)))
    (
        over.hint("rebalance", *RAW_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*RAW_PARTITIONS)
        .parquet(closed_path(path))
    )


def append_raw(landed: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Batch append to a raw table.

    ``rebalance`` lets AQE merge small days into one file and split large ones.
    """
    balanced = landed.hint("rebalance", *RAW_PARTITIONS)
    balanced.write.format(fmt).mode("append").partitionBy(*RAW_PARTITIONS).save(path)
