"""Table scans and landed payloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.schemas import BAD, CORRUPT, GOOD, SUBMISSION_SCHEMA, raw_table_schema


def closed_path(path: str) -> str:
    """Where the rewritten days of a raw table are."""
    return f"{path}_days"


def read_topic_table(
    spark: SparkSession, path: str, topic: str, closed_before: dt.date | None = None
) -> DataFrame:
    """Typed rows of a raw table, with their event day.

    Days before ``closed_before`` come from their rewritten files.
    """
    stored = spark.read.schema(raw_table_schema(topic)).parquet(path)
    if closed_before is not None:
        days = spark.read.schema(raw_table_schema(topic)).parquet(closed_path(path))
        day = F.col("event_day")
        stored = stored.filter((day >= F.lit(closed_before)) | day.isNull()).unionByName(
            days.filter(day < F.lit(closed_before))
        )
    return stored.filter(F.col("status") == GOOD).drop("status", CORRUPT)


def read_quarantine(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Texts of the bad messages of a raw table."""
    stored = spark.read.schema(raw_table_schema(topic)).parquet(path)
    return stored.filter(F.col("status") == BAD).select(CORRUPT)


def read_table(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """A table of any connector, for example ``table`` and ``keyspace`` options of a store."""
    return spark.read.format(fmt).options(**options).load()


def read_listings(
    spark: SparkSession, path: str, streaming: bool = False, per_line: bool = False
) -> DataFrame:
    """Landed listing payloads as column ``value``: one JSON document per file, or per line."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").option("wholetext", str(not per_line).lower()).load(path)


def read_submissions(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Landed forum posts, one JSON object per line."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(SUBMISSION_SCHEMA).json(path)
