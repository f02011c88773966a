"""Message topics as streams or tables, and back.

The connector is a parameter. ``kafka`` needs its connector on the cluster; any
file format works with ``path`` and the columns ``topic`` and ``value``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.schemas import MESSAGE_SCHEMA


def _topic_options(topics: list[str], fmt: str, options: dict[str, str]) -> dict[str, str]:
    if fmt != "kafka":
        return options
    return {"subscribe": ",".join(topics), "startingOffsets": "earliest", **options}


def read_topics_stream(
    spark: SparkSession, topics: list[str], fmt: str = "kafka", **options: str
) -> DataFrame:
    """Unbounded table over the topics, from the earliest offset, tolerant of lost offsets."""
    reader = spark.readStream.format(fmt).options(**_topic_options(topics, fmt, options))
    if fmt == "kafka":
        return reader.option("failOnDataLoss", "false").load().select("topic", "value")
    return reader.schema(MESSAGE_SCHEMA).load().filter(F.col("topic").isin(topics))


def read_topics(
    spark: SparkSession, topics: list[str], fmt: str = "kafka", **options: str
) -> DataFrame:
    """The same topics as a bounded table (replay)."""
    reader = spark.read.format(fmt).options(**_topic_options(topics, fmt, options))
    if fmt == "kafka":
        return reader.load().select("topic", "value")
    return reader.schema(MESSAGE_SCHEMA).load().filter(F.col("topic").isin(topics))


def write_topic(
    messages: DataFrame, fmt: str = "kafka", mode: str = "append", parts: Sequence[str] = (), **options: str
) -> None:
    """Publish ``topic`` and ``value`` rows; as files, each topic in a folder of its own.

    Files go below folders of the columns ``parts``, each of which is a feed by itself.
    """
    if fmt == "kafka":
        messages.select("topic", "value").write.format(fmt).mode(mode).options(**options).save()
        return
    rows = messages.select(*parts, "topic", "value")
    rows.write.format(fmt).mode(mode).options(**options).partitionBy(*parts, "topic").save()
