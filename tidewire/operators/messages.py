"""JSON messages of the two topics: decode, parse, quarantine, conform, encode, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.scalars import columns_of, content_id, event_day, timestamp_text
from tidewire.schemas import (
    BAD,
    CORRUPT,
    GOOD,
    POST_KEYS,
    POST_TOPIC,
    SELECTED_KEYS,
    TICK_KEYS,
    TICK_TOPIC,
    TOPIC_KEYS,
    raw_schema,
    topic_keys,
)

def decode(messages: DataFrame, *keep: str) -> DataFrame:
    """Message bytes to text."""
    return messages.select(*keep, F.col("value").cast("string").alias("value"))


def parse(messages: DataFrame, topic: str, *keep: str) -> DataFrame:
    """Text to the all-text columns of the topic. Without options Catalyst drops unused keys."""
    parsed = F.from_json("value", raw_schema(topic)).alias("data")
    return decode(messages, *keep).select(*keep, parsed).select(*keep, "data.*")


def parse_or_flag(
    messages: DataFrame, topic: str, *keep: str, only: Sequence[str] | None = None
) -> DataFrame:
    """Like ``parse`` with the text of a bad message in ``_corrupt_record``.

    NULL messages carry nothing to parse or to quarantine and are left out. Catalyst keeps
    unused keys here, so a caller names the typed columns that it needs in ``only``. All
    keys are text, so the others are read past and the same messages are bad.
    """
    keys = [field for field in raw_schema(topic).fields if _wanted(topic, field.name, only)]
    schema = T.StructType([*keys, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("data")
    decoded = decode(messages, *keep).filter(F.col("value").isNotNull())
    return decoded.select(*keep, parsed).select(*keep, "data.*")


def good(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(flagged: DataFrame, *keep: str) -> DataFrame:
    return flagged.filter(F.col(CORRUPT).isNotNull()).select(*keep, CORRUPT)


def select_fields(parsed: DataFrame, topic: str) -> DataFrame:
    topic_keys(topic)
    return parsed.select(*columns_of(SELECTED_KEYS[topic]))


def conform(parsed: DataFrame, topic: str, *keep: str, only: Sequence[str] | None = None) -> DataFrame:
    """All-text columns to the typed table row; a value that does not fit becomes NULL.

    ``only`` names the columns to make, those of the natural key among them.
    """
    columns = {
        column: _conformed(key, kind).alias(column)
        for key, (column, kind) in topic_keys(topic).items()
        if column and _wanted(topic, key, only)
    }
    typed = parsed.select(*keep, *columns.values())
    names = list(columns)
    return typed.select(*keep, natural_id(topic).alias("id"), *names)


def _wanted(topic: str, key: str, only: Sequence[str] | None) -> bool:
    return only is None or topic_keys(topic)[key][0] in only


def event_time(topic: str) -> str:
    topic_keys(topic)
    return "last_updated" if topic == TICK_TOPIC else "created_utc"


def landed(messages: DataFrame, topic: str) -> DataFrame:
    """Rows of a raw table: typed rows and, apart from them, the text of bad messages.

    Both come from one parse and go to one sink.
    """
    typed = conform(parse_or_flag(messages, topic), topic, CORRUPT)
    is_bad = F.col(CORRUPT).isNotNull()
    return typed.withColumns(
        {
            "id": F.when(~is_bad, F.col("id")),
            "status": F.when(is_bad, F.lit(BAD)).otherwise(F.lit(GOOD)),
            "event_day": event_day(F.col(event_time(topic))),
        }
    )


def _conformed(key: str, kind: str) -> Column:
    text = F.col(f"`{key}`")
    if key == "created":
        return F.timestamp_seconds(text.try_cast("double"))
    return text if kind == "string" else text.try_cast(kind)


def natural_id(topic: str) -> Column:
    """Content hash of the natural key, the same on every replay and for every copy."""
    keys = {
        TICK_TOPIC: ["symbol", "last_updated"],
        POST_TOPIC: ["subreddit", "created_utc", "title", "url"],
    }
    topic_keys(topic)
    return content_id(*[F.col(key) for key in keys[topic]])


def tick_message(row: DataFrame, *keep: str) -> DataFrame:
    """Typed ticks to messages of the tick topic."""
    iso = F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return _message(row, TICK_TOPIC, TICK_KEYS, {"last_updated": iso}, keep)


def post_message(row: DataFrame, *keep: str) -> DataFrame:
    """Typed posts to messages of the post topic; ``created`` stays in epoch seconds."""
    special = {
        "created_utc": timestamp_text(F.col("created_utc")),
        "created": F.unix_seconds("created").cast("double"),
        "_comments_by_id": F.lit("{}"),
    }
    return _message(row, POST_TOPIC, POST_KEYS, special, keep)


def _message(
    row: DataFrame, topic: str, keys: dict, special: dict[str, Column], keep: tuple[str, ...]
) -> DataFrame:
    fields = [
        special.get(key, F.col(column) if column else None).alias(key)
        for key, (column, _) in keys.items()
    ]
    value = F.to_json(F.struct(*fields)).cast("binary")
    return row.select(*keep, F.lit(topic).alias("topic"), value.alias("value"))


def union_topics(*messages: DataFrame) -> DataFrame:
    """Messages of several topics as one frame, told apart by ``topic``."""
    merged, *rest = messages
    for other in rest:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def of_topic(messages: DataFrame, topic: str) -> DataFrame:
    topic_keys(topic)
    return messages.filter(F.col("topic") == topic)


def unsupported(messages: DataFrame) -> DataFrame:
    """Messages of no known topic, kept apart instead of failing the job."""
    known = F.col("topic").isin(list(TOPIC_KEYS))
    return messages.filter(~F.coalesce(known, F.lit(False)))


def route(topic: Column) -> Column:
    """Table a message goes to."""
    return F.when(topic.isin(list(TOPIC_KEYS)), topic).otherwise(F.lit("unsupported"))
