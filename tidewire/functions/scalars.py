"""Column expressions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.schemas import TIMESTAMP_TEXT


def post_text(title: Column, selftext: Column) -> Column:
    """Title and body; the title alone when there is no body. An empty body still counts."""
    return F.when(selftext.isNull(), title).otherwise(F.concat(title, F.lit(" : "), selftext))


def pct_change(current: Column, previous: Column, default: float | None = None) -> Column:
    """Percent change; ``default`` (or NULL) without a usable predecessor."""
    change = F.try_divide(current - previous, previous) * 100
    return change if default is None else F.coalesce(change, F.lit(float(default)))


def content_id(*columns: Column) -> Column:
    """Repeatable row id over a natural key.

    Each part carries its length, so neither a separator inside a value nor a
    NULL beside a blank can make two keys look alike.
    """
    parts = [
        F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in (column.cast("string") for column in columns)
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def start_of_day(at: Column) -> Column:
    return F.date_trunc("day", at)


def days_before(at: Column, days: int) -> Column:
    """Start of the day ``days`` days before ``at``."""
    return start_of_day(at) - F.make_dt_interval(days=F.lit(days))


def event_day(at: Column) -> Column:
    return at.cast("date")


def window_start(at: Column, minutes: int = 5) -> Column:
    return F.window(at, f"{minutes} minutes")["start"]


def epoch_to_utc(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def utc_to_epoch(at: Column) -> Column:
    return F.unix_seconds(at)


def timestamp_text(at: Column) -> Column:
    return F.date_format(at, TIMESTAMP_TEXT)


def minmax_scale(values: Column) -> Column:
    """Scale an array to [0, 1] over its own range; a constant array becomes zeros."""
    low, high = F.array_min(values), F.array_max(values)
    span = F.when(high > low, high - low).otherwise(F.lit(1.0))
    return F.transform(values, lambda x: (x - low) / span)


def minmax_restore(scaled: Column, values: Column) -> Column:
    """Bring one scaled number back to the range of ``values``."""
    low, high = F.array_min(values), F.array_max(values)
    span = F.when(high > low, high - low).otherwise(F.lit(1.0))
    return scaled * span + low


def cosine(left: Column, right: Column) -> Column:
    dot = _dot(left, right)
    norm = F.sqrt(_dot(left, left)) * F.sqrt(_dot(right, right))
    return F.try_divide(dot, norm)


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def columns_of(names: Sequence[str]) -> list[Column]:
    """Columns by exact name, also with blanks and brackets in it."""
    return [F.col(f"`{name}`") for name in names]
