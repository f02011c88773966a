"""Mergeable partial states of speed windows: sums, counts, the newest price with its time.

States of any split of the ticks and posts merge to those of the whole, so a batch is
reduced by itself and added to what is stored, whatever its rows' times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.scalars import window_start
from tidewire.functions.sentiment import LABELS
from tidewire.plans.speed import WINDOW_MINUTES, join_posts, newest
from tidewire.schemas import struct

KEY = ["kind", "symbol", "window_start"]
TICK, POST = "tick", "post"
SUMS = [f"sum_{label}" for label in LABELS]
COUNTS = ["n_rows", *[f"n_{label}" for label in LABELS]]
STATE_SCHEMA = struct(
    {
        "kind": "string",
        "symbol": "string",
        "window_start": "timestamp",
        "late": "boolean",
        "timestamp": "timestamp",
        "price_at": "timestamp",
        "bitcoin_price": "double",
        **{name: "long" for name in COUNTS},
        **{name: "double" for name in SUMS},
    }
)


def timed_rows(ticks: DataFrame, scored: DataFrame) -> DataFrame:
    """Ticks and scored posts as rows of one kind of table, with their time in ``at``."""
    tick = ticks.select(F.lit(TICK).alias("kind"), "symbol", F.col("last_updated").alias("at"), "price_usd")
    post = scored.select(F.lit(POST).alias("kind"), F.col("created_utc").alias("at"), "sentiment")
    return tick.unionByName(post, allowMissingColumns=True).filter(F.col("at").isNotNull())


def window_states(rows: DataFrame, late: Column | None = None, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """The partial state of every window that ``timed_rows`` fall in; posts have no symbol.

    Rows where ``late`` holds have states of their own: the corrections.
    """
    window = window_start(F.col("at"), minutes).alias("window_start")
    late = F.coalesce(F.lit(False) if late is None else late, F.lit(False)).alias("late")
    states = rows.groupBy("kind", "symbol", window, late).agg(
        F.max("at").alias("timestamp"),
        F.max(F.when(F.col("price_usd").isNotNull(), F.col("at"))).alias("price_at"),
        newest("price_usd", "at").alias("bitcoin_price"),
        F.count("*").alias("n_rows"),
        *[F.count(F.col("sentiment")[label]).alias(f"n_{label}") for label in LABELS],
        *[F.sum(F.col("sentiment")[label]).alias(f"sum_{label}") for label in LABELS],
    )
    return states.select(*STATE_SCHEMA.fieldNames())


def merged(states: DataFrame) -> DataFrame:
    """One state for each key, late rows included; it is marked late if all of them are."""
    whole = states.groupBy(*KEY).agg(
        F.min("late").alias("late"),
        F.max("timestamp").alias("timestamp"),
        newest("bitcoin_price", "price_at").alias("bitcoin_price"),
        F.max("price_at").alias("price_at"),
        *[F.sum(name).alias(name) for name in [*COUNTS, *SUMS]],
    )
    return whole.select(*STATE_SCHEMA.fieldNames())


def speed_of(states: DataFrame) -> DataFrame:
    """Speed rows, without their change, from merged states."""
    ticks = states.filter(F.col("kind") == TICK).select("symbol", "window_start", "timestamp", "bitcoin_price")
    posts = states.filter(F.col("kind") == POST).select(
        "window_start",
        F.col("n_rows").alias("posts_last_5_minutes"),
        *[F.try_divide(f"sum_{label}", f"n_{label}").alias(f"avg_sentiment_{label}") for label in LABELS],
    )
    return join_posts(ticks, posts)
