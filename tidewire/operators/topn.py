"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    spread: int | None = None,
) -> DataFrame:
    """First ``n`` rows per group with their rank from 1. ``order`` must be total.

    The rank filter becomes a group limit that keeps ``n`` rows per group and
    input partition before the shuffle. With few groups over very many input
    partitions, ``spread`` merges those in that many parts per group first, so
    that no task takes a hot group's rows from all partitions.
    """
    if spread:
        part = F.pmod(F.spark_partition_id(), F.lit(spread))
        df = _limit(df.withColumn("_part", part), [*keys, "_part"], order, n, "_rank")
        df = df.drop("_part", "_rank")
    return _limit(df, keys, order, n, rank)


def _limit(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
