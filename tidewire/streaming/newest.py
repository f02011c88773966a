"""The newest rows of each group on a stream, kept as a bounded table.

The state is the ``n`` first rows of each group, in files: a micro-batch is pruned to its
own first rows, merged with the state that the batch before it left, and written as the
state of its number. A state has at most ``n`` rows for each group whatever the length of
the stream, and a hot group is pruned in every input partition before its rows meet. The
state of a number is written whole and follows from the batch and the state before alone,
so a batch that runs again after a failure writes the same. Folders of older states may
expire at any time once a newer one is complete.

A row that arrives twice is one row: equal rows are dropped when batch and state merge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators.topn import top_n

# Parts in which the rows of a group meet first.
SPREAD = 64


def writer(
    path: str, keys: Sequence[str], order: Sequence[Column], n: int, run: int = 0
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. ``order`` must tell any two different rows of a group apart."""

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = _before(spark, path, rows.schema, run, batch_id)
        own = top_n(rows.distinct(), keys, order, n, spread=SPREAD).drop("rank")
        merged = own if before is None else top_n(own.unionByName(before).distinct(), keys, order, n).drop("rank")
        merged.write.mode("overwrite").parquet(f"{path}/run_id={run}/batch_id={batch_id}")

    return write


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields]).add("run_id", "long").add("batch_id", "long")
    return spark.read.schema(full).parquet(path)


def _before(spark: SparkSession, path: str, schema: T.StructType, run: int, batch_id: int) -> DataFrame | None:
    """The state that the last batch before ``batch_id`` left, of this run or an earlier one."""
    try:
        stored = _stored(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    number = F.struct("run_id", "batch_id")
    earlier = stored.filter(number < F.struct(F.lit(run).cast("long"), F.lit(batch_id).cast("long")))
    return _last(earlier)


def _last(states: DataFrame) -> DataFrame | None:
    last = states.agg(F.max(F.struct("run_id", "batch_id")).alias("number")).first()["number"]
    if last is None:
        return None
    own = (F.col("run_id") == last["run_id"]) & (F.col("batch_id") == last["batch_id"])
    return states.filter(own).drop("run_id", "batch_id")


def view(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """The newest complete state, with ranks."""
    stored = _stored(spark, path, schema)
    last = _last(stored)
    return top_n(stored.drop("run_id", "batch_id").limit(0) if last is None else last, keys, order, n, rank=rank)
