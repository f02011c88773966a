"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import run_folder, shared_folder

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text, in order; none of a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def skewed_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, floor: int = 1000, share: float = 1e-5
) -> DataFrame:
    """Join on keys of which some may have a large part of the left rows.

    Keys with more than ``floor`` rows and ``share`` of all are split into parts of about
    that size, and their right rows repeated for each. At most 1 / share keys are split,
    whatever the input, so their list is broadcast.
    """
    bound = max(floor, share * left.count())
    hot = (
        left.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > bound)
        .select(*keys, F.ceil(F.col("n") / bound).cast("int").alias("_parts"))
    )
    row = F.monotonically_increasing_id()
    no_key = F.greatest(*[F.col(key).isNull().cast("int") for key in keys], F.lit(0)) == 1
    # Rows with a null key meet nothing and go anywhere.
    part = F.when(no_key, F.pmod(row, F.lit(1 << 20))).otherwise(F.pmod(row, F.coalesce("_parts", F.lit(1))))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("_part", part.cast("int")).drop("_parts")
    last = F.coalesce("_parts", F.lit(1)) - 1
    copies = right.join(F.broadcast(hot), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
    return dealt.join(copies.drop("_parts"), [*keys, "_part"], how).drop("_part")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by files in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by several jobs."""
    folder = run_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
