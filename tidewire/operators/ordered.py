"""Ordered lookups without one long ordered group: lag, as-of join and trailing sums by time buckets.

A plain ``lag`` over a key sorts all rows of that key in one task, and over no
key all rows of the table. Here rows meet only within a slot, that is a key and a
bucket of time. Buckets have one fixed span for all keys and days. What a slot
needs from before its start is carried in: from bucket to bucket within a day,
and from day to day.

Bounds, whatever the input and its skew: instants are distinct within a key and
have microseconds, so a bucket holds at most ``span`` rows of facts, a million for
the default second. A day of a key has 86,400 such buckets, and the days of a key
are bounded by the calendar.

The rows are shuffled once, by slot. Both uses of them, for what a slot leaves
behind and for the lookup, read all columns, so that Spark takes the same shuffle
for both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY, MINUTE, SECOND = 86_400_000_000, 60_000_000, 1_000_000  # microseconds
# Parts that the questions of one instant are spread over.
SPREAD = 16
# Instants of a minute beyond which a trailing sum splits it.
HOT = 100_000
BEFORE = (Window.unboundedPreceding, -1)


def lag_by(
    df: DataFrame, keys: Sequence[str], at: str, values: dict[str, str], span: int = SECOND
) -> DataFrame:
    """Values of the row before, per key in order of ``at``.

    ``values`` maps a column to the name of its lagged copy. ``at`` must be
    unique within a key; rows without it stay, with NULLs.
    """
    keys, columns = list(keys), list(values)
    rows = _slotted(df, keys, F.col(at), span)
    tails = [F.max_by(column, at).alias(column) for column in columns]
    seeds = _carried(_per_slot(rows, df.columns, tails), keys, columns)
    order = Window.partitionBy("_slot").orderBy(at)
    first = F.row_number().over(order) == 1
    lagged = {
        name: F.when(F.col(at).isNull(), None)
        .when(first, F.col(f"_carry.{column}"))
        .otherwise(F.lag(column).over(order))
        for column, name in values.items()
    }
    return rows.join(seeds, "_slot", "left").select(
        *df.columns, *[column.alias(name) for name, column in lagged.items()]
    )


def as_of(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    values: dict[str, str],
    ties: Sequence[str],
    by: Sequence[str] = (),
    span: int = SECOND,
) -> DataFrame:
    """Each left row with the values of the newest right row at or before it.

    ``values`` maps a right column to its name in the result. Left rows without
    a match stay, with NULLs, and so do those with a NULL key or time. Right rows
    of one instant are told apart by ``ties``, which are not NULL; the greatest wins.

    The left side is shuffled once, by key, instant and one of ``SPREAD`` parts. Only
    the distinct ones of these go through the ordered pass, and the left rows take
    their answers by equality. So very many left rows at one instant never meet in
    one task.
    """
    keys, names = list(by), list(values.values())
    facts = right.select(
        *keys,
        F.col(right_at).alias("_at"),
        *[F.col(column).alias(name) for column, name in values.items()],
        *[F.col(column).alias(f"_tie_{column}") for column in ties],
    ).filter(F.col("_at").isNotNull())
    # One right row per (key, instant). By a single column each value is picked by
    # itself, which stays in hash aggregation; a struct would not.
    if len(ties) == 1:
        facts = facts.groupBy(*keys, "_at").agg(*[F.max_by(n, f"_tie_{ties[0]}").alias(n) for n in names])
    else:
        age = F.struct(*[F.col(f"_tie_{column}") for column in ties])
        greatest = F.max_by(F.struct(*names), age).alias("_fact")
        facts = facts.groupBy(*keys, "_at").agg(greatest).select(*keys, "_at", "_fact.*")

    asked, asking = _asking(left, keys, left_at)
    both = facts.withColumn("_is_fact", F.lit(1)).unionByName(asked, allowMissingColumns=True)
    rows = _slotted(both, keys, F.col("_at"), span)
    instant = F.when(F.col("_is_fact") == 1, F.col("_at"))
    tails = [F.max_by(name, instant).alias(name) for name in names]
    seeds = _carried(_per_slot(rows, both.columns, tails, F.max("_is_fact")), keys, names)
    # Within one instant a fact comes before the questions.
    order = Window.partitionBy("_slot").orderBy("_at", F.col("_is_fact").desc_nulls_last())
    fact = F.when(F.col("_is_fact") == 1, F.struct(*names))
    newest = F.last(fact, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    answers = (
        rows.join(seeds, "_slot", "left")
        .withColumn("_newest", F.coalesce(newest, "_carry"))
        .filter(F.col("_ask").isNotNull())
        .select("_ask", "_newest.*")
    )
    return asking.join(answers, "_ask", "left").select(*left.columns, *names)


def trailing(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    seconds: int,
    count: str,
    sums: dict[str, str] | None = None,
    by: Sequence[str] = (),
    hot: int = HOT,
) -> DataFrame:
    """Each left row with the number of right rows in the ``seconds`` up to its time, both ends included.

    ``sums`` maps integral or decimal right columns to the names of their sums over the
    same rows, NULL where there are none. Left rows with a NULL key or time have NULLs.

    A right row enters the count at its time and leaves it when the range has passed it.
    So the result is one running total, of +1 and -1, at the left row's time: the total
    within a slot plus what the slots before it leave. Right rows of one instant are
    added up first, and left rows of one instant ask once (for each of ``SPREAD`` parts).
    A slot is a minute; minutes with over ``hot`` instants, or a hundred-thousandth of
    all if that is more, are split into seconds. So at most 100,000 minutes are listed
    as split, which is broadcast, and a slot has at most a million distinct instants or
    about ``hot``.
    """
    keys, sums = list(by), sums or {}
    named = {count: F.lit(1).cast("bigint"), **{name: F.col(column) for column, name in sums.items()}}
    totals = list(named)
    # How many rows have a value, to tell a sum of 0 from none.
    named |= {f"_has_{name}": F.col(column).isNotNull().cast("bigint") for column, name in sums.items()}
    names = list(named)
    come = right.select(
        *keys, F.unix_micros(right_at).alias("_micros"), *[column.alias(name) for name, column in named.items()]
    ).filter(reduce(Column.__and__, [F.col(name).isNotNull() for name in [*keys, "_micros"]]))
    come = come.groupBy(*keys, "_micros").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    gone = F.col("_micros") + seconds * SECOND + 1
    moves = F.array(
        F.struct(F.col("_micros").alias("_micros"), *[F.col(name) for name in names]),
        F.struct(gone.alias("_micros"), *[(-F.col(name)).alias(name) for name in names]),
    )
    facts = come.select(*keys, F.explode(moves).alias("_move")).select(*keys, "_move.*")

    ask, asking = _asking(left, keys, left_at)
    asked = ask.select(*keys, F.unix_micros("_at").alias("_micros"), "_ask")
    rows = _in_slots(facts.unionByName(asked, allowMissingColumns=True), keys, hot)
    running = Window.partitionBy("_slot").orderBy("_micros").rangeBetween(Window.unboundedPreceding, 0)
    seeds = _carried_totals(rows, keys, names)
    answers = (
        rows.withColumns({name: F.sum(F.col(name)).over(running) for name in names})
        .filter(F.col("_ask").isNotNull())
        .join(seeds, "_slot", "left")
        .select(
            "_ask",
            *[
                (F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_before.{name}"), F.lit(0))).alias(name)
                for name in names
            ],
        )
    )
    found = {name: F.when(F.col(f"_has_{name}") > 0, F.col(name)) if name in sums.values() else F.col(name) for name in totals}
    return asking.join(answers, "_ask", "left").select(
        *left.columns, *[column.alias(name) for name, column in found.items()]
    )


def _asking(left: DataFrame, keys: list[str], left_at: str) -> tuple[DataFrame, DataFrame]:
    """The distinct questions of ``left`` (keys, _at, _ask), and ``left`` dealt out by ``_ask``."""
    part = F.when(F.col(left_at).isNull(), F.spark_partition_id() + SPREAD).otherwise(
        F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    )
    ask = F.struct(*keys, F.col(left_at).alias("_at"), part.alias("_part"))
    asking = left.withColumn("_ask", ask).repartition("_ask")
    whole = [F.col(f"_ask.{name}").isNotNull() for name in [*keys, "_at"]]
    asked = _grouped(asking, "_ask", left.columns, reduce(Column.__and__, whole)).select(
        *[F.col(f"_ask.{key}").alias(key) for key in keys], F.col("_ask._at").alias("_at"), "_ask"
    )
    return asked, asking


def _in_slots(rows: DataFrame, keys: list[str], hot: int) -> DataFrame:
    """Rows with a slot of their key: a minute, or a second of a minute with many rows."""

    def start(span: int) -> Column:
        return F.col("_micros") - F.pmod(F.col("_micros"), F.lit(span))

    minutes = rows.withColumn("_minute", start(MINUTE))
    counts = minutes.groupBy(*keys, "_minute").agg(F.count("*").alias("_n"))
    bound = F.greatest(F.lit(hot), counts.agg(F.sum("_n")).scalar() / 100_000)
    split = counts.filter(F.col("_n") > bound).select(*keys, "_minute", F.lit(True).alias("_split"))
    bucket = F.when(F.col("_split"), start(SECOND)).otherwise(F.col("_minute")).alias("_bucket")
    return minutes.join(F.broadcast(split), [*keys, "_minute"], "left").select(
        *rows.columns, F.struct(*keys, bucket).alias("_slot")
    )


def _carried_totals(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(_slot, _before): the totals of the key over all slots before each one."""
    slots = rows.groupBy("_slot").agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])
    bucket = F.col("_slot._bucket")
    slots = slots.withColumn("_of", F.struct(*[f"_slot.{key}" for key in keys], (bucket - F.pmod(bucket, F.lit(DAY))).alias("_day")))
    days = slots.groupBy("_of").agg(*[F.sum(name).alias(name) for name in names])
    by_key = Window.partitionBy(*([f"_of.{key}" for key in keys] or [F.lit(0)])).orderBy("_of._day")
    by_day = Window.partitionBy("_of").orderBy("_slot._bucket")

    def earlier(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(*BEFORE)), F.lit(0))

    into_day = days.select("_of", *[earlier(name, by_key).alias(f"_into_{name}") for name in names])
    within = slots.select("_slot", "_of", *[earlier(name, by_day).alias(name) for name in names])
    before = F.struct(*[(F.col(name) + F.col(f"_into_{name}")).alias(name) for name in names])
    return within.join(into_day, "_of").select("_slot", before.alias("_before"))


def _slotted(rows: DataFrame, keys: list[str], at: Column, span: int) -> DataFrame:
    """Rows with their ``_slot``, dealt out by it.

    A struct compares NULL keys as equal. Rows without a time have no bucket, and
    share their slot with those of the same input partition only.
    """
    micros = F.unix_micros(at)
    bucket = (micros - F.pmod(micros, F.lit(span))).alias("_bucket")
    alone = F.when(at.isNull(), F.spark_partition_id()).alias("_alone")
    return rows.withColumn("_slot", F.struct(*keys, bucket, alone)).repartition("_slot")


def _grouped(
    rows: DataFrame, key: str, columns: Sequence[str], where: Column, *aggregates: Column
) -> DataFrame:
    """Groups of the rows that were dealt out by ``key``, those where ``where`` holds.

    The condition is part of an aggregate over all columns. As a filter, or with
    fewer columns, it would reach below the shuffle, which then could not be the one
    that the lookup uses.
    """
    kept = F.max(F.when(where, F.xxhash64(*columns))).alias("_kept")
    return rows.groupBy(key).agg(*aggregates, kept).filter("_kept is not null").drop("_kept")


def _per_slot(
    rows: DataFrame, columns: Sequence[str], tails: list[Column], has: Column | None = None
) -> DataFrame:
    """Newest values of each slot that has a bucket; ``_has`` is NULL if there are none.

    Values are carried field by field: numbers then stay in hash aggregation, which
    a struct buffer would not.
    """
    has = F.max(F.lit(1)) if has is None else has
    timed = F.col("_slot._bucket").isNotNull()
    return _grouped(rows, "_slot", columns, timed, *tails, has.alias("_has"))


def _carried(slots: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(_slot, _carry): the newest values of the key before each slot, where there are any."""
    bucket = F.col("_bucket")
    slots = slots.select(
        "_slot",
        *[F.col(f"_slot.{key}").alias(f"_key_{key}") for key in keys],
        F.col("_slot._bucket").alias("_bucket"),
        *values,
        "_has",
    ).withColumn("_day", bucket - F.pmod(bucket, F.lit(DAY)))
    names = [f"_key_{key}" for key in keys]
    has_at = F.when(F.col("_has") == 1, bucket)
    days = slots.groupBy(*names, "_day").agg(
        F.max(has_at).alias("_newest"), *[F.max_by(value, has_at).alias(value) for value in values]
    )

    def newest(there: Column, window) -> Column:
        return F.last(F.when(there, F.struct(*values)), ignorenulls=True).over(window.rowsBetween(*BEFORE))

    by_key = Window.partitionBy(*(names or [F.lit(0)])).orderBy("_day")
    into_day = days.select(
        F.struct(*names, "_day").alias("_of"), newest(F.col("_newest").isNotNull(), by_key).alias("_into")
    )
    by_day = Window.partitionBy(*names, "_day").orderBy("_bucket")
    within = slots.select(
        "_slot", F.struct(*names, "_day").alias("_of"), newest(F.col("_has") == 1, by_day).alias("_within")
    )
    carry = F.coalesce("_within", "_into").alias("_carry")
    return within.join(into_day, "_of").select("_slot", carry).filter(F.col("_carry").isNotNull())
