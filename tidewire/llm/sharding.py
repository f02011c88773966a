"""Shards of nearly equal bytes by Karmarkar-Karp differencing, with equal texts kept together.

Documents with one text are a group that isn't divided. A group with at least its share
of the bytes, total / ``cells``, is an item of its own, so there are at most ``cells``
of these; the other groups are filed by their hash under ``cells`` items. So differencing
has at most 2 * ``cells`` items at every input size, and an item is a small part of a
shard. Every item starts as a partial partition with one filled place; the two partial
partitions with the largest spread are combined, the fullest places of one with the
emptiest of the other, until one is left. Documents find their item by the hash of their
text alone: there is no join by group, and a text with very many copies is one row of
the group table from the first task on.

Defined results
- A null text has no bytes and is in the group of empty texts; its size is the overhead.
- Repeated rows are documents of their own and go to the shard of their text.
- Which of two documents of a shard has the lower slot is left open; slots have no gaps.
- A text of any length counts whole; one larger than a shard's share fills a shard alone.
- An empty table gives no rows.
- Other columns of the input, whatever their names, are kept in ``row`` by ``assign``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.llm.common import written

SHARDS = 40
CELLS = 1 << 14
OVERHEAD = 16
LAW = "bytes"


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of every size, by largest differencing."""
    # A node is a partial partition: sums ascending, and for a combined one the nodes it
    # came from with the places that theirs went to.
    nodes: list[tuple] = []
    heap = []
    for at, size in enumerate(sizes):
        sums = np.zeros(shards, np.int64)
        sums[-1] = size
        heap.append((-size, at, sums))
        nodes.append(())
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, first = heapq.heappop(heap)
        _, b, second = heapq.heappop(heap)
        sums = first + second[::-1]
        order = np.argsort(sums, kind="stable")
        place = np.empty(shards, np.int16)
        place[order] = np.arange(shards, dtype=np.int16)
        sums = sums[order]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), len(nodes), sums))
        nodes.append((a, b, place))
    where: dict[int, np.ndarray] = {len(nodes) - 1: np.arange(shards, dtype=np.int16)}
    out = [0] * len(sizes)
    for at in range(len(nodes) - 1, -1, -1):
        final = where.pop(at)
        if nodes[at]:
            a, b, place = nodes[at]
            own = final[place]
            where[a], where[b] = own, own[::-1]
        else:
            out[at] = int(final[-1])
    return out


def _numbered(width: int):
    """Rows with their number among those of one shard in the task, and the task's number."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(width, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=width)
            nth = np.empty(len(shard), np.int64)
            within = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts)
            nth[order] = within + seen[shard[order]]
            seen += counts
            batch = batch.append_column("part", pa.array(np.full(len(shard), part, np.int32)))
            yield batch.append_column("nth", pa.array(nth))

    return number


def item_shards(
    rows: DataFrame, shards: int, cells: int
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(group, shard) of large groups and (cell, shard) of all the others.

    ``rows`` has ``group`` and ``size``; at most 2 * ``cells`` sums come to the driver.
    """
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    large = F.col("size").cast("decimal(20,0)") * cells >= F.lit(total)
    alone = groups.filter(large).select(F.col("group").alias("item"), "size").collect()
    rest = (
        groups.filter(~large).groupBy(cell_of(F.col("group"), cells).alias("item")).agg(F.sum("size").alias("size"))
    ).collect()
    # In a fixed order, so that a second run deals them out alike.
    alone, rest = sorted(map(tuple, alone)), sorted(map(tuple, rest))
    found = difference([size for _, size in alone + rest], shards)
    pairs = [(item, shard) for (item, _), shard in zip(alone + rest, found)]
    return pairs[: len(alone)], pairs[len(alone) :]


def cell_of(group: Column, cells: int) -> Column:
    return F.pmod(group, F.lit(cells).cast("bigint"))


def assign(
    docs: DataFrame, shards: int = SHARDS, text_col: str = "text", cells: int = CELLS, overhead: int = OVERHEAD
) -> DataFrame:
    """(row, size, text_crc32, group, shard) of every row of ``docs``; ``row`` has its columns."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        (F.octet_length(text).cast("bigint") + overhead).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # Texts with one hash by chance go together like copies: the balance hardly feels it.
        F.xxhash64(text).alias("group"),
    )
    alone, rest = item_shards(rows, shards, cells)
    large = spark.createDataFrame(alone, "group bigint, own int")
    small = spark.createDataFrame(rest, "cell bigint, shared int")
    return (
        rows.withColumn("cell", cell_of(F.col("group"), cells))
        .join(F.broadcast(large), "group", "left")
        .join(F.broadcast(small), "cell", "left")
        .select("row", "size", "text_crc32", "group", F.coalesce("own", "shared").alias("shard"))
    )


def slots(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` with ``slot``, which counts the rows of each shard from 0 without gaps.

    A row's slot is its number in the task that wrote it, plus the shard's rows of earlier tasks.
    """
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("part int, nth bigint").fields])
    numbered = written(rows.mapInArrow(_numbered(shards), schema), "numbered")
    counts = numbered.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    slot = (F.col("before") + F.col("nth")).alias("slot")
    return numbered.join(before, ["shard", "part"]).select(*rows.columns, slot)


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS, text_col: str = "text", name: str = "shard"
) -> None:
    """The rows of ``docs`` as Parquet, a folder ``name=n`` for each shard, by several tasks each.

    ``docs`` must have no column ``name``.
    """
    dealt = assign(docs, shards, text_col).select("row.*", F.col("shard").alias(name))
    dealt.write.partitionBy(name).parquet(folder)
