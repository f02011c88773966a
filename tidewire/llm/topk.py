"""Exact top-k search by inner product: tiled products, partial lists, tree merge.

Queries are packed into tiles, candidates into shards, both of bounded size. A
grid of (tile, node) keys brings every tile together with every shard: each pair
is one matrix product in one Arrow row, from which only the best k per query are
kept. The partial lists are merged upwards in groups of ``FAN_IN``.

Defined results
- A vector that is null or has null, NaN or infinite components takes no part.
- Rows equal in id and vector count once. Different vectors under one id are all
  candidates, and each is searched for on its own; rows with the query's id are
  never its results. Rows without an id take no part.
- Vectors of other lengths have no inner product with the query and are passed over.
- Ties go to the smaller id. Fewer than k candidates: all of them.
- Scores beyond the range of long are cut to its ends.
- An empty table, or one without queries, gives no rows; other columns take no part.
- A vector of any length is one row of its block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE_ROWS = 1024
SHARD_ROWS = 2048
SHARDS_PER_NODE = 8
FAN_IN = 32

BLOCK = "part bigint, dim int, ids binary, kind string, cells binary"
FOUND = "query_id bigint, query_key bigint, node bigint, tops array<struct<score:bigint,rev:bigint>>"


def grid(vector: Column, scale: int = 256) -> Column:
    """Components as integers: floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def finite(vector: Column) -> Column:
    """True for a vector that is there and has only finite components."""
    infinite = F.lit(float("inf"))
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinite)
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _narrow(cells: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    low, high = cells.min(initial=0), cells.max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return cells.astype(kind)
    return cells


def _blocks(rows: int):
    """Packs rows (part, id, vector) into blocks of one part and length, ``rows`` rows at most."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).to_numpy(zero_copy_only=False)
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.asarray(batch.column(2).offsets)
            values = batch.column(2).values.to_numpy(zero_copy_only=False)
            sizes = np.diff(starts)
            order = np.lexsort((ids, sizes, parts))
            new_run = (np.diff(parts[order]) != 0) | (np.diff(sizes[order]) != 0)
            out = []
            for run in np.split(order, np.flatnonzero(new_run) + 1):
                for k in range(0, len(run), rows):
                    own = run[k : k + rows]
                    dim = int(sizes[own[0]])
                    cells = _narrow(values[starts[own][:, None] + np.arange(dim)])
                    out.append((parts[own[0]], dim, ids[own].tobytes(), cells.dtype.str, cells.tobytes()))
            types = [pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.binary()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "dim", "ids", "kind", "cells"])

    return pack


def _rows(ids: bytes, kind: str, cells: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(cells, np.dtype(kind)).reshape(len(own), dim).astype(np.int64)


def _scores(query: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles while these hold them, else in longs or Python integers."""
    query_real, shard_real = query.astype(float), shard.astype(float)
    most = np.abs(query_real).max(initial=0) * np.abs(shard_real).max(initial=0) * query.shape[1]
    if most < 2**53:
        return (query_real @ shard_real.T).astype(np.int64)
    if most < 2**62:
        return query @ shard.T
    exact = query.astype(object) @ shard.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _products(k: int):
    """The best k of each query of a tile among the rows of a shard."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                query_ids, query = _rows(row["ids"], row["kind"], row["cells"], dim)
                shard_ids, shard = _rows(row["s_ids"], row["s_kind"], row["s_cells"], dim)
                scores = _scores(query, shard)
                own = query_ids[:, None] == shard_ids[None, :]
                take = min(k + int(own.sum(axis=1).max()), len(shard_ids))
                least = np.partition(scores, -take, axis=1)[:, -take]
                offsets, best_scores, best_ids, query_keys = [0], [], [], []
                for i in range(len(query_ids)):
                    near = np.flatnonzero((scores[i] >= least[i]) & ~own[i])
                    # Ids ascend within a shard: a stable order leaves ties in order of id.
                    near = near[np.argsort(~scores[i][near], kind="stable")][:k]
                    best_scores.append(scores[i][near])
                    best_ids.append(~shard_ids[near])
                    offsets.append(offsets[-1] + len(near))
                    query_keys.append(xxhash.xxh64_intdigest(query[i].tobytes()) - 2**63)
                tops = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(np.concatenate(best_scores)), pa.array(np.concatenate(best_ids))],
                        names=["score", "rev"],
                    ),
                )
                node = pa.array(np.full(len(query_ids), row["node"], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids), pa.array(query_keys, pa.int64()), node, tops],
                    names=["query_id", "query_key", "node", "tops"],
                )

    return search


def _merge(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    # ~id falls as the id grows, so one falling order serves both score and ties.
    lists = F.sort_array(F.flatten(F.collect_list("tops")), asc=False)
    return found.groupBy(*keys).agg(F.slice(lists, 1, k).alias("tops"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of each row where ``is_query`` holds."""
    rows = (
        vectors.filter(F.col(id_col).isNotNull() & finite(F.col(vector_col)))
        .select(
            F.col(id_col).cast("bigint").alias("id"),
            grid(F.col(vector_col), scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
        )
        .dropDuplicates(["id", "v", "q"])
    )
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("n_q")).first()
    tiles = max(1, -(-size["n_q"] // TILE_ROWS))
    nodes = max(1, -(-size["n"] // (SHARD_ROWS * SHARDS_PER_NODE)))
    queries = (
        rows.filter("q")
        .select(F.pmod(F.xxhash64("id"), F.lit(tiles)).alias("part"), "id", "v")
        .repartition(tiles, "part")
        .mapInArrow(_blocks(TILE_ROWS), BLOCK)
        .withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
    )
    shards = (
        rows.select(F.lit(0).cast("bigint").alias("part"), "id", "v")
        .mapInArrow(_blocks(SHARD_ROWS), BLOCK)
        .select(
            "dim",
            F.pmod(F.xxhash64("ids"), F.lit(nodes)).cast("int").alias("node"),
            F.col("ids").alias("s_ids"),
            F.col("kind").alias("s_kind"),
            F.col("cells").alias("s_cells"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))).alias("part"),
        )
    )
    found = queries.join(shards, ["part", "node", "dim"]).mapInArrow(_products(k), FOUND)
    # Lists of one node meet first; then nodes merge upwards, FAN_IN at a time.
    merged = _merge(found, ["query_id", "query_key", "node"], k)
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        merged = merged.withColumn("node", F.floor(F.col("node") / FAN_IN))
        merged = _merge(merged, ["query_id", "query_key", "node"], k)
    return merged.select("query_id", F.posexplode("tops").alias("at", "top")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.bitwise_not("top.rev").alias("id"),
        F.col("top.score").alias("score"),
    )
