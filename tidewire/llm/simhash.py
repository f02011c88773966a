"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

A fingerprint has 64 bits in six blocks. Fingerprints that differ in at most two
bits agree on at least four blocks, so each is filed under its fifteen choices of
four blocks and compared only with those under the same key. Copies are one
fingerprint from the start. A key leaves 20 to 22 bits open, so a key has at most
2^22 fingerprints whatever the input: the group has a proven bound. A group
returns a spanning star of each linked part, not its pairs, so rows stay below the
number of fingerprints; components follow from alternating large and small stars.

Defined results
- Null texts and texts without a word have fingerprint zero, and link like others.
- Fewer words than a shingle: the whole sequence is the one shingle.
- Repeated rows keep one row each, all with the same fingerprint and component.
- Rows without an id have a fingerprint; their component is the smallest id
  reachable, null if no linked row has an id.
- A text of any length is hashed whole by one task; an empty table gives no rows.
- Other columns take no part; ``keep_one`` returns them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import checkpointed

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)
# Groups up to this size are compared pair by pair, larger ones by shared neighbours.
PAIRWISE = 1024


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]).tolist()
    starts = [0, *ends[: max(0, len(words) - size)]]
    hashed = xxhash.xxh64_intdigest
    hashes = [hashed(line[a : b - 1], SEED) for a, b in zip(starts, ends[min(size, len(words)) - 1 :])]
    cells = np.array(hashes, np.uint64).view(np.uint8)
    total = np.zeros(64, np.int64)
    for k in range(0, len(cells), 1 << 20):
        bits = np.unpackbits(cells[k : k + (1 << 20)].reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(total * 2 > len(hashes))
    return sum(1 << int(bit) for bit in set_bits)


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        values = np.array([fingerprint(text) for text in batch], np.uint64)
        yield pd.Series(values.view(np.int64))


def fingerprint_column(text: Column) -> Column:
    """The fingerprint as a signed long with the same 64 bits."""
    return F.pandas_udf(_fingerprints, "bigint")(text)


def _masks() -> list[int]:
    edges = np.cumsum((0, *BLOCKS)).tolist()
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    chosen = [sum(four) for four in combinations(blocks, len(BLOCKS) - MAX_BITS)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in chosen]


def _parts(prints: np.ndarray, open_bits: np.ndarray) -> np.ndarray:
    """For each fingerprint of a group the index of the first one it is linked with, in any steps."""
    root = np.arange(len(prints))
    if len(prints) <= PAIRWISE:
        near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= MAX_BITS
        a, b = np.nonzero(near)
    else:
        # Two fingerprints at most two bits apart have a neighbour in common that is
        # at most one bit from each (or is one of them); it lies within the open bits.
        hubs = np.concatenate([prints, *(prints ^ bit for bit in open_bits)])
        owner = np.tile(np.arange(len(prints)), len(open_bits) + 1)
        order = np.argsort(hubs, kind="stable")
        hubs, owner = hubs[order], owner[order]
        same = np.flatnonzero(hubs[1:] == hubs[:-1])
        a, b = owner[same], owner[same + 1]
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        least = least[least]
        if np.array_equal(least, root):
            return root
        root = least


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that span each linked part of every run of rows (mask, key, f) with one key.

    Rows come sorted; a run that reaches the end of a batch waits for the next one.
    """
    ones = np.uint64(1) << np.arange(64, dtype=np.uint64)

    def linked(rows: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask, key, prints = rows
        cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(mask)]
        if not last:
            starts, ends, rows = starts[:-1], ends[:-1], rows[:, starts[-1] :]
        prints = prints.view(np.uint64)
        pairs = starts[ends - starts == 2]
        pairs = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= MAX_BITS]
        lows, highs = [prints[pairs]], [prints[pairs + 1]]
        for k in np.flatnonzero(ends - starts > 2):
            group = prints[starts[k] : ends[k]]
            root = _parts(group, ones[(mask[starts[k]].view(np.uint64) & ones) == 0])
            moved = np.flatnonzero(root != np.arange(len(group)))
            lows.append(group[root[moved]])
            highs.append(group[moved])
        return np.concatenate(lows), np.concatenate(highs), rows

    kept = np.empty((3, 0), np.int64)
    for batch in batches:
        if batch.num_rows:
            now = np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
            low, high, kept = linked(np.concatenate([kept, now], axis=1), last=False)
            yield _links_batch(low, high)
    if kept.size:
        yield _links_batch(*linked(kept, last=True)[:2])


def _links_batch(low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(x.view(np.int64)) for x in (low, high)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def links(prints: DataFrame) -> DataFrame:
    """Links between the distinct fingerprints ``f``, enough to join every linked set."""
    masks = F.array(*[F.lit(mask).cast("bigint") for mask in _masks()])
    filed = prints.select("f", F.explode(masks).alias("mask"))
    filed = filed.select("mask", F.col("f").bitwiseAND(F.col("mask")).alias("key"), "f")
    runs = filed.repartition("mask", "key").sortWithinPartitions("mask", "key", "f")
    return runs.mapInArrow(_stars, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reachable.

    Alternating large and small stars: every round links the larger neighbours of a
    node, and then the smaller ones, to the smallest of them. Rounds grow with the
    logarithm of the longest chain. Each round's links are checkpointed.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not larger:
            both = both.filter("b <= a")
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        if larger:
            moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = (
                both.join(least, "a")
                .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            )
        return moved.filter("a <> b").distinct()

    edges = checkpointed(edges.filter("a <> b").select("a", "b").distinct())
    state = None
    while True:
        edges = checkpointed(star(star(edges, larger=True), larger=False))
        now = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _classes(marked: DataFrame) -> DataFrame:
    """(f, root) of every fingerprint in ``marked``; linked ones have one root."""
    prints = marked.select("f").distinct()
    roots = components(links(prints))
    return prints.join(roots, prints["f"] == roots["node"], "left").select(
        "f", F.coalesce("root", "f").alias("root")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``."""
    marked = checkpointed(
        docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col)).alias("f"))
    )
    least = marked.groupBy("f").agg(F.min("doc_id").alias("least"))
    linked = least.join(_classes(marked), "f")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(smallest, "root").select("f", "component_id")
    return marked.join(classes, "f").select(
        "doc_id",
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the one with the smallest id.

    Rows without an id come last; of rows with one id, the one with the smallest digest stays.
    """
    given = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit((1 << 63) - 1)).alias("id"),
        F.xxhash64(*[F.col(f"`{name}`") for name in docs.columns]).alias("digest"),
        F.col(text_col).alias("text"),
    )
    marked = checkpointed(given.select("id", "digest", fingerprint_column(F.col("text")).alias("f")))
    alike = marked.groupBy("f", "id", "digest").agg(F.count("*").alias("n"))
    # One row for each fingerprint before the join, however many copies have it.
    first = alike.groupBy("f").agg(F.min(F.struct("id", "digest", "n")).alias("first"))
    first = (
        first.join(_classes(marked), "f").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    )
    stay = given.select("row", "id", "digest").join(first, ["id", "digest"])
    # Few rows have an equal beside them that has to go.
    again = stay.filter("n > 1").dropDuplicates(["id", "digest"])
    return stay.filter("n = 1").unionByName(again).select("row.*")
