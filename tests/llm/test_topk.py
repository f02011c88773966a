import math

import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import topk

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, q string, node string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], VECTORS)


def search(spark, rows, k=5):
    found = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, k)
    return sorted(tuple(row) for row in found.collect())


def brute(rows, k=5):
    usable = {
        (i, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, v in usable:
        if i % 50 == 0:
            scored = [
                (-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(w) == len(v)
            ]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_edge_rows(spark):
    rows = [
        (0, [1.0, 0.5]),
        (0, [1.0, 0.5]),  # repeated
        (50, [-1.0, 0.25]),
        (1, [1.0, 0.5]),
        (2, [1.0, 0.5]),  # ties
        (3, None),
        (4, [1.0, None]),
        (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]),
        (7, [1.0]),  # another length
        (8, []),
        (None, [1.0, 1.0]),
        (-50, [0.1, -0.1]),
        (9, [-3.0, 0.0]),
    ]
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows, k=1) == brute(rows, k=1)


def test_no_rows_and_no_queries(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_many_tiles_and_levels(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_ROWS", 2)
    monkeypatch.setattr(topk, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk, "SHARDS_PER_NODE", 2)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4).round(1)]) for i in range(600)]
    rows += [(1000 + i, rows[17][1]) for i in range(200)]  # one hot vector
    assert search(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** (i % 20)) * (-1) ** i, 2.0**18 + i, 1.0]) for i in range(60)]
    assert search(spark, rows) == brute(rows)
    huge = [(0, [3e38, -3e38]), (1, [3e38, 1.0]), (2, [-3e38, 3e38])]
    assert [row[:3] for row in search(spark, huge)] == [(0, 1, 1), (0, 2, 2)]
