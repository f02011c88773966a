import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidewire.llm import raking

DIMS = ["source", "lang", "topic"]


def cells_of(spark):
    rows = [
        (f"s{s}", f"l{t}", f"t{u}", 10, 100 * (1 + s * 5) * (1 + t) * (3 - u) + 7 * s * t + 11 * t * u)
        for s in range(4) for t in range(3) for u in range(3)
    ]
    return spark.createDataFrame(rows, "source string, lang string, topic string, docs bigint, tokens bigint")


def margins(cells, dim):
    kept = cells.groupBy(dim).agg(F.sum(F.col("tokens") * F.col("share")).alias("kept"))
    rows = {row[dim]: row["kept"] for row in kept.collect()}
    total = sum(rows.values())
    return {value: kept / total for value, kept in rows.items()}, total


def test_margins_meet_given_targets(spark):
    targets = {
        "source": {"s0": 1, "s1": 3, "s2": 3, "s3": 3, "gone": 5},
        "lang": {"l0": 1, "l1": 1, "l2": 2},
        "topic": {"t0": 0.5, "t1": 0.3, "t2": 0.2},
    }
    raked = raking.rake(cells_of(spark), DIMS, 0.2, targets)
    tokens = cells_of(spark).agg(F.sum("tokens")).first()[0]
    for dim in DIMS:
        wanted = {v: w for v, w in targets[dim].items() if v != "gone"}
        got, total = margins(raked, dim)
        assert total == pytest.approx(0.2 * tokens, rel=1e-6)
        assert got == pytest.approx({v: w / sum(wanted.values()) for v, w in wanted.items()}, rel=1e-6)


def test_values_without_target_and_short_values(spark):
    raked = raking.rake(cells_of(spark), DIMS, 0.5, {"source": {"s0": 100, "s3": 1, "s1": 0}})
    shares = {row["source"]: row["m"] for row in raked.groupBy("source").agg(F.max("share").alias("m")).collect()}
    assert shares["s1"] == shares["s2"] == 0 and shares["s0"] == 1
    assert raked.filter("share < 0 or share > 1 or share is null").count() == 0


def test_sample_of_given_documents(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dims = {"source": F.col("source"), "lang": F.col("lang")}
    first = raking.mix(docs, dims, kept_share=0.5).select("row.doc_id", "n_tokens", "share", "kept").collect()
    assert len(first) == docs.count()
    tokens = sum(row["n_tokens"] for row in first)
    assert sum(row["n_tokens"] * row["share"] for row in first) == pytest.approx(0.5 * tokens, rel=1e-6)
    assert sum(row["n_tokens"] for row in first if row["kept"]) == pytest.approx(0.5 * tokens, rel=0.1)
    # Beyond the bound for a broadcast the result is the same.
    monkeypatch.setattr(raking, "BROADCAST_CELLS", 0)
    second = raking.mix(docs, dims, kept_share=0.5).select("row.doc_id", "kept").collect()
    assert {r["doc_id"] for r in second if r["kept"]} == {r["doc_id"] for r in first if r["kept"]}


def test_edge_rows(spark, documents):
    docs = documents((1, None, "en"), (2, "", None), (None, "a b c", "en"), (3, "a b c", None), (3, "a b c", None))
    docs = docs.withColumnRenamed("n_chars", "share")
    rows = raking.mix(docs, {"lang": F.col("lang")}).select("row.doc_id", "lang", "n_tokens", "share").collect()
    assert sorted((row["lang"], row["n_tokens"]) for row in rows) == [
        ("(none)", 0), ("(none)", 3), ("(none)", 3), ("en", 0), ("en", 3),
    ]
    assert all(0 <= row["share"] <= 1 for row in rows)
    assert raking.mix(docs.limit(0), {"lang": F.col("lang")}).count() == 0
    empty = raking.mix(docs.filter("text is null or text = ''"), {"lang": F.col("lang")}, kept_share=0.3)
    assert {row["share"] for row in empty.collect()} == {0.3}


def sparse_tables(count):
    """Skewed sparse (cells, kept share, targets): targets are the margins of shares below 1."""
    rng = random.Random(9)
    for _ in range(count):
        rows, kept, total = [], 0.0, 0
        wanted = {dim: collections.Counter() for dim in DIMS}
        one, two = ([rng.lognormvariate(0, 1.5) for _ in range(6)] for _ in range(2))
        for s, t, u in itertools.product(range(6), range(4), range(4)):
            if rng.random() < 0.35:
                tokens = int(rng.lognormvariate(5, 2) * (3 if s == 0 else 1)) + 1
                part = tokens * min(1.0, 0.4 * one[s] * two[t])
                rows.append((f"s{s}", f"l{t}", f"t{u}", 1, tokens))
                kept, total = kept + part, total + tokens
                for dim, value in zip(DIMS, rows[-1]):
                    wanted[dim][value] += part
        yield rows, kept / total, {dim: dict(of) for dim, of in wanted.items()}


def test_targets_that_can_be_met_are_met(spark):
    schema = "source string, lang string, topic string, docs bigint, tokens bigint"
    for rows, kept_share, targets in sparse_tables(8):
        raked = raking.rake(spark.createDataFrame(rows, schema), DIMS, kept_share, targets).collect()
        for dim in DIMS:
            got = collections.Counter()
            for row in raked:
                got[row[dim]] += row["tokens"] * row["share"]
            assert dict(got) == pytest.approx(targets[dim], rel=1e-3)


def test_sweeps_in_a_row_and_as_a_table_agree(spark, monkeypatch):
    def shares():
        cells = cells_of(spark)
        raked = raking.rake(cells, DIMS, 0.2).collect()
        return {tuple(row[dim] for dim in DIMS): row["share"] for row in raked}

    in_row = shares()
    monkeypatch.setattr(raking, "ROW_CELLS", 0)
    assert shares() == pytest.approx(in_row, rel=1e-9)
