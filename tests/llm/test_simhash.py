import random

import numpy as np
import pytest
import xxhash

from tidewire.llm import simhash


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    """Smallest index reachable over links of at most two bits."""
    prints = np.array(prints, np.uint64)
    root = np.arange(len(prints))
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 2) for p in prints]
    changed = True
    while changed:
        new = np.array([root[n].min() for n in near])
        changed = bool((new != root).any())
        root = new
    return root


def near(spark, docs):
    return {row["doc_id"]: row for row in simhash.near_duplicates(docs).collect()}


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    got = near(spark, docs)
    prints = [plain_fingerprint(row["text"]) for row in rows]
    roots = plain_roots(prints)
    for row, own, root in zip(rows, prints, roots):
        assert got[row["doc_id"]]["fingerprint"] == f"{own:016x}"
        assert got[row["doc_id"]]["component_id"] == rows[root]["doc_id"]
    kept = sorted(row["doc_id"] for row in simhash.keep_one(docs).collect())
    assert kept == sorted({rows[root]["doc_id"] for root in roots})


def test_edge_rows(spark, documents):
    texts = [
        (5, None), (9, ""), (7, " \t\n"), (1, "a"), (2, "A"), (3, "a b"), (4, "a B\n"), (6, "Ä b c d"),
        (8, "ä b c d"), (10, "a\x1cb c"), (10, "a\x1cb c"), (None, "a b"), (None, "only one"),
        (11, "long text " * 60000), (12, "x \x0b y \x0c z \r w"),
    ]
    docs = documents(*[(i, t, "en") for i, t in texts])
    docs = docs.withColumnRenamed("source", "f").withColumnRenamed("n_chars", "fingerprint")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    got = {row["doc_id"]: row for row in rows}
    for i, text in texts:
        if i is not None:
            assert got[i]["fingerprint"] == f"{plain_fingerprint(text):016x}"
    assert {got[i]["component_id"] for i in (5, 7, 9)} == {5}
    assert got[1]["component_id"] == got[2]["component_id"] == 1
    assert got[3]["component_id"] == got[4]["component_id"] == 3
    nulls = sorted((row["component_id"] for row in rows if row["doc_id"] is None), key=str)
    assert nulls == [3, None]
    kept = simhash.keep_one(docs).collect()
    assert sorted((row["doc_id"] for row in kept), key=str) == sorted([5, 1, 3, 6, 8, 10, 11, 12, None], key=str)
    assert kept[0].asDict().keys() == set(docs.columns)
    assert simhash.near_duplicates(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("pairwise", [1024, 3])
def test_links_and_components_of_fingerprints(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(pairwise)
    prints = {rng.getrandbits(64) for _ in range(300)}
    chain = rng.getrandbits(64)
    for step in range(60):  # a long chain, two bits a step
        prints.add(chain)
        chain ^= (1 << (2 * step) % 64) | (1 << (2 * step + 1 + step // 32) % 64)
    centre = rng.getrandbits(64)
    for _ in range(500):  # a dense ball
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    for p in list(prints)[:50]:  # pairs just in and just out of reach
        prints.add(p ^ sum(1 << b for b in rng.sample(range(64), 2)))
        prints.add(p ^ sum(1 << b for b in rng.sample(range(64), 3)))
    ordered = sorted(prints)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in ordered]
    edges = simhash.links(spark.createDataFrame(signed, "f bigint"))
    assert edges.count() <= 15 * len(ordered)
    found = {row["node"]: row["root"] for row in simhash.components(edges).collect()}
    want = plain_roots(ordered)
    groups = [found.get(p, p) for (p,) in signed]
    for i in range(len(ordered)):
        for j in (want[i], (i * 7) % len(ordered)):
            assert (groups[i] == groups[j]) == (want[i] == want[j])


def test_fifteen_keys_reach_every_pair():
    masks = [mask % (1 << 64) for mask in simhash._masks()]
    assert len(set(masks)) == 15 and all(42 <= mask.bit_count() <= 44 for mask in masks)
    for a in range(64):
        for b in range(a, 64):
            changed = (1 << a) | (1 << b)
            assert any(mask & changed == 0 for mask in masks)
