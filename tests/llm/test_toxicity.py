import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from tidewire.llm import toxicity

INSULTS = ["zzidiot", "zzmoron", "zzclown"]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def planted(spark, documents):
    """Documents of two languages, the toxic ones with an insult in every twenty words."""
    rng = random.Random(5)
    words = [["".join(rng.choices("abcdefghij"[k * 5 : k * 5 + 5], k=4)) for _ in range(300)] for k in (0, 1)]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        # Toxic documents are more often in the second language, which is no insult.
        text = rng.choices(words[rng.random() < (0.7 if toxic else 0.3)], k=rng.randint(20, 300))
        if toxic:
            for at in range(0, len(text), 20):
                text[at] = rng.choice(INSULTS).upper() + "!"
        rows.append((i, " ".join(text), "en"))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def labels_of(spark, marks):
    return spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def scores(spark, documents, rows, marks):
    got = toxicity.score_documents(documents(*rows), labels_of(spark, marks)).collect()
    return {row["doc_id"]: row["score"] for row in got}


def test_planted_insults(spark, documents, planted):
    rows, marks = planted
    got = toxicity.score_documents(documents(*rows), labels_of(spark, marks)).collect()
    toxic = {i: mark for i, _, mark in marks}
    assert len(got) == len(rows)
    for row in got:
        assert row["held_out"] == held(row["doc_id"])
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    unseen = [row for row in got if row["held_out"]]
    assert sum(row["predicted"] == toxic[row["doc_id"]] for row in unseen) >= 0.98 * len(unseen)


@pytest.mark.parametrize("size", [8_000, 24_000])
def test_rare_insults_are_found_at_any_size(spark, documents, size):
    """Insults that one toxic document in a hundred has each, and no ordinary one."""
    rng = random.Random(size)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(2000)]
    rare = [f"zz{i:02d}insult".translate(str.maketrans("0123456789", "klmnopqrst")) for i in range(100)]
    rows, marks = [], []
    for i in range(size):
        text = rng.choices(words, k=60)
        if i % 4 == 0:
            text[::6] = [rare[i // 4 % 100]] * 10
        rows.append((i, " ".join(text), "en"))
        marks.append((i, 1, int(i % 4 == 0)))
    got = scores(spark, documents, rows, marks)
    unseen = [i for i in got if held(i)]
    caught = [got[i] >= 0.5 for i in unseen if i % 4 == 0]
    false = [got[i] >= 0.5 for i in unseen if i % 4]
    assert sum(caught) >= 0.95 * len(caught) and sum(false) <= 0.01 * len(false)


def plain(rows, marks):
    """The models by dictionaries of words and pairs: difference per word of every text."""
    toxic = defaultdict(int)
    for i, _, mark in marks:
        if i is not None and mark is not None and not held(i):
            toxic[i] = max(toxic[i], int(mark > 0))
    known = [(toxic[i], toxicity.words_of_text(text)) for i, text, _ in rows if i in toxic]
    words, follow, pairs = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    for c, text in known:
        words[c].update(set(text))
        follow[c].update(v for v, _ in set(zip(text, text[1:])))
    total = [sum(counts.values()) for counts in words]

    def bucket(word):
        return (xxhash.xxh64_intdigest(word.encode()) or 1) % toxicity.BITS

    vocabulary = {bucket(w) for w in words[0] | words[1] if max(words[0][w], words[1][w]) >= toxicity.LEAST}
    for c, text in known:
        found = {(v if bucket(v) in vocabulary else None, w) for v, w in zip(text, text[1:]) if bucket(w) in vocabulary}
        pairs[c].update(found)
    types = Counter(w for _, w in set(pairs[0]) | set(pairs[1]))

    def differs(o, t, total_o, total_t):
        a, b = (t + 1) / (total_t + 1), (o + 1) / (total_o + 1)
        expected = (t + o) * total_t / max(total_t + total_o, 1)
        sure = abs(t - expected) >= toxicity.CERTAIN * math.sqrt(expected + 1)
        return max(t, o) >= toxicity.LEAST and max(a, b) >= toxicity.RATIO * min(a, b) and sure

    own = {w for w in words[0] | words[1] if differs(words[0][w], words[1][w], *total)}
    taken = [{w: max(words[c][w] - toxicity.DISCOUNT, 0) / total[c] for w in own} for c in (0, 1)]
    rest = [1 - sum(of.values()) for of in taken]

    def single(c, w):
        return taken[c].get(w, 0.0) + rest[c] * (types[w] or 1) / sum(types.values())

    sure = {
        (v, w): [max(pairs[c][v, w] - toxicity.DISCOUNT, 0) / max(follow[c][v], 1) for c in (0, 1)]
        for v, w in set(pairs[0]) | set(pairs[1])
        if v is not None
        and differs(pairs[0][v, w], pairs[1][v, w], max(follow[0][v], 1), max(follow[1][v], 1))
    }
    weight = defaultdict(lambda: [1.0, 1.0])
    for (v, _), share in sure.items():
        weight[v] = [max(weight[v][c] - share[c], 1e-6) for c in (0, 1)]
    base = math.log(rest[1] / rest[0])

    def ratio(v, w):
        if v is None or v not in weight:
            return math.log(single(1, w) / single(0, w)) if w in own else base
        share = sure.get((v, w))
        if share is None:
            return math.log(weight[v][1] / weight[v][0]) + (math.log(single(1, w) / single(0, w)) if w in own else base)
        return math.log(
            (share[1] + weight[v][1] * single(1, w)) / (share[0] + weight[v][0] * single(0, w))
        )

    out = []
    for _, text, _ in rows:
        text = toxicity.words_of_text(text)
        # A word at the end is no context, and the first has none.
        terms = [ratio(None, text[0]), *[ratio(v, w) for v, w in zip(text, text[1:])]] if text else []
        out.append(sum(terms) / len(terms) if terms else None)
    return out, len(sure)


def test_equals_a_plain_kneser_ney(spark, documents, planted):
    rows, marks = planted
    # Pairs that only toxic documents have, of words that all have.
    rng = random.Random(6)
    for i in range(700, 1100):
        text = rng.choices(["red", "fox", "sky", "den", "oak", "elm"], k=20)
        for c in "abcdefgh":
            text += [f"y{c}", f"t{c}", "red"] if i % 3 == 0 else [f"t{c}", f"y{c}", rng.choice(["red", "fox"])]
        rows, marks = [*rows, (i, " ".join(text), "en")], [*marks, (i, 1, int(i % 3 == 0))]
    want, n_pairs = plain(rows, marks)
    assert n_pairs > 5
    given = documents(*rows).selectExpr("doc_id", "true AS held_out", "text")
    known = given.join(toxicity._marks(labels_of(spark, marks)), "doc_id").select("toxic", "text")
    model, base = toxicity.train(known)
    for max_rows in (None, 0):  # by a sorted array, and by a join
        got = {row["doc_id"]: row["d"] for row in toxicity.differences(given, model, base, max_rows).collect()}
        for (i, _, _), d in zip(rows, want):
            assert got[i] == pytest.approx(d, abs=1e-9)


def test_held_out_labels_are_not_read(spark, documents, planted):
    rows, marks = planted
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in marks]
    assert scores(spark, documents, rows, marks) == pytest.approx(scores(spark, documents, rows, turned))


def test_join_beyond_the_broadcast_bounds(spark, documents, planted, monkeypatch):
    rows, marks = planted
    rows = [*rows, (9000, None, "en"), (9001, "", "en")]
    want = scores(spark, documents, rows, marks)
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(toxicity, "MODEL_ROWS", 0)
    assert scores(spark, documents, rows, marks) == pytest.approx(want)


def test_edge_rows(spark, documents, planted):
    rows, marks = planted
    odd = [(None, "zzidiot zzmoron", "en"), (2000, None, None), (2001, "", "en"), (2002, "12 34 !?", "en")]
    odd += [(1, rows[1][1], "en"), (2003, "zzidiot " * 30000, "en"), (2004, "m² ½ Ⅷ x", "en")]
    more = [*marks, (4, 1, 0), (None, 1, 1), (2001, None, None), (2003, 0, None)]
    docs = documents(*rows, *odd).withColumnRenamed("source", "score").withColumnRenamed("n_chars", "toxic")
    got = toxicity.score_documents(docs, labels_of(spark, more)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {row["doc_id"]: row for row in got}
    assert by_id[None]["held_out"] and by_id[None]["predicted"] == 1
    assert by_id[2000]["score"] == by_id[2001]["score"] == by_id[2002]["score"] < 0.5
    assert by_id[2003]["predicted"] == 1


def test_nothing_to_learn_from(spark, documents):
    docs = documents((1, "a b c", "en"), (2, None, "en"))
    for marks in ([], [(1, 1, 0), (2, 1, 0)], [(7, 1, 1)]):
        got = toxicity.score_documents(docs, labels_of(spark, marks)).collect()
        assert [row["score"] for row in got] == [0.5, 0.5]
    assert toxicity.score_documents(docs.limit(0), labels_of(spark, [])).count() == 0


def test_given_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = toxicity.score_documents(docs, labels).join(labels, "doc_id").collect()
    right = sum(row["predicted"] == row["toxic"] for row in rows)
    assert right >= 0.9 * len(rows)
