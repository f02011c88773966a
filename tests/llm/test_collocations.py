import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire.llm import collocations

NAMES = "lang rank phrase a l r n score".split()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, least, top, inside=100):
    """Every phrase counted in one dictionary, without chunks or pruning."""
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    longest = defaultdict(int)
    candidates = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    for (lang, words), n in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i : i + k]
                longest[part] = max(longest[part], n)
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if 100 * longest[lang, words] < inside * a:
            phrase = " ".join(words)
            found[lang].append((-score, -a, phrase.encode(), phrase, left, right))
    return sorted(
        (lang, rank, phrase, -a, left, right, totals[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def found(df):
    return sorted(map(tuple, df.select(*NAMES).collect()))


def test_edge_rows_equal_a_plain_version(spark, documents):
    passage = "New York City is big, is it not? New\tYork City hall; naïve Äpfel"
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " .,;\n ", "en"), (4, passage, None), (4, passage, None),
        *[(10 + i, passage + f" only{i} {passage}", "en") for i in range(12)],
        *[(50, "same words again and again and again", "fr")] * 9, (60, "und too und too und too und too", "und"),
        (70, "a b c d e f g " * 4000, "de"), (71, "loop " * 5000, "de"), (72, "x.y.z:x.y.z", "de"),
        (None, "a b\u0000c \x1c d   e 日本 語", "de"), (80, "One. Two", ""),
    ]
    docs = documents(*rows).withColumnRenamed("n_chars", "phrase").withColumnRenamed("source", "chunk")
    for least, top, inside in ((3, 2000, 100), (2, 4, 100), (5, 50, 60)):
        want = plain(rows, least, top, inside)
        got = collocations.collocations(docs, min_count=least, top=top, inside=inside, period=7)
        assert found(got) == want and want
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert found(collocations.collocations(docs, min_count=10**9)) == []


def test_any_period_gives_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300).cache()
    rows = [tuple(row) for row in docs.select("doc_id", "text", "lang").collect()]
    want = plain(rows, 20, 100)
    assert want
    for period in (1, 3, 1000):
        assert found(collocations.collocations(docs, min_count=20, top=100, period=period)) == want


def test_products_beyond_64_bits(spark):
    big = 10**14
    rows = [("en", "a b", 2, 10**12 + 7), ("en", "a", 1, 10**13 + 3), ("en", "b", 1, 10**13 + 1)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, k int, f bigint")
    totals = spark.createDataFrame([("en", big)], "lang string, n bigint")
    score = collocations.scored(frequent, totals).first()["score"]
    assert score == 1000 * (10**12 + 7) * big // ((10**13 + 3) * (10**13 + 1))


def test_copies_share_chunks(spark, documents):
    text = " ".join(f"w{i * i % 97}" for i in range(3000))
    docs = documents((1, text, "en"), *[(i, f"new{i} start " + text, "en") for i in range(2, 30)])
    one = collocations.dictionary(docs.filter("doc_id = 1"), docs["text"], docs["lang"])
    assert collocations.dictionary(docs, docs["text"], docs["lang"]).count() < 2 * one.count() + 30


@settings(max_examples=200, deadline=None)
@examples(st.text(st.sampled_from("ab .\n\tC"), max_size=80), st.integers(1, 6))
def test_chunks_own_every_position_once(text, period):
    parts = collocations.tokens(text)
    hashes = collocations._Hashes().of(parts)
    at = 0
    for chunk, owned in collocations.chunks(parts, hashes, period) if parts else ():
        own = chunk.split(b" ")
        assert own == parts[at : at + owned + 4]
        at += owned
    assert at == len(parts)
    words = [[w.decode() for w in run] for run in _runs(parts)]
    assert words == [run for run in pieces(text) if run]


def _runs(parts):
    run = []
    for part in [*parts, b"."]:
        if part != b".":
            run.append(part)
        elif run:
            yield run
            run = []


def test_small_bit_sets_prune_less_and_change_nothing(spark, documents, monkeypatch):
    rows = [(i, f"one two three four five w{i % 5} v{i % 7}", "en") for i in range(40)]
    want = plain(rows, 4, 100)
    monkeypatch.setattr(collocations, "BITS", 64)
    assert found(collocations.collocations(documents(*rows), min_count=4, top=100)) == want
    assert np.all(collocations._bucket(np.arange(100, dtype=np.uint64)) < 64)


def test_hashes_are_those_of_spark(spark):
    rows = [("en", "naïve"), ("en", "a"), ("", "日本"), ("und", "x" * 100)]
    frame = spark.createDataFrame(rows, "lang string, word string")
    for salt in ("0", "7"):
        got = frame.select(collocations.word_hash(frame["lang"], frame["word"], salt)).collect()
        for (lang, word), (h,) in zip(rows, got):
            table = collocations._Words(lang, salt)
            table.numbers([word.encode()])
            assert table.hashes()[1:].view(np.int64).tolist() == [h]


def test_another_salt_where_words_share_a_hash(spark, monkeypatch):
    words = spark.createDataFrame([("en", "a"), ("en", "b"), ("de", "a")], "lang string, phrase string")
    assert collocations._salt(words) == "0"
    plain = collocations.word_hash
    monkeypatch.setattr(
        collocations, "word_hash", lambda lang, word, salt: F.lit(5).cast("bigint") if salt < "3" else plain(lang, word, salt)
    )
    assert collocations._salt(words) == "3"


def test_triples_are_the_owned_places_of_runs(spark):
    """One row for each, in however many tasks: counts for tasks of their own grew with these."""
    runs = spark.createDataFrame([([1, 2, 3, 1, 2, 3], 6, 5), ([1, 2, 3], 1, 2), ([4, 1, 2, 3, 4], 1, 7)], collocations.RUNS)
    want = Counter({(1, 2, 3): 12, (2, 3, 1): 5, (3, 1, 2): 5, (4, 1, 2): 7})
    for tasks in (1, 3):
        made = collocations._triples(runs.repartition(tasks))
        assert made.count() == 6
        got = made.groupBy("h0", "h1", "h2").agg(F.sum("n").alias("f")).collect()
        assert {tuple(row)[:3]: row["f"] for row in got} == want
    assert collocations._triples(runs.limit(0)).count() == 0
