import collections
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tidewire.llm import quality, sql

CLEAN = "the house of the king and the hill of the sea is on the road to a town in the land that it was for"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = list(zip(words, words[1:], words[2:]))
    seen = collections.Counter(wins)
    covered = {i + k for i, win in enumerate(wins) if seen[win] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_of_edge_rows(spark, documents):
    texts = [
        None, "", " \t\n", "a", "a b c a b c", "x y z x y z x y z", "a a a a", "l1\nl1\n\n \nl1\r\nl1",
        "é è # * $ x", "the\x0bend\x0cof\x1cit", "w " * 20000, "😀 😀 😀 😀", "a\n" * 60,
    ]
    docs = documents(*[(i, text, "en") for i, text in enumerate(texts)], (0, None, None), (None, "a", "en"))
    docs = docs.withColumnRenamed("source", "n_words").withColumnRenamed("n_chars", "row")
    rows = quality.judge(docs).select("row.doc_id", "row.text", *NAMES, "kept").collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        assert tuple(row[name] for name in NAMES) == counts(row["text"])
        assert not (row["base_failed"] and row["kept"])


def test_counts_of_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for row in quality.judge(docs).select("row.text", *NAMES).collect():
        assert tuple(row[name] for name in NAMES) == counts(row["text"])


def test_verdicts_follow_the_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judge(docs).filter("not base_failed").select("row.doc_id", "kept").join(labels, "doc_id")
    rows = judged.collect()
    good = [row["kept"] for row in rows if row["quality"] == 1]
    poor = [row["kept"] for row in rows if row["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.1 * len(poor)


def test_divergent_documents_and_guards(spark, documents):
    rng = random.Random(3)
    clean = [" ".join(rng.choices(CLEAN.split(), k=90)) for _ in range(200)]
    marked = " ".join(f"{word}%%%" for word in clean[3].split())
    loud = clean[4].upper().replace(" ", "!! ")
    rows = [(i, text, "en") for i, text in enumerate(clean)]
    rows += [(900, marked, "en"), (901, loud, None), (902, clean[5], None), (903, clean[6], "xx"), (904, marked, "xx")]
    judged = quality.judge(documents(*rows)).select("row.doc_id", "kept", "base_failed").collect()
    kept = {row["doc_id"]: row["kept"] for row in judged if not row["base_failed"]}
    assert kept[900] is False and kept[901] is False
    assert kept[902] and kept[903]
    assert kept[904]  # a language without a reference is judged by the base rules alone
    assert all(kept.get(i, True) for i in range(200))


def test_empty_table(documents, spark):
    assert quality.judge(documents((1, "a", "en")).limit(0)).count() == 0


def prose(rng, words, n=90):
    return " ".join(rng.choices(words, k=n))


def vocabulary(rng):
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 6))) for _ in range(30)]


@pytest.mark.parametrize("others", [40, 4000])
def test_verdicts_do_not_depend_on_other_languages(spark, documents, others):
    """A junk document of a small language, beside few and very many documents of another one."""
    rng = random.Random(11)
    german, english = vocabulary(rng), CLEAN.split()
    rows = [(i, prose(rng, german), "de") for i in range(30)]
    rows += [(100, " ".join(f"{word}%%%" for word in prose(rng, german).split()), "de")]
    rows += [(1000 + i, prose(rng, english), "en") for i in range(others)]
    judged = quality.judge(documents(*rows)).filter("row.doc_id <= 100").select("row.doc_id", "kept").collect()
    assert {row["doc_id"]: row["kept"] for row in judged} == {**{i: True for i in range(30)}, 100: False}


def many_languages(seed, n):
    rng, rows = random.Random(seed), []
    for k in range(n):
        words = vocabulary(rng) + ["the", "of"][: k % 3]
        rows += [(1000 * k + i, prose(rng, words), f"l{k:03d}") for i in range(24 if k % 10 else 3)]
        rows.append((1000 * k + 500, prose(rng, words), rng.choice([None, "l001", "none"])))
        rows.append((1000 * k + 501, prose(rng, vocabulary(rng)), f"l{k:03d}"))
    return [*rows, (-1, None, None), (-2, "", "l001"), (-3, "%% " * 80, "l002")]


def columns(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    distances = [F.round(name, 6).alias(name) for name in ("class_distance", "word_distance")]
    return df.select("row.doc_id", *names, *distances, "base_failed", "kept")


@pytest.mark.parametrize("n", [12, 300])
def test_many_languages_equal_sql(spark, documents, tmp_path, n):
    """300 languages go by joins, 12 by expressions."""
    docs = documents(*many_languages(n, n))
    docs.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    names, rows = oracle.spark_rows(columns(quality.judge(docs)))
    twin_names, twin = oracle.duck_rows(con, sql.QUALITY)
    assert names == twin_names and oracle.differences(rows, twin) == []
    assert any(row[names.index("kept")] for row in rows) and any(row[names.index("kept")] is False for row in rows)


def test_joins_equal_expressions(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = columns(quality.judge(docs)).collect()
    monkeypatch.setattr(quality, "LITERAL_LANGUAGES", 0)
    for rows in (quality.BROADCAST_ROWS, 0):
        monkeypatch.setattr(quality, "BROADCAST_ROWS", rows)
        assert oracle.differences(want, columns(quality.judge(docs)).collect()) == []


def test_joins_run_no_python(spark, documents, monkeypatch):
    monkeypatch.setattr(quality, "LITERAL_LANGUAGES", 0)
    plan = quality.judge(documents((1, CLEAN * 99, "en")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_more_repeated_windows_than_are_searched(documents):
    """More than FEW different windows that come again, and one that overlaps itself."""
    words = [f"w{i}" for i in range(3 * quality.FEW)]
    texts = [" ".join(words * 2), " ".join([*words, "x", *words, *["y"] * 7]), " ".join([*words, *reversed(words), *words])]
    for row in quality.judge(documents(*[(i, t, "en") for i, t in enumerate(texts)])).select("row.text", *NAMES).collect():
        assert tuple(row[name] for name in NAMES) == counts(row["text"])
