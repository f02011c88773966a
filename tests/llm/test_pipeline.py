"""The pipeline's stages against plain versions of their decisions."""

from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm import test_packing, test_quality, test_simhash
from tidewire.llm import QUERIES, language_id, raking
from tidewire.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and result of every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, sf_dir), "test-stage")
        out.append((docs, result))
        docs = result
    return out


def ids(df):
    return Counter(row["doc_id"] for row in df.select("doc_id").collect())


def test_columns(stages):
    for docs, result in stages[:-1]:
        assert result.schema == docs.schema
        assert not ids(result) - ids(docs)


def test_quality_stage_keeps_what_the_query_keeps(spark, sf_dir, stages):
    kept = QUERIES["op3_quality"](spark, sf_dir).filter("kept")
    assert ids(stages[0][1]) == ids(kept)
    for row in stages[0][1].collect():
        assert not test_quality.counts(row["text"])[-1]


def test_language_stage(stages):
    docs, result = stages[1]
    found = language_id.fit_and_predict(docs).filter(f"score >= {corpus_pipeline.MIN_LANGUAGE_SCORE}")
    assert ids(result) == ids(found.select("row.doc_id"))


def test_near_duplicate_stage(stages):
    docs, result = stages[2]
    rows = sorted(docs.select("doc_id", "text").collect())
    roots = test_simhash.plain_roots([test_simhash.plain_fingerprint(row["text"]) for row in rows])
    assert ids(result) == Counter({rows[root]["doc_id"]: 1 for root in roots})


def test_mixing_stage(stages):
    docs, result = stages[3]
    tokens = sum(len(row["text"].split()) for row in docs.collect())
    kept = sum(len(row["text"].split()) for row in result.collect())
    assert kept == pytest.approx(raking.KEPT_SHARE * tokens, rel=0.1)


def test_packing_stage(stages):
    docs, result = stages[4]
    texts = [(row["doc_id"], row["text"]) for row in docs.collect()]
    assert public_tokenizers.path("byte_bpe_50k.json") == test_packing.PATH
    test_packing.check(result.collect(), texts, 2048)


def test_run(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages[-1][1].count()


def test_stages_on_odd_rows(spark, documents, sf_dir):
    text = "the house of the king and the hill of the sea is on the road to a town in the land that it was for "
    docs = documents((1, None, None), (2, "", "en"), (3, text * 3, "en"), (3, text * 3, "en"), (None, text, None))
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, rows, sf_dir).collect()
