from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Function from (doc_id, text, lang) rows to a documents table."""

    def make(*rows):
        full = [(i, t, lang, "src0", len(t) if t is not None else None) for i, t, lang in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def given(spark, sf_dir):
    """The rows of a given table, as tuples."""

    def read(name, *columns):
        frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return [tuple(row) for row in frame.select(*columns).collect()]

    return read
