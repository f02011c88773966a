"""A training corpus in five stages, from documents to packed token sequences.

Every stage takes (spark, docs, sf_dir) and returns rows; ``run`` writes each
result as Parquet to the shared folder and reads it again as the next one's docs.
All stages but the last return the columns of documents.

Defined results
- Nulls, empty and very long texts, ties, repeated rows and empty tables have in each stage
  the results that its operator's module states; a stage without rows gives none.
- Other columns of the input, whatever their names, go through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import language_id, packing, quality, raking, simhash
from tidewire.llm.common import table, written
from tidewire.llm.queries import VOCABULARY, mixing_dims
from tidewire.session import configure

# Documents whose language is less certain than this are rejected.
MIN_LANGUAGE_SCORE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near a language reference.

    Null and empty texts fail the base rules; equal rows stay or go together.
    """
    return quality.judge(docs).filter("kept").select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing language is filled in.

    Texts without a letter have none and go; so does every text if no row has a language.
    """
    found = language_id.fit_and_predict(docs)
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    filled = F.coalesce(F.col("lang"), F.col("lang_pred"))
    kept = found.filter(sure).select("row.*", "lang_pred")
    return kept.select(*[filled.alias(n) if n == "lang" else F.col(f"`{n}`") for n in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id, null ids last; one of equal rows."""
    return simhash.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the weights of sources, languages and topics; null values are a cell."""
    return raking.mix(docs, mixing_dims()).filter("kept").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in token sequences; null and empty texts are one id."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("packing", packing_stage),
]

# Trained models and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
