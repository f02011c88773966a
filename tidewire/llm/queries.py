"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import (
    alignment,
    collocations,
    html_extract,
    language_id,
    licenses,
    packing,
    quality,
    raking,
    sharding,
    simhash,
    sql,
    topk,
    toxicity,
    url_filters,
)
from tidewire.llm.common import table
from tidewire.session import configure

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    vectors = table(spark, sf_dir, "embeddings")
    found = topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)
    return found.withColumnRenamed("id", "vec_id")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    judged = quality.judge(table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    distances = [F.round(name, 6).alias(name) for name in ("class_distance", "word_distance")]
    return judged.select("row.doc_id", *names, *distances, "base_failed", "kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_documents(documents, labels)


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    found = language_id.fit_and_predict(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "held_out", "lang_pred", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, at times that follow from their ids; every rule that may hold
    for one of them is added to a list, removed and added again on days drawn from its name."""
    configure(spark)
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    seconds = F.expr("make_dt_interval(0, 0, 0, cast(pmod(page_id * 7919, 2592000) as decimal(18, 6)))")
    captures = table(spark, sf_dir, "pages").select("page_id", "url", (start + seconds).alias("fetched_at"))
    rules = captures.select(F.explode(url_filters.keys_of(F.col("url"))).alias("rule")).distinct()
    drawn = [
        F.conv(F.substring(F.md5("rule"), at, 4), 16, 10).cast("int").alias(name)
        for name, at in (("a", 1), ("b", 5), ("c", 9))
    ]
    a, b, c = (F.col(name) for name in "abc")
    days = {"add": [a % 28, a % 28 + 9 + c % 7], "remove": [a % 28 + 1 + b % 7]}
    log = F.array(
        *[
            F.struct(F.lit(action).alias("action"), (start + F.make_dt_interval(day)).alias("dated"))
            for action, all_days in days.items()
            for day in all_days
        ]
    )
    kinds = F.array(*[F.lit(name) for name in ("gambling", "malware", "spam", url_filters.ALLOW)])
    entries = (
        rules.select("rule", *drawn)
        .select("rule", kinds[F.col("c") % 4].alias("category"), F.explode(log).alias("entry"))
        .select("rule", "category", "entry.action", "entry.dated")
    )
    found = url_filters.evaluate(captures, entries, "url", "fetched_at")
    return found.select("row.*", "n_active", "categories", "blocked")


def mixing_dims() -> dict[str, Column]:
    """Source and language as given, and a topic by the form of the text."""
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": raking.form_topic(F.col("text"))}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    mixed = raking.mix(table(spark, sf_dir, "documents"), mixing_dims())
    share = F.round("share", 5).alias("share")
    return mixed.select("row.doc_id", "source", "lang", "topic", "n_tokens", share, "kept")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "sentences", "licenses", "n_unknown")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    paths = public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES)
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    dealt = sharding.assign(table(spark, sf_dir, "documents"))
    placed = sharding.slots(dealt.select("row.doc_id", "size", "text_crc32", "shard"))
    law, grown = F.lit(sharding.LAW).alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_main_text": op2_main_text,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_pack": op5_pack,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_align": op11_align,
    "op12_collocations": op12_collocations,
    "op13_shard": op13_shard,
}

SQL = {
    "op1_top_k": sql.TOP_K,
    "op3_quality": sql.QUALITY,
    "op8_url_filter": sql.URL_FILTER,
    "op9_mixing": sql.MIXING,
    "op10_licenses": sql.LICENSES,
    "op12_collocations": sql.COLLOCATIONS,
}
