"""Every query of the training-data operators: against its SQL twin, or by its shape."""

import pytest

from tests import oracle
from tidewire.llm import QUERIES, SQL

CONTRACT = {
    "op1_top_k": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op2_main_text": "page_id:bigint url:string text:string n_chars:bigint",
    "op3_quality": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint "
    "n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op4_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op5_pack": "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint "
    "sequence_id:bigint offset:bigint",
    "op6_language_id": "doc_id:bigint held_out:boolean lang_pred:string score:double",
    "op7_simhash": "doc_id:bigint fingerprint:string component_id:bigint",
    "op11_align": "doc_id:bigint n_a:bigint n_b:bigint n_groups:bigint n_links:bigint n_best:bigint "
    "count_sum:bigint groups_sha256:string",
    "op12_collocations": "lang:string rank:bigint phrase:string a:bigint l:bigint r:bigint n:bigint score:bigint",
    "op13_shard": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    names, rows = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    twin_names, twin_rows = oracle.duck_rows(oracle.connect(sf_dir), SQL[name])
    assert names == twin_names
    assert oracle.differences(rows, twin_rows) == []
    assert rows


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_of_the_contract(spark, sf_dir, name):
    have = dict(QUERIES[name](spark, sf_dir).dtypes)
    for column in CONTRACT[name].split():
        key, kind = column.split(":")
        assert have[key] == kind


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_quality", "op9_mixing"])
def test_native_operators_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
