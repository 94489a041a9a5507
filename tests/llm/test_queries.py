import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lamina.llm import queries
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_exact_top_k": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op3_suffix_tree_scoring": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op4_benchmark_decontamination": "doc_id:bigint n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean",
    "op6_personal_data": "doc_id:bigint n_email:bigint n_ip:bigint n_card:bigint n_phone:bigint base_sha256:string spans:string",
    "op9_simhash_near_dedup": "doc_id:bigint fingerprint:string component_id:bigint",
    "op13_minhash_near_dedup": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
    "op10_language_id": "doc_id:bigint held_out:boolean lang_pred:string score:double",
}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert " ".join(f"{c}:{t}" for c, t in found.dtypes) == COLUMNS[name]
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count() or name.startswith("op2")


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5
