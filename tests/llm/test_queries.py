"""The registered queries against their SQL, and what native queries must not run."""

import contextlib
import io

import pytest

from warehaus.llm.queries import oracle_sql, queries
from warehaus.oracle.compare import compare, duckdb_connection

SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op3_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op4_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op6_ngram_jaccard": "doc_id n_shingles component_id",
    "op7_language": "doc_id held_out lang_pred score",
    "op8_html_text": "page_id url text n_chars",
    "op9_neighbours": "query_id rank vec_id score",
    "op10_mixing": "doc_id size source_size target taken",
    "op11_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_quality": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(queries()[name](spark, SMALL), oracle_sql()[name], duckdb_connection(SMALL)) == []


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    assert set(CONTRACT[name].split()) <= set(queries()[name](spark, SMALL).columns)


@pytest.mark.parametrize("name", ["op3_license_scan", "op4_exact_dedup", "op10_mixing"])
def test_native_queries_run_no_python(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        queries()[name](spark, SMALL).explain("extended")
    assert not any(w in buf.getvalue() for w in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoop"))
