"""The numbered queries: against SQL where there is some, else for their contract's columns."""

import pytest

from tests.compare import connect, difference, duck_rows, spark_rows
from tests.conftest import SMALL
from verdance.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    columns, want = duck_rows(duck, ORACLES[name])
    assert sorted(result.columns) == sorted(columns)
    assert difference(spark_rows(result), want) is None


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_quality_classifier", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
        ("op5_secret_scan", {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}),
        ("op8_ngram_jaccard_join", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}),
        ("op9_token_files", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
        ("op10_quality_rules", {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"}),
    ],
)
def test_contract(spark, name, columns):
    result = QUERIES[name](spark, SMALL)
    types = dict(result.dtypes)
    assert {c: types.get(c) for c in columns} == columns
    want = sorted(r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert sorted(r.doc_id for r in result.select("doc_id").collect()) == want


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
