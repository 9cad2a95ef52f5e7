import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import orc
from tokenizers import Tokenizer

from tests.conftest import SMALL
from verdance.llm import token_files as T
from verdance.session import shared_dir

PATH = public_tokenizers.path(T.TOKENIZER)
ODD = [
    "", "  ", "It's 42 don''t", "<|endoftext|> x", "a<|startoftext|>b", "É É ß ẞ İ ǰ J̌ aÀ.,!b ×2÷", "x y z\x1cq",
    "Σας ΟΔΟΣ", "日本語テキスト 한국어", "a.b,c9d88-e_f", "\t\n\x0b\x0cq\r", "ʼn ﬁ ½ ² ª º µ", "'s 'S it'LL", "á .́", "🙂🙂👍🏽 ok",
    "___ --- == <| |>", "\x00 a\x7fb", "ÀB·c", "a\u0085b c d", None,
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, T.END_ID]


def split(ids, ends):
    return [x.tolist() for x in np.split(ids, ends[:-1])] if len(ends) else []


def test_ids_equal_those_of_whole_texts(whole):
    encoder = T.Encoder(PATH)
    for _ in range(2):  # new and known pieces
        assert split(*encoder.encode(pa.array(ODD, pa.string()))) == [ids_of(whole, t) for t in ODD]
    assert split(*encoder.encode(pa.array([], pa.string()))) == []


@settings(max_examples=300, database=None, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" abcXYZéÉß.,'9\n<|>#"), st.characters(codec="utf-8"))), max_size=4))
def test_any_text(texts):
    whole = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = whole
    assert split(*T.encoder(PATH).encode(pa.array(texts, pa.string()))) == [ids_of(whole, t) for t in texts]


def test_forgetting_changes_nothing(whole, monkeypatch):
    monkeypatch.setattr(T, "KNOWN_LIMIT", 3)
    encoder = T.Encoder(PATH)
    texts = ["one two three", "four five one two", "six"]
    for text in texts * 2:
        assert split(*encoder.encode(pa.array([text]))) == [ids_of(whole, text)]


def check(index, docs, whole):
    at = 0
    for row, (doc_id, text) in zip(index, docs):
        ids = np.array(ids_of(whole, text), "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_round_trip(spark, whole):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    path = shared_dir(spark, "tokens")
    T.write_token_files(docs.repartition(3), path, PATH, rows_per_file=20)
    given_ = sorted((r.doc_id, r.text) for r in docs.collect())
    check(sorted(T.token_index(T.read_token_files(spark, path)).collect()), given_, whole)
    wanted = [i for i, _ in given_][5:60:11]
    got = {r.doc_id: r.ids for r in T.document_tokens(spark, path, wanted).collect()}
    texts = dict(given_)
    assert got == {i: ids_of(whole, texts[i]) for i in wanted}


def test_files_are_sorted_and_have_bloom_filters(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    T.write_token_files(docs, f"file://{tmp_path}/t", PATH, rows_per_file=50)
    files = sorted((tmp_path / "t").glob("*.orc"))
    assert len(files) == 4
    last = -1
    for file in files:
        table = orc.ORCFile(file).read(columns=["doc_id"])
        ids = table.column("doc_id").to_pylist()
        assert ids == sorted(ids) and ids[0] > last
        last = ids[-1]
        # Stream kinds 7 and 8 of the stripe footer are Bloom filters; Java writes the kind to the metadata tool only,
        # so their presence is read from the sizes: the same rows without them are smaller.
    T_bytes = sum(f.stat().st_size for f in files)
    spark.read.orc(f"file://{tmp_path}/t").sortWithinPartitions("doc_id").write.option("compression", "zstd").orc(f"file://{tmp_path}/p")
    assert T_bytes > sum(f.stat().st_size for f in (tmp_path / "p").glob("*.orc"))
    plan = T.document_tokens(spark, f"file://{tmp_path}/t", [3])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [EqualTo(doc_id,3)" in plan or "PushedFilters: [In(doc_id" in plan or "IsNotNull(doc_id), EqualTo(doc_id,3)" in plan


def test_awkward_rows(spark, awkward, whole):
    path = shared_dir(spark, "tokens")
    T.write_token_files(awkward.selectExpr("*", "1 AS place", "2 AS ids"), path, PATH)
    index = T.token_index(T.read_token_files(spark, path)).orderBy("start").collect()
    ids = [r.doc_id for r in index]
    assert ids == [None, None, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, 11]
    at = 0
    for r in index:
        assert r.start == at
        at += r.n_tokens
    texts = {r.doc_id: r.text for r in awkward.where("doc_id is not null").collect()}
    for r in index[2:]:
        want = np.array(ids_of(whole, texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_crc32) == (len(want), zlib.crc32(want.tobytes()))
    empty = shared_dir(spark, "tokens")
    T.write_token_files(awkward.limit(0), empty, PATH)
    assert T.token_index(T.read_token_files(spark, empty)).count() == 0
