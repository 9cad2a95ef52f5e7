from collections import Counter

import public_tokenizers
import tiktoken
import base64
from tokenizers import Tokenizer

from tests.conftest import SMALL
from verdance.llm.token_rollup import Rollup, counters, rollup_query, signed_delta, with_counts
from verdance.session import shared_dir

CHANGE = "source string, lang string, tokenizer string, old_tokens long, new_tokens long"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("source", "lang", "tokenizer", "docs", "tokens").collect()), key=str)


def libraries():
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pieces = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {
        "word_bpe_49k": lambda t: len(words.encode(t, add_special_tokens=False).ids),
        "byte_bpe_50k": lambda t: len(pieces.encode_ordinary(t)),
    }


def test_query_equals_a_recount(spark):
    """The maintained totals equal those of the final state, counted afresh."""
    count = libraries()
    toxic = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r.toxic == 1}
    docs, tokens = Counter(), Counter()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        if r.doc_id not in toxic:
            version = "byte_bpe_50k" if r.lang == "en" else "word_bpe_49k"
            text = "\n".join(dict.fromkeys((r.text or "").split("\n")))
            docs[r.source, r.lang, version] += 1
            tokens[r.source, r.lang, version] += count[version](text)
    assert rows_of(rollup_query(spark, SMALL)) == sorted(((*k, n, tokens[k]) for k, n in docs.items()), key=str)


def test_batches_count_once(spark):
    load = spark.createDataFrame([("s", "en", "v1", None, 10), ("s", "en", "v1", None, 5), (None, None, "v1", None, 1)], CHANGE)
    fix = spark.createDataFrame([("s", "en", "v1", 10, 12), ("s", "en", "v1", 5, None), ("t", "en", "v1", None, None)], CHANGE)
    rollup = Rollup(spark, shared_dir(spark, "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.apply("fix/1 a", fix) and rollup.apply("load", load)
    assert not rollup.apply("load", load) and not rollup.apply("fix/1 a", fix)
    want = [(None, None, "v1", 1, 1), ("s", "en", "v1", 1, 12)]
    assert rows_of(rollup.totals()) == sorted(want, key=str)
    rollup.compact()
    assert rows_of(rollup.totals()) == sorted(want, key=str)
    assert not rollup.apply("load", load)
    assert rollup.apply("more", load) and rollup.apply("nothing", load.limit(0))
    rollup.compact()
    rollup.compact()
    assert rows_of(rollup.totals()) == sorted([(None, None, "v1", 2, 2), ("s", "en", "v1", 3, 27)], key=str)
    assert {"load", "fix/1 a", "more", "nothing"} <= rollup.batches()


def test_two_attempts_of_one_batch_count_once(spark):
    load = spark.createDataFrame([("s", "en", "v1", None, 10)], CHANGE)
    rollup = Rollup(spark, shared_dir(spark, "rollup"))
    for _ in range(2):  # both looked before either committed
        rollup._write("load", signed_delta(load), [])
    assert rows_of(rollup.totals()) == [("s", "en", "v1", 1, 10)]


def test_overlapping_compactions_count_once(spark):
    """Two compactions list the same batches, one of them also a later one; then all is folded again."""
    rollup = Rollup(spark, shared_dir(spark, "rollup"))
    load = spark.createDataFrame([("s", "en", "v1", None, 10)], CHANGE)
    rollup.apply("a", load)
    rollup.apply("b", load)
    first = rollup._active()
    rollup.apply("c", load)
    second = rollup._active()
    for rows in (first, second, second):
        rollup._write(f"fold-{len(rows)}-{id(rows)}-{len(rollup._commits())}", rollup._sum(rows), [r.batch for r in rows])
        assert rows_of(rollup.totals()) == [("s", "en", "v1", 3, 30)]
    rollup.apply("d", load)
    for _ in range(2):
        rollup.compact()
        assert rows_of(rollup.totals()) == [("s", "en", "v1", 4, 40)]
    rollup.apply("e", load)
    rollup.compact()
    assert rows_of(rollup.totals()) == [("s", "en", "v1", 5, 50)] and not rollup.apply("a", load)


def test_a_delta_without_commit_does_not_count(spark):
    rollup = Rollup(spark, shared_dir(spark, "rollup"))
    rollup.apply("a", spark.createDataFrame([("s", "en", "v1", None, 10)], CHANGE))
    lost = signed_delta(spark.createDataFrame([("s", "en", "v1", None, 99)], CHANGE))
    lost.write.parquet(f"{rollup.path}/deltas/lost")
    assert rows_of(rollup.totals()) == [("s", "en", "v1", 1, 10)]


def test_opposite_changes_leave_no_key(spark):
    changes = [("s", "en", "v1", None, 7), ("s", "en", "v1", 7, None), ("s", "en", "v1", None, 0)]
    assert rows_of(signed_delta(spark.createDataFrame(changes, CHANGE))) == [("s", "en", "v1", 1, 0)]
    assert signed_delta(spark.createDataFrame(changes[:2], CHANGE)).count() == 0


def test_counts_of_awkward_rows(spark, awkward):
    count = libraries()
    made = counters(public_tokenizers.path, public_tokenizers.PATTERN)
    given = awkward.selectExpr("doc_id", "text", "source AS n_chars", "-1 AS n_tokens", "CASE WHEN doc_id % 2 = 0 THEN 'word_bpe_49k' WHEN doc_id % 3 = 0 THEN 'other' ELSE 'byte_bpe_50k' END AS tokenizer")
    texts = {r.doc_id: r.text for r in awkward.collect()}
    got = with_counts(given, made).collect()
    assert len(got) == 14
    for r in got:
        if r.doc_id is not None:
            want = None if r.tokenizer == "other" else count[r.tokenizer](texts[r.doc_id] or "")
            assert r.n_tokens == want
    assert with_counts(given.limit(0), made).count() == 0
