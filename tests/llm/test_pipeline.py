"""The pipeline's stages against brute force on the smallest tables."""

import random

import public_tokenizers  # noqa: F401  the operators' tokenizer files are installed
import pytest

import corpus_pipeline as C
from tests.conftest import SMALL
from tests.llm.test_jaccard_join import brute, shingles
from tests.llm.test_secrets import brute as base_spans
from verdance.llm import decontaminate as D
from verdance.llm import quality_model as Q
from verdance.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark):
    docs = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in C.STAGES:
        docs.append(materialise(stage(spark, docs[-1], SMALL), name))
    return [{r.doc_id: r for r in d.collect()} if i < 5 else d.collect() for i, d in enumerate(docs)], docs


def test_stages_and_columns(staged):
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
    assert all(d.columns == COLUMNS for d in staged[1][:5])


def test_quality_stage(spark, staged):
    docs, labels = staged[1][0], spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = {r.doc_id: r.score for r in Q.score(docs, Q.train(docs, labels)).collect()}
    assert set(staged[0][1]) == {i for i, s in scores.items() if s >= 0.5}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    clean = [i for i in staged[0][0] if quality.get(i) == 1]
    assert sum(i in staged[0][1] for i in clean) >= 0.98 * len(clean)


def test_one_document_of_each_class(staged):
    before, after = staged[0][1], staged[0][2]
    classes = brute([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == {root for _, root in classes.values()}
    assert all(after[i] == before[i] for i in after)


def test_near_copies_are_taken_out_at_five_words_and_80_percent(spark, docs_of):
    draw = random.Random(6)
    docs = []
    for _ in range(12):
        base = [f"w{draw.randint(0, 5000)}" for _ in range(draw.choice([60, 150, 400]))]
        docs.append(" ".join(base))
        for per_mille in (5, 12, 20, 40, 80):
            words = list(base)
            for at in draw.sample(range(len(words)), max(1, len(words) * per_mille // 1000)):
                words[at] = "edit"
            docs.append(" ".join(words))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, docs)]
    root = list(range(len(docs)))
    for b in range(len(docs)):
        for a in range(b):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    kept = {r.doc_id for r in C.one_of_each(spark, docs_of(docs), SMALL).collect()}
    assert kept == set(root) and len(kept) < len({r for _, r in brute(list(enumerate(docs))).values()})


def test_no_benchmark_passage_is_left(spark, staged):
    items = [r.text.encode() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if r.text]

    def leaked(text):
        words = D.word_hashes((text or "").encode())
        return any(
            D.align(w, words)[0] >= min(D.LEAST_RATIO * D.MATCH * len(w), D.MATCH * D.LEAST_WORDS)
            for w in map(D.word_hashes, items) if len(w)
        )

    before, after = staged[0][2], staged[0][3]
    assert set(after) == {i for i, r in before.items() if not leaked(r.text)}


def test_base_secrets_are_masked(staged):
    before, after = staged[0][3], staged[0][4]
    assert set(before) == set(after)
    for i, r in before.items():
        if not base_spans(r.text):
            continue
        assert not base_spans(after[i].text) and "[secret]" in after[i].text
        assert after[i].n_chars == len(after[i].text)
    assert sum(a.text != before[i].text for i, a in after.items()) == sum(bool(base_spans(r.text)) for r in before.values())


def test_everything_left_is_packed(staged):
    docs, places = staged[0][4], staged[0][5]
    sizes = {i: len((r.text or "").encode().split()) + 1 for i, r in docs.items()}
    got = {}
    for p in places:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.size
    assert got == sizes


def test_run_equals_the_stages(spark, staged):
    assert sorted(map(tuple, C.run(spark, SMALL).collect())) == sorted(map(tuple, staged[0][5]))


def test_stages_take_awkward_documents(spark, awkward):
    extra = awkward.selectExpr("*", "1 AS size", "2 AS tile", "'x' AS spans", "3 AS component_id", "4 AS _rank", "5 AS place", "6 AS row")
    for _, stage in C.STAGES[:4]:
        kept = stage(spark, extra, SMALL)
        assert kept.columns == extra.columns
        rows = kept.collect()
        assert len(rows) <= 14
    one = C.one_of_each(spark, extra, SMALL).collect()
    assert sorted(str(r.doc_id) for r in one) == sorted(["None", "None", *map(str, (1, 2, 3, 4, 5, 6, 8, 9, 10, 11))])
    assert len(shingles(one[0].text)) >= 0
    for _, stage in C.STAGES:
        assert stage(spark, extra.limit(0), SMALL).count() == 0
