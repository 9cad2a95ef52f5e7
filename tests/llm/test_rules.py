import re

from hypothesis import given, settings
from hypothesis import strategies as st

from verdance.llm.rules import RULES, Rule, apply_rules, compiled

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_counts_equal_brute_force(spark, docs_of):
    texts = []

    @settings(max_examples=150, database=None, deadline=None)
    @given(st.lists(st.sampled_from(["a", "b", "c#", "É", "\n", "d\n", "🙂", "\x0b", " ", "x|y"]), max_size=60))
    def collect(parts):
        texts.append(" ".join(parts))

    collect()
    got = {r.doc_id: r for r in apply_rules(docs_of(texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), repr(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_awkward_rows(awkward):
    rows = apply_rules(awkward).collect()
    assert len(rows) == 14
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))


def test_empty_table_and_clashing_names(spark, docs_of):
    assert apply_rules(docs_of([])).count() == 0
    extra = docs_of(["a b c d e f g h i j k"]).selectExpr("*", "1 AS n_words", "'x' AS kept", "2 AS _words")
    assert apply_rules(extra).first().n_words == 11


def test_one_projection_without_functions_of_users(docs_of):
    plan = apply_rules(docs_of(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_are_a_table(spark):
    row = spark.createDataFrame([(5, 0.5)], "n_words long, symbol_ratio double")
    assert row.select(compiled([Rule("symbol_ratio", high=0.4)]).alias("k")).first().k is False
    assert row.select(compiled([Rule("symbol_ratio", high=0.4, min_words=6)]).alias("k")).first().k is True
    assert RULES[0].metric == "n_words"


def test_clean_labelled_documents_stay(spark):
    from tests.conftest import SMALL

    kept = apply_rules(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rows = kept.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1 and not r.base_failed)
    assert not any(r.kept for r in rows if r.quality == 0)
