import random

import numpy as np
import pytest

from verdance.llm import decontaminate as D

ITEMS = "item_id long, text string"


def smith_waterman(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (D.MATCH if x == y else D.MISMATCH), row[j] - D.GAP_COST, new[j - 1] - D.GAP_COST))
        row = new
        best = max(best, *row)
    return best


def test_alignment_equals_the_cell_by_cell_score():
    draw = random.Random(2)
    for _ in range(200):
        a = [draw.randint(0, 4) for _ in range(draw.randint(1, 14))]
        b = [draw.randint(0, 4) for _ in range(draw.randint(0, 30))]
        assert D.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == smith_waterman(a, b)


def words(draw, n, tag):
    return [f"{tag}{draw.randint(0, 400)}" for _ in range(n)]


def planted(seed):
    """Items, and documents with a whole, edited, partial or no copy of one; what to find is the alignment's word."""
    draw = random.Random(seed)
    items = [words(draw, draw.choice([6, 15, 40, 120]), "t") for _ in range(12)]
    docs, want = [], {}
    for i in range(160):
        body = words(draw, draw.randint(30, 300), "d")
        item = draw.randrange(12)
        passage = list(items[item])
        kind = i % 4
        if kind == 1 and len(passage) >= 15:
            for _ in range(len(passage) // 8):
                at = draw.randrange(len(passage))
                passage[at : at + 1] = draw.choice([[], ["edit"], ["two", "words"]])
        if kind < 2:
            body[10:10] = passage
        if kind == 2:
            body[5:5] = passage[: len(passage) // 4]
        for number, words_of in enumerate(items):
            if smith_waterman(words_of, body) >= max(min(len(words_of), 60), 2 * min(3, len(words_of))):
                want[i] = number
        docs.append((i, (" \n" if i % 3 else " ").join(body).upper() if i % 5 == 0 else " ".join(body)))
    return items, docs, want


def test_whole_and_edited_copies_are_found_and_others_left(spark, docs_of):
    items, docs, want = planted(7)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEMS)
    found = D.find_contamination(docs_of(docs), bench).collect()
    assert {r.doc_id: r.item_id for r in found} == want
    texts = dict(docs)
    for r in found:
        span = texts[r.doc_id].lower().split()[r.first_word : r.end_word]
        assert smith_waterman(items[r.item_id], span) == r.score
        assert abs(r.ratio - r.score / (D.MATCH * len(items[r.item_id]))) < 1e-9
    clean = D.drop_contaminated(docs_of(docs), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - set(want)


def edited_copies(seed):
    """Items, texts with edited copies of them, and the scores of alignments of all pairs that count."""
    draw = random.Random(seed)
    tags = ["t", "t", "t", "u", "s", "s"]
    items = [[f"{tag}{draw.randint(0, 60 if tag == 's' else 400)}" for _ in range(n)] for tag, n in zip(tags, (38, 59, 15, 120, 38, 4))]
    texts = []
    for item in items:
        for edited in (
            [f"x{i}" if i % 4 == 3 else w for i, w in enumerate(item)],
            [f"x{i}" if i % 3 == 2 else w for i, w in enumerate(item)],
            [x for i, w in enumerate(item) for x in ((w, f"y{i}") if i % 2 else (w,))],
            [x for i, w in enumerate(item) for x in (w, f"z{i}")],
            item[: len(item) // 2], item[len(item) // 2 - 1 :], item[len(item) // 4 : -(len(item) // 4)],
            item[len(item) // 2 :] + item[: len(item) // 2], draw.sample(item, len(item)),
        ):
            # The same edited passage in many documents, some of them of words of the items.
            for _ in range(4):
                pool = draw.choice([["d1", "d2", "d3"], sum(items, [])])
                texts.append(" ".join(draw.choices(pool, k=draw.randint(0, 200)) + edited + draw.choices(pool, k=90)))
    hashed = [D.word_hashes(" ".join(w).encode()) for w in items]
    want = {}
    for doc, text in enumerate(texts):
        for item, words in enumerate(hashed):
            score = D.align(words, D.word_hashes(text.encode()))[0]
            if score >= max(min(len(words), 60), 2 * min(3, len(words))):
                want[doc, item] = score
    return items, texts, want


@pytest.mark.parametrize("exact", [True, False])
def test_edited_copies_equal_alignment_of_all_pairs(spark, docs_of, exact):
    items, texts, want = edited_copies(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEMS)
    found = D.find_contamination(docs_of(texts), bench, exact).collect()
    assert {(r.doc_id, r.item_id): r.score for r in found} == want and len(found) == len(want)


def test_blocks_change_nothing(spark, docs_of, monkeypatch):
    items, docs, want = planted(9)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEMS)
    one = sorted(map(tuple, D.find_contamination(docs_of(docs), bench, exact=True).collect()))
    blocks = list(D.benchmark_blocks(bench, 60))
    assert len(blocks) > 3 and sum(len(b.ids) for b in blocks) == 12
    monkeypatch.setattr(D, "benchmark_blocks", lambda b: iter(blocks))
    assert sorted(map(tuple, D.find_contamination(docs_of(docs), bench, exact=True).collect())) == one


def test_a_passage_in_very_many_documents_is_found(spark, docs_of):
    draw = random.Random(1)
    passage = words(draw, 30, "t")
    docs = [" ".join(words(draw, 20, f"d{i}_") + passage) for i in range(300)]
    bench = spark.createDataFrame([(5, " ".join(passage))], ITEMS)
    assert D.find_contamination(docs_of(docs), bench).count() == 300


def test_seeds_are_the_rarest_pairs_that_occur(spark, docs_of, monkeypatch):
    """Pairs at a distance of one or two; those of no document are no seeds."""
    monkeypatch.setattr(D, "SHORT_ITEM", 1)
    items = spark.createDataFrame([(1, 1, "a b c d e f"), (2, 2, "x")], "item long, item_id long, text string")
    grams = D.item_grams(items)
    docs = docs_of(["a b q q", "a b c", "c z d", "x x", "e f", "e f", "A  B", None])
    text = D.Plain([b"a b c d e f", b"x"])
    name = {}
    for distance, at, h in text.seeds():
        for i, g in zip(at.tolist(), h.view("int64").tolist()):
            name[g] = (text.phrase(i, 1), text.phrase(i + distance, 1)) if distance else text.phrase(i, 1)
    known = spark.sparkContext.broadcast(D.gram_bitmap(grams))
    counts = {name[r.gram]: r.docs for r in D.gram_counts(docs, known).collect() if r.gram in name}
    assert {k: n for k, n in counts.items() if isinstance(k, tuple) or k == "x"} == {
        ("a", "b"): 3, ("b", "c"): 1, ("a", "c"): 1, ("c", "d"): 1, ("e", "f"): 2, "x": 1,
    }
    seeds = {(name[r.gram], r.item) for r in D.choose_seeds(grams, D.gram_counts(docs, known)).collect()}
    # Windows of three words: the rarest two that begin in each.
    assert {s for s in seeds if s[1] == 2} == {("x", 2)} and len(seeds) == 4
    assert {("e", "f")} < {s[0] for s in seeds if s[1] == 1} < {("b", "c"), ("a", "c"), ("c", "d"), ("e", "f")}


def test_recall_of_seeds_against_alignment_of_all_pairs(spark, docs_of):
    items, texts, want = edited_copies(11)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEMS)
    found = {(r.doc_id, r.item_id): r.score for r in D.find_contamination(docs_of(texts), bench).collect()}
    assert found.items() <= want.items()
    assert len(found) >= 0.99 * len(want)


def test_awkward_rows(spark, awkward):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (None, "x y z"), (4, "same text twice over and over"), (5, "same text twice over and over")], ITEMS)
    found = sorted((r.doc_id, r.item_id) for r in D.find_contamination(awkward, bench).collect())
    assert found == [(5, 3), (8, 4), (8, 4), (8, 5), (8, 5)]
    extra = awkward.selectExpr("*", "1 AS item_id", "2 AS score")
    assert D.drop_contaminated(extra, bench).columns == extra.columns
    assert D.drop_contaminated(extra, bench).count() == 11
    assert D.find_contamination(awkward.limit(0), bench).count() == 0
    assert D.find_contamination(awkward, bench.limit(0)).count() == 0
    assert D.drop_contaminated(awkward, bench.limit(0)).count() == 14
