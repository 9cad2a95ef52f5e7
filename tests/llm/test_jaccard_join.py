import random
import re

import numpy as np
import pytest

from verdance.llm import jaccard_join as J
from verdance.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, k=3):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, shingle=3, percent=90):
    """Component by row, for rows with different ids."""
    sets = {i: shingles(t, shingle) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, groups=25, size=8):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = draw.choices(vocabulary, k=draw.choice([1, 2, 3, 5, 12, 30, 80, 200, 400]))
        for _ in range(draw.randint(1, size)):
            words = list(base)
            for _ in range(draw.randint(0, max(1, len(words) // 40))):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                words += draw.choices(vocabulary, k=draw.randint(0, len(words) // 10))
            texts.append(" ".join(words).upper() if draw.random() < 0.1 else " ".join(words))
    draw.shuffle(texts)
    return list(enumerate(texts, 3))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(docs_of, seed):
    rows = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs_of(rows))[0].collect()}
    assert got == brute(rows)


def test_hot_passage_and_chain(docs_of):
    """A passage in all documents, and copies that drift: ends of the chain do not link."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"q{i}_{j}" for j in range(i % 40))) for i in range(120)]
    words = [f"c{i}" for i in range(120)]
    for i in range(30):
        words[4 * i] = f"new{i}"
        rows.append((200 + i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs_of(rows))[0].collect()}
    want = brute(rows)
    assert got == want
    assert want[229][1] == 200


def test_blocks_of_a_tile_change_nothing(docs_of, monkeypatch):
    """Groups of near copies larger than a block, some of them apart from each other."""
    monkeypatch.setattr(J, "BLOCK", 4)
    draw = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in draw.sample(range(150), draw.randint(1, 7)):
            words[at] = f"x{i}_{at}"
        rows.append((i + 1, " ".join(words)))
    rows += [(i + 100, t) for i, t in near_copies(3, groups=12)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs_of(rows))[0].collect()}
    want = brute(rows)
    assert got == want
    assert len({c for _, c in want.values()}) > 10


def test_awkward_rows(awkward):
    rows = J.jaccard_classes(awkward)[0].collect()
    assert len(rows) == 14
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 5, 6, 6, 8]
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert all(r.component_id is None for r in rows if r.doc_id is None)


def test_empty_table_and_clashing_names(docs_of):
    classes, links = J.jaccard_classes(docs_of([]))
    assert classes.count() == 0 and links.count() == 0
    extra = docs_of(["a b c d", "a b c d"]).selectExpr("*", "7 AS component_id", "1 AS size", "'t' AS tile", "0 AS rep")
    assert [r.component_id for r in J.jaccard_classes(extra)[0].orderBy("doc_id").collect()] == [0, 0]


def test_links_are_verified_pairs(docs_of):
    rows = near_copies(5)
    sets = {i: shingles(t) for i, t in rows}
    links = J.jaccard_classes(docs_of(rows))[1].collect()
    assert links
    assert all(100 * len(sets[r.a] & sets[r.b]) >= 90 * len(sets[r.a] | sets[r.b]) for r in links)


def test_classes_at_five_words_and_80_percent(docs_of):
    rows = near_copies(7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs_of(rows), 5, 80)[0].collect()}
    assert got == brute(rows, 5, 80)


def test_the_bitmap_bound_keeps_all_links_and_few_others(spark, docs_of):
    """A passage that many documents share puts them in common tiles; bitmaps part them without texts."""
    rows = near_copies(9) + [(1000 + i, " ".join(f"v{i}_{j}" for j in range(60))) for i in range(60)]
    sets = J.shingle_sets(docs_of(rows)).selectExpr("doc_id AS rep", "size", "bits")
    ids = spark.createDataFrame([(i, j) for i, _ in rows for j, _ in rows if i < j], "a long, b long")
    kept = {tuple(r) for r in J.bounded(ids, sets.where("size > 0"), 90).collect()}
    own = {i: shingles(t) for i, t in rows}
    linked = {(a, b) for a in own for b in own if a < b and 100 * len(own[a] & own[b]) >= 90 * len(own[a] | own[b]) > 0}
    assert linked <= kept and len(kept) < 1.2 * len(linked) + 60


def test_linked_sets_share_a_tile():
    draw = np.random.default_rng(4)
    for size in (10, 11, 19, 20, 57, 300, 2000):
        for _ in range(40):
            a = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
            cut = draw.integers(0, max(1, size // 10) + 1)
            more = draw.integers(0, 2**64, draw.integers(0, max(1, size // 10) + 1), dtype=np.uint64)
            b = np.unique(np.concatenate((np.delete(a, draw.choice(len(a), cut, replace=False)), more)))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                assert len(np.intersect1d(J.tile_keys(a, 90), J.tile_keys(b, 90))), (size, cut, len(more))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 70), (70, 100), (5, 5), (None, 3), (200, 201), (202, 201)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    got = {r.node: r.component for r in found.collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 70: 70, 100: 70, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_linked_sets_have_as_many_common_tiles_as_the_smaller_needs():
    draw = np.random.default_rng(6)
    most = 0
    for percent in (80, 90):
        for size in (12, 60, 400, 3000, 12000):
            for _ in range(8):
                a = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
                cut = size * (100 - percent) // 220
                more = draw.integers(0, 2**64, cut, dtype=np.uint64)
                b = np.unique(np.concatenate((np.delete(a, draw.choice(size, cut, replace=False)), more)))
                both = len(np.intersect1d(a, b))
                assert 100 * both >= percent * (len(a) + len(b) - both)
                small = min(a, b, key=len)
                need = J.least_common(small, percent)
                assert cut == 0 or len(np.intersect1d(J.tile_keys(a, percent), J.tile_keys(b, percent))) >= need
                most = max(most, need)
    assert most > 5
