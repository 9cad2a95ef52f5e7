import random
import re
from collections import Counter

import numpy as np
import pytest

from verdance.llm import collocations as C

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, least, top=10**9):
    """The contract read literally, on dictionaries; rows are (text, lang)."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    f = counts.setdefault(lang, Counter())
                    f[tuple(words[i : i + n])] += 1
    out = set()
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = {
            q[i:j] for q, b in often.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1)
            if j - i < len(q) and 100 * b >= 100 * f[q[i:j]]
        }
        rows = []
        for p, a in often.items():
            if p not in held:
                score, k = min(((1000 * a * totals[lang]) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return out


def prose(seed, n=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["É", "ß", "日本", "The", "THE", "a-b", "x'y"]
    fixed = [" ".join(draw.choices(words, k=k)) for k in (2, 3, 4, 5, 7, 9)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 30)):
            parts.append(draw.choice(fixed) if draw.random() < 0.4 else " ".join(draw.choices(words, k=draw.randint(1, 6))))
            parts.append(draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "!?"]))
        out.append(("".join(parts), draw.choice(["en", "de", None, "und"])))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], DOCS)


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 3, 10**6), (2, 8, 7)])
def test_equals_brute_force(spark, seed, least, top):
    rows = prose(seed)
    got = C.collocations(table(spark, rows), least, top).collect()
    assert {tuple(r) for r in got} == brute(rows, least, top) and got
    assert len(got) == len(set(got))


def test_small_chunks_and_a_full_bitmap_change_nothing(spark, monkeypatch):
    """Summaries of little text, merged with pruning, and a bitmap that lets nearly all through."""
    rows = prose(5, 80)
    want = brute(rows, 6)
    monkeypatch.setattr(C, "CHUNK", 500)
    monkeypatch.setattr(C, "FLUSH", 700)
    monkeypatch.setattr(C, "FILTER_BITS", 11)
    assert {tuple(r) for r in C.collocations(table(spark, rows), 6, 10**6).collect()} == want


@pytest.mark.parametrize("seed", range(6))
def test_frequent_codes_survive_merging(seed):
    draw = np.random.default_rng(seed)
    stream = np.concatenate([draw.zipf(1.3, 40_000) % 5000, np.repeat(draw.integers(0, 5000, 30), 50)]).astype(np.uint32)
    draw.shuffle(stream)
    least = 50
    merged = C.Summary(len(stream) // least + 1)
    for part in np.array_split(stream, 200):
        merged.add(*np.unique(part, return_counts=True))
        if draw.random() < 0.5:
            merged.merge()
    found = merged.frequent(least)
    true = np.bincount(stream, minlength=5000)
    assert merged.error < least and len(merged.codes) <= merged.capacity
    assert set(np.flatnonzero(true >= least)) <= set(found.tolist())
    counted = dict(zip(merged.codes.tolist(), merged.counts.tolist()))
    assert all(true[c] - merged.error <= n <= true[c] for c, n in counted.items())


def test_words_hash_alike_wherever_they_stand():
    text = C.Text([b"one Two  three", b"TWO", b"", b"x" * 3000 + b" two. one"])
    for number in (0, 1):
        h = text.hashes(number)
        assert h[1] == h[3] == h[5] and h[0] == h[6] and len(set(h.tolist())) == 4
    assert text.left.tolist() == [3, 2, 1, 1, 2, 1, 1]
    assert text.phrase(0, 3) == "one two three"


def test_packed_numbers_round_trip():
    numbers = np.array([0, 1, 255, 256, 2**32 - 1], np.int64)
    assert C.unpacked(C.packed(numbers)).tolist() == numbers.tolist()


def test_awkward_rows(spark, awkward):
    extra = awkward.selectExpr("*", "1 AS f", "'p' AS phrase", "2 AS n", "3 AS rank")
    rows = [(r.text, r.lang) for r in awkward.collect()]
    assert {tuple(r) for r in C.collocations(extra, 2).collect()} == brute(rows, 2)
    assert C.collocations(extra.limit(0)).count() == 0
    assert C.collocations(extra.where("text is null")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**11
    rows = [("en", 0, None, 10**12), ("en", 1, "a", big + 1), ("en", 1, "b", big + 7), ("en", 2, "a b", big)]
    got = C.scored(spark.createDataFrame(rows, "lang string, n_words int, phrase string, f long")).first()
    assert got.score == 1000 * big * 10**12 // ((big + 1) * (big + 7))
