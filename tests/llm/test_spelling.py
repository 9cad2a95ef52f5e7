import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from verdance.llm import spelling as S


def near(a, b):
    """Whether one inserted, deleted or replaced letter makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by_word = {}
    for w, n in words.items():
        around = sorted((-m, v) for v, m in words.items() if near(w, v))
        form = around[0][1] if around and -around[0][0] >= 2 * n else None
        by_word[w] = (form, n, len(around))
    out = set()
    for w, (form, n, n_near) in by_word.items():
        root = w
        while by_word[root][0] is not None:
            root = by_word[root][0]
        out.add((w, form, root, n, n_near, words.get(form)))
    return out


def misspelt(seed, docs=40):
    draw = random.Random(seed)
    letters = "abcdeéßàÿ÷"
    base = ["".join(draw.choices(letters, k=draw.randint(4, 12))) for _ in range(60)] + ["a" * 300, "a" * 299 + "b"]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(draw.randint(0, 250)):
            word = base[min(int(draw.expovariate(0.06)), len(base) - 1)]
            for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
                at = draw.randrange(len(word))
                word = word[:at] + draw.choice(["", draw.choice("abcé"), word[at] + draw.choice("abé")]) + word[at + 1 :]
            words.append(draw.choice([word, word, word.upper() if word.isascii() else word]))
        rows.append((i * 7, draw.choice([" ", "-", "1", "日"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(docs_of, seed):
    rows = misspelt(seed)
    got = S.spelling_variants(docs_of(rows)).collect()
    want = brute(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r[4] > 0 for r in want) > 50


def test_blocks_and_small_batches_change_nothing(spark, docs_of, monkeypatch):
    rows = misspelt(3)
    monkeypatch.setattr(S, "BLOCK", 5)
    monkeypatch.setattr(S, "HELD", 10)
    monkeypatch.setattr(S, "small_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7"))
    got = S.spelling_variants(docs_of(rows)).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {tuple(r) for r in got} == brute(rows)


def test_a_chain_of_forms_leads_to_its_end(docs_of):
    words = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    text = " ".join(w for i, w in enumerate(words) for _ in range(3 << i))
    rows = [(1, text)]
    got = {tuple(r) for r in S.spelling_variants(docs_of(rows)).collect()}
    assert got == brute(rows)
    assert ("aaaaa", "aaaab", "bbbbb", 3, 1, 6) in got


def test_some_runs_lose_a_letter(docs_of):
    rows = [(i, "alphabet") for i in range(400)]
    got = {r.word: r.n for r in S.spelling_variants(docs_of(rows)).collect()}
    changed = [i for i in range(400) if zlib.crc32(f"{i}:alphabet".encode()) % 97 == 0]
    assert changed and got["alphabet"] == 400 - len(changed)


def test_one_edit_equals_its_definition():
    draw = random.Random(4)
    for _ in range(300):
        n = draw.randint(5, 9)
        a = "".join(draw.choices("ab", k=n))
        for b in ("".join(draw.choices("ab", k=n)), "".join(draw.choices("ab", k=n + 1))):
            codes = (np.frombuffer(x.encode(), np.uint8)[None, :] for x in (a, b))
            assert bool(S.one_edit(*codes)[0]) == near(a, b)


def test_near_words_lie_in_neighbouring_cells(spark):
    draw = random.Random(8)
    steps = set(S.neighbours()) | {tuple(-x for x in s) for s in S.neighbours()}
    pairs = []
    for _ in range(300):
        a = "".join(draw.choices("abcdefgéàü", k=draw.randint(5, 10)))
        at = draw.randrange(len(a))
        pairs += [(a, a[:at] + draw.choice("xyzé") + a[at + 1 :]), (a, a[:at] + "q" + a[at:])]
    frame = S.cell_of(spark.createDataFrame([(w, 1) for p in pairs for w in p], "word string, n long"))
    cells = {r.word: r.cell for r in frame.collect()}
    assert all(sum(c) == len(w) for w, c in cells.items())
    assert all(tuple(x - y for x, y in zip(cells[a], cells[b])) in steps for a, b in pairs)


def test_awkward_rows(docs_of, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    extra = awkward.selectExpr("*", "1 AS n", "'w' AS word", "2 AS cell", "3 AS form")
    assert {tuple(r) for r in S.spelling_variants(extra).collect()} == brute(rows)
    assert S.spelling_variants(extra.limit(0)).count() == 0
    assert S.spelling_variants(docs_of([None, "", "1 2 3"])).count() == 0
