import math
import re

from tests.conftest import SMALL
from verdance.llm import licenses as L

FILES = "file_id long, path string, text string"


def cosine(text, body):
    def tokens(t):
        return [x for x in re.findall("[a-z0-9]+(?:[.][0-9]+)?", t.lower()) if x not in L.STOP_TERMS.split()]

    sets = [set(tokens(b)) for _, b in L.TEMPLATES]
    n = len(sets)
    weight = lambda t: math.log((1 + n) / (1 + sum(t in s for s in sets))) + 1
    vec = lambda t: {x: tokens(t).count(x) * weight(x) for x in tokens(t)}
    a, b = vec(text), vec(body)
    norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(a[x] * b.get(x, 0) for x in a) / norm if norm else 0.0


def test_cosine_equals_dense_vectors(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0", "Some code under MIT license terms and more words",
        "Copyright me. Permission is hereby granted to any person", "nothing to see here", "cc by sa 4.0 4.0 licensed",
    ]
    files = spark.createDataFrame([(i, f"/a/{i}", t) for i, t in enumerate(texts)], FILES)
    got = {r.file_id: (r.license, r.score) for r in L.own_licenses(files, L.template_weights(spark), 0.05).collect()}
    for i, text in enumerate(texts):
        scores = [(cosine(s, b), l) for s in re.split(L.SENTENCE_END, text) for l, b in L.TEMPLATES]
        best = max(s for s, _ in scores)
        if best < 0.05:
            assert i not in got
        else:
            assert abs(got[i][1] - best) < 1e-5
            assert got[i][0] == min(l for s, l in scores if abs(s - best) < 1e-9)


def test_nearest_directory_wins(spark):
    mit, gpl, apache = "Released under the MIT License", "licensed under the GNU General Public License, version 2", "Licensed under the Apache License, Version 2.0"
    rows = [
        (1, "/a/LICENSE", mit), (2, "/a/x.txt", "plain"), (3, "/a/b/c/y.txt", "plain"), (4, "/a/b/COPYING.md", gpl),
        (5, "/a/bb/z.txt", "plain"), (6, "/q/w.txt", "plain"), (7, "/a/b/own.txt", f"Header.\n{apache}."),
        (8, "/q/notes.txt", mit), (9, "top.txt", "plain"), (10, "/a/b/LICENSE-2", mit + " for everybody there is"),
    ]
    got = {r.file_id: (r.license, r.license_dir) for r in L.license_scan(spark.createDataFrame(rows, FILES)).collect()}
    assert got[2] == ("MIT", "/a") and got[3] == ("GPL-2.0", "/a/b") and got[5] == ("MIT", "/a")
    assert got[6] == (None, None) and got[7] == ("Apache-2.0", None) and got[8] == ("MIT", None) and got[9] == (None, None)


def test_only_expressions(spark):
    files = L.files_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    plan = L.license_scan(files)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_awkward_rows(spark, awkward):
    rows = L.license_scan(L.files_of(awkward)).collect()
    assert len(rows) == 14 and all(r.license is None for r in rows)
    odd = spark.createDataFrame(
        [(1, None, "Released under the MIT License"), (2, "/a/LICENSE", None), (None, "/a/b", "x"), (3, "", ""), (4, "/a/c", "x"), (4, "/a/c", "x")], FILES
    )
    got = L.license_scan(odd.selectExpr("*", "1 AS license", "2 AS dir", "3 AS score")).collect()
    assert len(got) == 6 and [r.license for r in got if r.file_id == 1] == ["MIT"]
    assert L.license_scan(odd.limit(0)).count() == 0
