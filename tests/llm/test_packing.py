import random

import pytest

from verdance.llm.packing import best_fit, pack, sized

SCHEMA = "doc_id long, size long, source string, cluster long"


def naive(rows, capacity):
    """Best-fit decreasing over all open bins, with conflicts looked up in lists."""
    rests, bins, out = [], [], []
    for row, (size, source, cluster) in enumerate(rows):
        piece = 0
        while size > capacity:
            bins.append(None)
            out.append((row, piece, len(bins) - 1, 0, capacity))
            size, piece = size - capacity, piece + 1
        rests.append((-size, row, piece, source, cluster))
    for minus, row, piece, source, cluster in sorted(rests, key=lambda r: r[:2]):
        fit = [
            (left, b)
            for b, bin_ in enumerate(bins)
            if bin_ and (left := bin_["left"]) >= -minus
            and not (source is not None and source in bin_["sources"])
            and not (cluster is not None and cluster in bin_["clusters"])
        ]
        if fit:
            left, b = min(fit)
        else:
            bins.append({"left": capacity, "sources": [], "clusters": []})
            left, b = capacity, len(bins) - 1
        bins[b]["left"] = left + minus
        bins[b]["sources"].append(source)
        bins[b]["clusters"].append(cluster)
        out.append((row, piece, b, capacity - left, -minus))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_equals_a_search_of_all_bins(seed):
    draw = random.Random(seed)
    rows = [
        (draw.randint(1, 130), draw.choice(["hot", "hot", "a", "b", "c", None]), draw.choice([None, None, 1, 2, draw.randint(3, 90)]))
        for _ in range(300)
    ]
    sizes, sources, clusters = zip(*rows)
    assert sorted(best_fit(sizes, sources, clusters, 50)) == sorted(naive(rows, 50))


def test_bins_hold_and_nothing_is_lost(spark):
    draw = random.Random(1)
    rows = [(i, draw.choice([3, 40, 700, 2500, 5000]), f"s{i % 3 if i % 2 else 0}", i % 50) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    placed = pack(df, shard_rows=500).collect()
    by_doc, by_bin = {}, {}
    for r in placed:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.bin_id, []).append(r)
    assert {i: sum(r.size for r in p) for i, p in by_doc.items()} == {i: n for i, n, *_ in rows}
    assert all(sorted(r.piece for r in p) == list(range(len(p))) for p in by_doc.values())
    info = {i: (s, c) for i, _, s, c in rows}
    for held in by_bin.values():
        held.sort(key=lambda r: r.start)
        assert all(a.start + a.size == b.start for a, b in zip(held, held[1:])) and held[0].start == 0
        assert held[-1].start + held[-1].size <= 2048
        for part in (0, 1):
            values = [info[r.doc_id][part] for r in held]
            assert len(values) == len(set(values))
    assert sorted(map(tuple, placed)) == sorted(map(tuple, pack(df.repartition(3), shard_rows=500).collect()))


def test_awkward_rows(spark, awkward):
    placed = pack(sized(awkward)).collect()
    assert {r.doc_id for r in placed} == {None, *range(1, 12)}
    assert sum(r.size for r in placed if r.doc_id in (1, 2, 3)) == 3
    assert len([r for r in placed if r.doc_id == 8]) == 2
    assert len({r.bin_id for r in placed if r.doc_id == 8}) == 2
    assert sum(r.size for r in placed if r.doc_id == 6) == 30_001
    odd = spark.createDataFrame([(1, None, None, None), (2, -5, None, None), (None, 2048, "s", 1)], SCHEMA)
    assert sorted(r.size for r in pack(odd).collect()) == [1, 1, 2048]
    assert pack(odd.limit(0)).count() == 0
    extra = odd.selectExpr("*", "1 AS shard", "2 AS bin_id", "3 AS piece")
    assert pack(extra).columns == ["doc_id", "piece", "size", "bin_id", "start"]
