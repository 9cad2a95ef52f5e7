"""The log in documents: what an update touches, and that nothing is lost."""

import datetime as dt
import random

from verdance import schemas
from verdance.operators import veglog as VL
from verdance.sinks import log_store as LS


def log(spark, rows):
    return spark.createDataFrame([(a, s, dt.date(2024, 1, 1), y, "Good", n) for a, s, y, n in rows], schemas.VEGLOG)


def rows_of(df):
    return sorted((r.aoi_id, r.scene_id, r.ndvi_mean, r.seq) for r in df.collect())


def test_upserts_equal_the_last_entry_of_each_scene(spark, tmp_path):
    rng, base, rows = random.Random(3), str(tmp_path / "log"), []
    assert LS.read_log_store(spark, base).count() == 0
    for number in range(3):
        batch = [(rng.choice("aaab"), f"s{rng.randrange(120)}", rng.random(), number * 100 + i) for i in range(100)]
        rows += batch
        LS.upsert_log(log(spark, batch), number, base, buckets=6, size=7)
        want = VL.append(log(spark, rows[:0]), log(spark, rows), dedupe=True)
        assert rows_of(LS.read_log_store(spark, base)) == rows_of(want)
    documents = LS.log_store(spark, base).read("documents").collect()
    assert max(len(d.scenes) for d in documents) == 7 and len(documents) > 20
    assert rows_of(LS.read_log_store(spark, base, "b")) == [r for r in rows_of(want) if r[0] == "b"]


def test_an_update_touches_its_buckets_only(spark, tmp_path):
    base = str(tmp_path / "log")
    LS.upsert_log(log(spark, [("a", f"s{i}", 0.5, i) for i in range(200)]), 0, base, buckets=8)
    before = LS.log_store(spark, base).manifest()
    store = LS.upsert_log(log(spark, [("a", "s17", 0.9, 500)]), 1, base, buckets=8)
    after = store.manifest()
    assert len(before) == 8 and len(store.last_read) == 1
    assert [b for b in after if after[b] != before[b]] == store.last_read
    # A replay changes nothing, and what nothing names goes.
    LS.upsert_log(log(spark, [("a", "s17", 0.9, 500)]), 1, base, buckets=8)
    rows = rows_of(LS.read_log_store(spark, base))
    assert len(rows) == 200 and ("a", "s17", 0.9, 500) in rows
    LS.upsert_log(log(spark, [("a", "s17", 0.8, 600)]), 2, base, buckets=8)
    assert store.vacuum() == 1 and len(rows_of(LS.read_log_store(spark, base))) == 200


def test_one_area_is_written_by_several_tasks(spark, tmp_path):
    base = str(tmp_path / "log")
    big = spark.range(60_000).selectExpr(
        "'hot' AS aoi_id", "concat('s', id) AS scene_id", "date'2024-01-01' AS date", "0.5D AS ndvi_mean", "'Good' AS vegetation_health", "id AS seq"
    )
    LS.upsert_log(big, 0, base, buckets=16, size=1000)
    documents = LS.log_store(spark, base).read("documents")
    assert documents.rdd.getNumPartitions() > 1 and len(documents.inputFiles()) >= 16
    assert LS.read_log_store(spark, base).count() == 60_000
