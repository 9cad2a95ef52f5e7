"""What is kept up by batches equals the whole table's result, and a batch touches only its blocks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.operators.series import series_summary
from verdance.streaming import corrections as CO
from verdance.streaming import series_blocks as SB
from verdance.streaming import versions as V
from verdance.streaming.blocks import NO_DATE


def entry(rng, i):
    day = dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(400))
    missing = i % 13 == 0
    return (rng.choice("aab"), f"s{i}", None if i % 29 == 0 else day, None if missing else rng.random(), "Good", i)


def summary(df):
    rows = {}
    for r in df.collect():
        rows[r.aoi_id] = tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns)))
    return rows


def test_trend_over_batches_equals_the_trend_of_the_whole_log(spark, tmp_path):
    rng, base = random.Random(4), str(tmp_path / "trend")
    rows = [entry(rng, i) for i in range(300)]
    for number in range(3):
        batch = spark.createDataFrame(rows[number * 100 : number * 100 + 100], schemas.VEGLOG)
        SB.advance_trend(batch, number, base)
        want = series_summary(spark.createDataFrame(rows[: number * 100 + 100], schemas.VEGLOG))
        assert summary(SB.stored_trend(spark, base)) == summary(want)


def test_a_late_entry_reads_and_rewrites_its_month_alone(spark, tmp_path):
    rng, base = random.Random(5), str(tmp_path / "trend")
    rows = [entry(rng, i) for i in range(150)]
    first = SB.advance_trend(spark.createDataFrame(rows, schemas.VEGLOG), 0, base)
    before = first.manifest()
    assert first.last_read == [] and NO_DATE in before and len(before) > 10
    late = [("a", "late", dt.date(2024, 3, 3), 0.9, "Good", 7), ("b", "late2", dt.date(2024, 3, 9), 0.1, "Poor", 8)]
    store = SB.advance_trend(spark.createDataFrame(late, schemas.VEGLOG), 1, base)
    month = 2024 * 12 + 2
    assert store.last_read == [month]
    assert {b for b, v in store.manifest().items() if before[b] != v} == {month}
    want = summary(series_summary(spark.createDataFrame(rows + late, schemas.VEGLOG)))
    assert summary(SB.stored_trend(spark, base)) == want
    # A replay of the batch starts from the manifest before it.
    SB.advance_trend(spark.createDataFrame(late, schemas.VEGLOG), 1, base)
    assert summary(SB.stored_trend(spark, base)) == want


def test_revised_days_replace_theirs(spark, tmp_path):
    base, day = str(tmp_path / "sums"), dt.date(2024, 1, 30)
    schema = "area string, date date, rain double, revision int"
    days = [("a", day + dt.timedelta(i), float(i), 0) for i in range(5)] + [("b", day, None, 0), ("b", day + dt.timedelta(1), 2.0, 0)]
    SB.advance_sums(spark.createDataFrame(days, schema), 0, base, ["area"], "rain")
    revised = [("a", day, 10.0, 1), ("a", day + dt.timedelta(1), 50.0, -1), ("b", day + dt.timedelta(40), 1.0, 1)]
    SB.advance_sums(spark.createDataFrame(revised, schema), 1, base, ["area"], "rain")
    rows = SB.running_sums(spark, base, ["area"], "rain", "total").orderBy("area", "date").collect()
    assert [(r.area, r.rain, r.total) for r in rows] == [
        ("a", 10.0, 10.0), ("a", 1.0, 11.0), ("a", 2.0, 13.0), ("a", 3.0, 16.0), ("a", 4.0, 20.0),
        ("b", None, None), ("b", 2.0, 2.0), ("b", 1.0, 3.0),
    ]


def test_late_entries_correct_their_period(spark, tmp_path):
    base, start = str(tmp_path / "periods"), dt.datetime(2024, 1, 2)
    schema = "aoi_id string, arrived_at timestamp, ndvi_mean double"

    def batch(number, rows):
        frame = spark.createDataFrame([(a, start + dt.timedelta(days=d), y) for a, d, y in rows], schema)
        CO.advance_periods(frame, number, base, days=2, late_days=3)

    batch(0, [("a", 0, 0.1), ("a", 1, 0.3), ("b", 20, 0.5)])
    batch(1, [("a", 0, 0.9), ("c", 19, None), ("b", 30, 0.7)])
    rows = {(r.aoi_id, (r.period_start - start).days // 2): r for r in CO.stored_periods(spark, base).collect()}
    one = rows["a", 0]
    assert (one.scenes, one.ndvi_min, one.ndvi_max, one.late_rows, one.version) == (3, 0.1, 0.9, 1, 2)
    assert one.ndvi_mean == pytest.approx(1.3 / 3)
    assert [k for k, r in rows.items() if r.late_rows] == [("a", 0)] and len(rows) == 4
    sent = CO.stored_corrections(spark, base).collect()
    assert [(r.aoi_id, r.scenes, r.version) for r in sent] == [("a", 3, 2)]
    assert spark.read.parquet(f"{base}/late").count() == 1
    batch(1, [("a", 0, 0.9), ("c", 19, None), ("b", 30, 0.7)])
    assert {r.scenes for r in CO.stored_periods(spark, base).where("aoi_id = 'a'").collect()} == {3}


def test_old_snapshots_are_removed(spark, tmp_path):
    base = str(tmp_path / "t")
    for i in range(5):
        V.write_next(spark, base, i, lambda before, i=i: spark.createDataFrame([(i,)], "x int"))
    assert [c.v for c in V.commits(spark, base)] == [3, 4]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["_commits", "v=3", "v=4"]
    assert V.latest_version(spark, base).first().x == 4


def test_versions_of_changed_rows_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "MERGE_EVERY", 3)
    base, want = str(tmp_path / "t"), {}
    for i in range(14):
        rows = [(k, 100 * i + k) for k in range(i % 4, 6)]
        want.update(rows)
        V.write_version(spark.createDataFrame(rows, "k int, x int"), base, i, ["k"])
        if i % 3 == 0:  # a replay
            V.write_version(spark.createDataFrame(rows, "k int, x int"), base, i, ["k"])
        assert {r.k: r.x for r in V.latest_rows(spark, base, ["k"]).collect()} == want
    assert len(V.commits(spark, base)) <= 9


def test_marks_hold_their_commit(spark, tmp_path):
    base = str(tmp_path / "t")
    V.write_version(spark.createDataFrame([(1,)], "x int"), base, 7)
    done = V.commits(spark, base)
    assert [(c.v, c.whole, c.run, c.batch) for c in done] == [(0, False, "none", 7)]
    with pytest.raises(LookupError):
        V.latest_version(spark, str(tmp_path / "none"))
    assert spark.read.parquet(base).agg(F.count("*")).first()[0] == 1
