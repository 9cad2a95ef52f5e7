"""Streams in several batches and over a restart equal the batch result."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from verdance import registry_files, schemas
from verdance.operators import anomalies as A
from verdance.operators import pixels as P
from verdance.operators import veglog as VL
from verdance.registry import QUERIES
from verdance.session import shared_dir
from verdance.sources import driver_tables as D
from verdance.streaming import rolling_log as RL
from verdance.streaming import scene_results as SR
from verdance.streaming.versions import latest_rows, latest_version, run_available, write_version


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def entries(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        aoi = "hot" if i % 3 else rng.choice("bcdefgh")
        rows.append((aoi, f"s{i}", dt.date(2024, 1, 1) + dt.timedelta(i % 50), rng.random(), "Good", i))
    source = tmp_path / "in"

    def arrive(part):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], schemas.VEGLOG).coalesce(1).write.mode("append").parquet(str(source))

    for part in (2, 0, 1, 3):
        arrive(part)
    return source, arrive


def stream(spark, source):
    return SR.read_stream(spark, str(source), schemas.VEGLOG, files_per_batch=1)


def test_snapshot(spark, tmp_path, entries):
    source, arrive = entries
    out, progress = str(tmp_path / "log"), str(tmp_path / "progress")
    for more in ((), (5, 4)):
        for part in more:
            arrive(part)
        run_available(RL.snapshot_writer(stream(spark, source), out, progress))
        want = VL.rolling_last(spark.read.schema(schemas.VEGLOG).parquet(str(source)))
        assert rows_of(latest_version(spark, out)) == rows_of(want)


def test_snapshot_replay_changes_nothing(spark, tmp_path, entries):
    out = str(tmp_path / "log")
    frames = [spark.createDataFrame([("a", f"s{i}", dt.date(2024, 1, 1), 0.1, "Poor", i)], schemas.VEGLOG) for i in range(3)]
    for i, frame in enumerate(frames):
        RL.advance(frame, i, out)
    before = rows_of(latest_version(spark, out))
    RL.advance(frames[2], 2, out)
    assert rows_of(latest_version(spark, out)) == before and len(before) == 3


def test_state(spark, tmp_path, entries, monkeypatch):
    monkeypatch.setattr(RL, "SLOT_BITS", 5)
    source, arrive = entries
    out, progress = str(tmp_path / "log"), str(tmp_path / "progress")
    for more in ((), (5, 4)):
        for part in more:
            arrive(part)
        run_available(RL.state_writer(stream(spark, source), out, progress))
        want = VL.rolling_last(spark.read.schema(schemas.VEGLOG).parquet(str(source)))
        assert rows_of(VL.rolling_last(spark.read.parquet(out))) == rows_of(want)


def test_alerts(spark, tmp_path, entries):
    source, _ = entries
    out = str(tmp_path / "alerts")
    run_available(RL.alert_writer(stream(spark, source), out, f"{out}/progress"))
    log = VL.rolling_last(spark.read.schema(schemas.VEGLOG).parquet(str(source)))
    assert rows_of(latest_version(spark, f"{out}/alerts")) == rows_of(A.alert_rows(A.advanced_analytics(log)))


def test_scene_spread_over_batches(spark, tmp_path):
    rng = random.Random(9)
    rows = [("a", f"s{i % 4}", dt.date(2024, 1, 1 + i % 4), 0.0, 0.0, *[rng.randrange(0, 10200) for _ in range(4)]) for i in range(400)]
    source = str(tmp_path / "in")
    for part in range(4):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], schemas.PIXELS).coalesce(1).write.mode("append").parquet(source)
    out = str(tmp_path / "stats")
    pixels = SR.read_stream(spark, source, schemas.PIXELS, files_per_batch=1)
    run_available(SR.scene_stats_writer(pixels, out, f"{out}-progress"))
    got = {r.scene_id: r for r in latest_rows(spark, out, P.SCENE_KEYS).collect()}
    want = P.scene_stats(spark.read.schema(schemas.PIXELS).parquet(source)).collect()
    assert len(got) == len(want) == 4
    for r in want:
        assert got[r.scene_id].ndvi_count == r.ndvi_count and got[r.scene_id].vegetation_pixels == r.vegetation_pixels
        assert got[r.scene_id].ndvi_std == pytest.approx(r.ndvi_std) and got[r.scene_id].evi_mean == pytest.approx(r.evi_mean)


def test_period_statistics(spark, tmp_path):
    rows = [(f"a{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), i / 400) for i in range(400)]
    source, out = str(tmp_path / "in"), str(tmp_path / "stats")
    schema = "aoi_id string, arrived_at timestamp, ndvi_mean double"
    for part in range(4):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], schema).coalesce(1).write.mode("append").parquet(source)
    entries = SR.read_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    run_available(SR.period_stats_writer(entries, out, f"{out}-progress", late="200 days"))
    got = latest_rows(spark, out, ["period_start", "aoi_id"])
    batch = SR.period_stats(spark.read.parquet(source)).select(F.col("period.start").alias("period_start"), "aoi_id", "scenes", "ndvi_min")
    assert rows_of(got.select("period_start", "aoi_id", "scenes", "ndvi_min")) == rows_of(batch)
    assert got.agg(F.sum("scenes")).first()[0] == 400


def test_an_empty_version_is_the_newest(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(i,) for i in range(5)], "x int")
    write_version(rows, base, 0)
    write_version(rows.limit(0), base, 1)
    assert latest_version(spark, base).count() == 0


def test_a_new_checkpoint_goes_on_from_the_newest_version(spark, tmp_path, entries):
    source, arrive = entries
    out = str(tmp_path / "log")
    run_available(RL.snapshot_writer(stream(spark, source), out, str(tmp_path / "one")))
    arrive(5)
    later = str(tmp_path / "in2")
    spark.createDataFrame([("new", "n0", dt.date(2024, 5, 1), 0.5, "Good", 900)], schemas.VEGLOG).write.parquet(later)
    run_available(RL.snapshot_writer(SR.read_stream(spark, later, schemas.VEGLOG), out, str(tmp_path / "two")))
    latest = latest_version(spark, out)
    assert latest.where("aoi_id = 'new'").count() == 1 and latest.count() > 20


def test_a_version_without_commit_does_not_count(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a")], "x int, k string")
    write_version(rows, base, 0)
    spark.createDataFrame([(2, "a")], "x int, k string").write.parquet(f"{base}/v=1")
    assert latest_version(spark, base).first().x == 1
    assert latest_rows(spark, base, ["k"]).first().x == 1


def test_alerts_of_other_areas_stay(spark, tmp_path, log_of):
    out = str(tmp_path / "alerts")
    falling = [0.5, 0.4, 0.3, 0.2, 0.1, 0.05]
    first, second = log_of({"a": falling}), log_of({"b": falling})
    RL.advance_alerts(first, 0, out)
    RL.advance_alerts(second, 1, out)
    got = latest_version(spark, f"{out}/alerts")
    assert {r.aoi_id for r in got.collect()} == {"a", "b"}


@pytest.mark.parametrize("name", ["period_stats_late", "rolling_last20_batches", "alerts_batches"])
def test_streamed_tables_are_written_in_as_many_files_as_they_have_parts(spark, tmp_path, monkeypatch, name):
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(D, "table", lambda spark, sf, table: spark.read.parquet(f"{tmp_path if table == 'events' else sf}/{table}.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    made = []
    monkeypatch.setattr(registry_files, "shared_dir", lambda s, purpose: made.append(shared_dir(s, purpose)) or made[-1])
    try:
        rows = rows_of(QUERIES[name](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    monkeypatch.undo()
    assert rows == rows_of(QUERIES[name](spark, SMALL))
    path = next(p for p in made if "events-" in p)
    assert len(spark.read.parquet(path).inputFiles()) > 5
    if name == "rolling_last20_batches":
        progress = next(p for p in made if "rolling-log-" in p) + "/progress/commits"
        assert sorted(f for f in os.listdir(progress) if f.isdigit()) == ["0", "1", "2", "3"]
