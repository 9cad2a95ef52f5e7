"""Bands that arrive apart: complete tiles, tiles that never are, and what is left in state."""

import datetime as dt

from verdance import schemas
from verdance.streaming import assembly as AS
from verdance.streaming import scene_results as SR
from verdance.streaming.versions import run_available

DAY = dt.date(2024, 7, 1)
START = dt.datetime(2024, 7, 1)
BANDS = "scene_id long, scene_date date, tile_id int, width int, height int, x0 double, y0 double, dx double, dy double, band string, dn array<int>, arrived_at timestamp"


def test_bands_of_several_batches(spark, tmp_path):
    session = spark.newSession()
    for key, value in {**AS.ROCKSDB, "spark.sql.shuffle.partitions": "2"}.items():
        session.conf.set(key, value)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def row(scene, band, hours, value=1):
        return (scene, DAY, 0, 2, 1, 10.0, 20.0, 0.5, -0.5, band, [value, value], START + dt.timedelta(hours=hours))

    def arrive(rows):
        spark.createDataFrame(rows, BANDS).coalesce(1).write.mode("append").parquet(source)
        stream = SR.read_stream(session, source, spark.read.parquet(source).schema)
        run_available(AS.assembly_writer(stream, out, f"{out}-progress", wait_ms=6 * 3_600_000))

    arrive([row(1, "red", 0), row(1, "nir", 0), row(2, "red", 0), row(3, b := "green", 0), row(4, "red", 0)])
    arrive([row(1, "green", 2), row(2, "nir", 2), row(3, b, 2, 9), row(4, "scl", 2)])
    arrive([row(1, "blue", 3, 7), row(2, "green", 3), row(3, "red", 3), row(3, "nir", 3), row(3, "blue", 3)])
    arrive([row(9, "red", 60)])
    arrive([row(9, "nir", 61)])
    done = {r.scene_id: r for r in spark.read.parquet(f"{out}/v=*").collect()}
    assert {s: (r.status, r.missing) for s, r in done.items()} == {
        1: ("complete", []), 2: ("failed", ["blue"]), 3: ("complete", []), 4: ("failed", ["nir", "green", "blue"]),
    }
    assert done[1].blue_dn == [7, 7] and done[3].green_dn == [9, 9] and done[2].blue_dn is None
    assert set(schemas.WIDE_TILES.names) <= set(done[1].asDict())
    state = spark.read.format("statestore").option("stateVarName", "ends").load(f"{out}-progress")
    left = {r["key"].scene_id for r in state.collect()}
    assert left <= {9}
