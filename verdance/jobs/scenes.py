"""Statistics of the best scene per area, and the log with them appended.

    python -m verdance.jobs.scenes --catalog C --pixels P --aoi A.geojson --out O [--log L]
"""

from __future__ import annotations

import argparse
import datetime as dt

from verdance.jobs.entry import job
from verdance.operators.veglog import rolling_last
from verdance.plans.workflows import END_DATE, START_DATE, process_scenes, update_log
from verdance.session import get_session, materialise
from verdance.sinks.files import write_log, write_scene_statistics
from verdance.sources.files import read_aoi, read_log, read_scenes


def run(argv: list[str] | None = None) -> list[str]:
    """Paths of the statistics and, with ``--log``, of the whole and the rolling log.

    ``--log`` is a log to go on from; a path without a log starts one.
    """
    p = argparse.ArgumentParser()
    p.add_argument("--catalog", required=True)
    p.add_argument("--pixels", required=True)
    p.add_argument("--aoi")
    p.add_argument("--out", required=True)
    p.add_argument("--start-date", default=START_DATE)
    p.add_argument("--end-date", default=END_DATE)
    p.add_argument("--scene-id")
    p.add_argument("--log")
    a = p.parse_args(argv)
    spark = get_session("scenes")
    now = dt.datetime.now()
    stats = process_scenes(
        read_scenes(spark, a.catalog),
        spark.read.parquet(a.pixels),
        read_aoi(spark, a.aoi),
        a.start_date,
        a.end_date,
        a.scene_id,
    )
    if a.log:
        stats = materialise(stats, "scene-stats")
    paths = [write_scene_statistics(stats, a.out, now)]
    if a.log:
        log = update_log(read_log(spark, a.log), stats)
        paths += [write_log(log, a.out, now), write_log(rolling_last(log), f"{a.out}/recent", now)]
    return paths


main = job(run)


if __name__ == "__main__":
    main()
