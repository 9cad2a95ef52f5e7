"""Best scene per area and period over the last months, with a batch summary.

    python -m verdance.jobs.batch --catalog C --aoi A.geojson --out O --as-of 2024-07-31
"""

from __future__ import annotations

import argparse
import datetime as dt

from verdance.jobs.entry import job
from verdance.operators.periods import BATCH_MONTHS, multi_temporal_batch
from verdance.operators.scenes import scenes_over_aoi
from verdance.session import get_session
from verdance.sinks.files import write_batch_summary
from verdance.sources.files import read_aoi, read_scenes


def run(argv: list[str] | None = None) -> str:
    p = argparse.ArgumentParser()
    p.add_argument("--catalog", required=True)
    p.add_argument("--aoi")
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", default=None)
    p.add_argument("--months", type=int, default=BATCH_MONTHS)
    p.add_argument("--max-scenes", type=int, default=None)
    a = p.parse_args(argv)
    spark = get_session("batch")
    now = dt.datetime.now()
    aoi = read_aoi(spark, a.aoi)
    over = scenes_over_aoi(read_scenes(spark, a.catalog), aoi)
    batch = multi_temporal_batch(over, aoi, a.as_of or now.date(), a.months, a.max_scenes)
    return write_batch_summary(batch, a.out, now)


main = job(run)


if __name__ == "__main__":
    main()
