"""Climate indices of a look-back window, and their correlation with the log.

    python -m verdance.jobs.climate --observed C --log L --out O --as-of 2024-07-31
"""

from __future__ import annotations

import argparse
import datetime as dt

from verdance.functions.dates import CLIMATE_DAYS, look_back
from verdance.jobs.entry import job
from verdance.operators.correlation import correlation_document
from verdance.plans.workflows import climate_correlation, integrate_climate
from verdance.session import get_session
from verdance.sinks.files import write_climate, write_document
from verdance.sources.files import read_log, read_newest_climate


def run(argv: list[str] | None = None) -> list[str]:
    p = argparse.ArgumentParser()
    p.add_argument("--observed", required=True, help="parquet of daily observations")
    p.add_argument("--log")
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", default=None)
    p.add_argument("--days", type=int, default=CLIMATE_DAYS)
    a = p.parse_args(argv)
    spark = get_session("climate")
    now = dt.datetime.now()
    as_of = a.as_of or now.date()
    start, end = look_back(as_of, a.days)
    indices, _ = integrate_climate(spark.read.parquet(a.observed), as_of, a.days)
    written = [write_climate(indices, a.out, start, end)]
    if a.log:
        daily = read_newest_climate(spark, f"{a.out}/climate_data")
        insights = climate_correlation(read_log(spark, a.log), daily)
        written.append(
            write_document(
                correlation_document(insights), a.out, "vegetation_climate_correlation", now
            )
        )
    return written


main = job(run)


if __name__ == "__main__":
    main()
