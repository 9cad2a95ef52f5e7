"""Tables of the dashboard from a stored log and, if given, daily climate.

    python -m verdance.jobs.dashboard --log L --out O [--aoi-id ID] [--climate DAILY]
"""

from __future__ import annotations

import argparse

from verdance.jobs.entry import job
from verdance.operators.correlation import climate_insights, climate_join
from verdance.operators.dashboard import climate_panels, dashboard_tables
from verdance.session import get_session, materialise
from verdance.sources.files import read_log


def run(argv: list[str] | None = None) -> list[str]:
    """Writes one table per panel below ``dashboard``; returns their paths."""
    p = argparse.ArgumentParser()
    p.add_argument("--log", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--aoi-id")
    p.add_argument("--climate")
    a = p.parse_args(argv)
    spark = get_session("dashboard")
    log = materialise(read_log(spark, a.log, a.aoi_id), "log")
    tables = dashboard_tables(log)
    if a.climate:
        tables |= climate_panels(climate_insights(climate_join(log, spark.read.parquet(a.climate))))
    paths = []
    for name, table in tables.items():
        paths.append(f"{a.out}/dashboard/{name}")
        table.write.mode("overwrite").parquet(paths[-1])
    return paths


main = job(run)


if __name__ == "__main__":
    main()
