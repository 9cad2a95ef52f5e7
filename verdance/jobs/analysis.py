"""Trend report and analytics of a stored log.

    python -m verdance.jobs.analysis --log L --out O [--aoi-id ID]
"""

from __future__ import annotations

import argparse
import datetime as dt

from verdance.jobs.entry import job
from verdance.operators.anomalies import analytics_document
from verdance.plans.workflows import analyze_log
from verdance.session import get_session
from verdance.sinks.files import write_document, write_trends
from verdance.sources.files import read_log


def run(argv: list[str] | None = None) -> list[str]:
    p = argparse.ArgumentParser()
    p.add_argument("--log", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--aoi-id")
    a = p.parse_args(argv)
    spark = get_session("analysis")
    now = dt.datetime.now()
    tables = analyze_log(read_log(spark, a.log, a.aoi_id))
    return [
        write_trends(tables["trends"], a.out),
        write_document(
            analytics_document(tables["analytics"], now), a.out, "advanced_analytics", now
        ),
    ]


main = job(run)


if __name__ == "__main__":
    main()
