import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from verdance.session import get_session

    session = get_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.sql.maxMetadataStringLength": "100000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log_of(spark):
    """Log rows from (aoi, [values]) with one entry per month, or explicit dates."""
    import datetime as dt

    from verdance import schemas

    def build(series: dict, dates=None):
        rows = []
        for aoi, values in series.items():
            for i, v in enumerate(values):
                day = dates[i] if dates else dt.date(2020 + i // 12, i % 12 + 1, 1)
                health = "Good" if v > 0.3 else "Poor"
                rows.append((aoi, f"{aoi}_{i}", day, float(v), health, i))
        return spark.createDataFrame(rows, schemas.VEGLOG)

    return build
