"""Shapes of physical plans that matter at scale."""

import contextlib
import io
import re

import pytest

from tests.conftest import SMALL
from verdance.registry import QUERIES

STREAMS = {n for n in QUERIES if n.endswith(("_stream", "_state", "_late", "_batches"))}


# running totals over the days of the calendar, and final merges of global aggregates
CALENDAR = {"climate_indices", "climate_gaps", "climate_by_year", "calendar_gaps", "climate_stored",
            "climate_correlation", "strong_correlations", "stress_impact", "join_overview", "quality_row",
            "ndvi_training_rows", "ndvi_training_rows_nearest", "seasonal_baseline", "daily_climate"}
MERGED = {"climate_summary", "climate_correlation_overall"}


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def scans(plan):
    return re.findall(r"FileScan parquet \[.*?Location: InMemoryFileIndex\(\d+ paths\)\[(.*?)\]", plan)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS - {"ndvi_regression"}))
def test_no_quadratic_join_and_one_scan_of_the_tables(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert sum("lineitem" in s for s in scans(plan)) <= 1


@pytest.mark.parametrize("name", ["rolling_last20", "best_scene_per_period", "best_scene_per_month", "recent_vs_historical"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["scene_stats", "aoi_clip_counts", "log_overview"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "partial_" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("name", ["trend", "trend_line", "log_positions"])
def test_entries_are_ranked_inside_blocks_only(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    ranked = re.findall(r"Window \[row_number\(\) windowspecdefinition\((.*?), specifiedwindowframe", plan)
    assert ranked and all("_block" in r or "scene_date" in r for r in ranked)


def test_every_window_has_a_key_or_one_row_per_month(spark):
    for name in sorted(set(QUERIES) - STREAMS - {"ndvi_regression"}):
        plan = plan_of(QUERIES[name](spark, SMALL))
        for keys in re.findall(r"Window \[.*?\], \[(.*?)\](?:, \[(?:.*?)\])?\n", plan):
            # without a key there is one row per month of the calendar
            assert "#" in keys, (name, keys)
        if "SinglePartition" in plan:
            assert name in CALENDAR or name in MERGED, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["scene_lookup"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,1001)]" in plan
    search = plan_of(QUERIES["scene_search"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in search and "LessThan(o_orderdate" in search
    stats = plan_of(QUERIES["log_overview"](spark, SMALL))
    schema = re.search(r"ReadSchema: struct<(.*?)>", stats).group(1)
    assert "l_comment" not in schema and "l_discount" not in schema


def test_clip_of_a_stored_pixel_table_is_pushed_down(spark, tmp_path):
    from pyspark.sql import functions as F

    from verdance.operators import pixels as P
    from verdance.sources import driver_tables as D

    path = str(tmp_path / "pixels")
    D.pixels(spark, SMALL).withColumn("scene_id", F.lit("s")).write.parquet(path)
    plan = plan_of(P.scene_stats(P.clip(spark.read.parquet(path))))
    assert "GreaterThanOrEqual(lon,55.742)" in plan and "LessThanOrEqual(lat,24.21)" in plan
