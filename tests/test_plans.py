"""Plans that must hold at any size: pushed filters, pruned columns, no task that gets all rows, no joins of all pairs."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from tessaria import plans

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the test tables")
#: Queries whose last step joins a single row, or numbers a row for each range.
SINGLE_ROW = {"stats_category_pct", "stats_size_bins", "stats_state_top3", "stats_border", "stats_area_summary", "stats_richness", "prefix_join_first"}


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "100000")
    yield
    spark.conf.set(name, before)


def plan(spark, name):
    return plans.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["filter_eq", "filter_in_list", "filter_between", "filter_date_range", "filter_conjunction", "get_by_id", "filter_then_sample", "page_keyset"])
def test_filters_are_pushed(spark, name):
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(spark, name))
    assert any(re.search(r"EqualTo|In\(|Greater|Less|Or\(", p) for p in pushed), pushed


@pytest.mark.parametrize("name, columns", [("project_columns", 3), ("sort_default", 3), ("count_by_group", 2), ("distinct_images", 1), ("semi_join_images", 9)])
def test_columns_are_pruned(spark, name, columns):
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name)):
        assert len(schema.split(",")) <= columns


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_no_joins_of_all_pairs(spark, name):
    if name in SINGLE_ROW or name.startswith(("stream_", "spec_", "mask_parts", "sink_", "reload_", "manifest_", "image_", "list_", "file_", "species_dim", "coco_explode")):
        pytest.skip("joins a single row, or is made of several jobs")
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, text[:2000]


@pytest.mark.parametrize("name", sorted(n for n in plans.QUERIES if n.startswith(("stats_", "sample_", "sort_", "frame_", "split_", "global_", "dedupe_"))))
def test_no_window_over_all_rows(spark, name):
    """A window without partition stands above counts by range alone, which are a row for each range."""
    lines = plan(spark, name).splitlines()
    for k, line in enumerate(lines):
        m = re.search(r"Window \[(.*?)windowspecdefinition\(([^)]*)\)", line)
        if m and "__part" not in line and not re.search(r"\], \[[a-z_]", line, re.I):
            raise AssertionError(line)
