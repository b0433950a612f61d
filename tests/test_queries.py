"""Registered queries against plain SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences, frame

SF = "/root/testdata/sf0.001"
# A query per area; tests/compare.py runs them all.
NAMES = [
    "half_month_window", "date_spine", "month_spine", "availability_guard", "select_by_pattern", "mask_dead_sensors",
    "in_list_filter", "merge_small_partitions", "crs_transform", "wkt_edges", "point_in_polygon", "raster_mosaic",
    "terrain", "rasterize_layers", "bitmap_rows", "geohash", "multi_bbox_query_or", "join_station_partition", "join_window",
    "window_station_count", "admin_rollup", "union_stats", "argmin_params", "chunk_by_rows", "latest_station_attrs",
    "build_interpolator", "estimate_radius", "interp_temperature", "interp_precip_amount", "radiation", "pet", "loo_predictions", "polygon_area_topk",
    "histogram_1d", "histogram_2d", "station_count", "last_stat_row", "cv_stats",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert len(got)
    assert differences(got, frame(con, entry.oracle_sql()[name])) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["rid", "dates", "n", "MinTemperature"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
