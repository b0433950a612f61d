"""What moves between tasks: station-days before they are placed or listed under windows, cell-days once."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.operators import calibrate as cb, rasters as ra, stations as st
from skygrid.params import WINDOW_DAYS
from skygrid.sources import adapters as ad
from tests.test_method import OBS, stations
from tests.test_placement import nodes

BOXES = [(k, 300000.0 * k, 300000.0 * k + 60000.0, 0.0, 60000.0, 5) for k in range(3)] + [(9, 30000.0, 90000.0, 0.0, 60000.0, 5)]


@pytest.fixture
def fixed_plan(spark):
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", kept)


def moved(df):
    """Column names of each exchange but broadcasts."""
    found = []
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange":
            out = node.output()
            found.append({out.apply(i).name() for i in range(out.length())})
    return found


def observed(spark):
    rows = []
    for k in range(24):
        for d in range(k % 5, 90, 1 + k % 7):
            # Every sixth station moves to another partition; others change their height; places and days may be missing.
            x = 2e4 + 300000.0 * (k % 3) + (300000.0 if k % 6 == 5 and d > 20 else 0.0)
            rows.append((f"S{k}", date(2024, 1, 1) + timedelta(d), x if (k, d) != (3, 6) else None, 1e4 * (k % 4), 10.0 * k + d // 30, float(d % 4)))
    more = [("S77", None, 2e4, 0.0, 5.0, 1.0), (None, date(2024, 1, 5), 2e4, 0.0, 6.0, 2.0), (None, date(2024, 1, 9), 2e4, 0.0, 7.0, None), ("S99", date(2024, 1, 3), None, 0.0, 1.0, 1.0)]
    obs = spark.createDataFrame(rows + rows[:7] + more, "stationID string, dates date, x double, y double, elevation double, Precipitation double")
    return obs.withColumns({"slope": F.col("elevation") / 7, "aspect": F.col("elevation") + 1})


def same(a, b):
    assert a.count() and sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))


def test_latest_attributes_are_found_before_stations_are_placed(spark, fixed_plan, monkeypatch):
    obs = observed(spark)
    boxes = spark.createDataFrame(BOXES, "i_step int, xmin double, xmax double, ymin double, ymax double, topo_ncells long")
    same(st.latest_in_partitions(obs, boxes, ["stationID"]), st.latest_attributes(st.stations_in_partitions(obs, boxes), ["i_step", "stationID"]))
    wanted = spark.createDataFrame([(date(2024, 1, 1) + timedelta(k),) for k in range(0, 90, 12)], "date_fin date")
    windows = st.window_dates(obs, wanted)
    frames = st.latest_in_partitions(windows, boxes, ["date_fin", "stationID"])
    same(frames, st.latest_attributes(st.stations_in_partitions(windows, boxes), ["date_fin", "i_step", "stationID"]))
    # Only rows of stations that went elsewhere are moved once they are under partitions.
    plain, seen = st.latest_attributes, []
    monkeypatch.setattr(st, "latest_attributes", lambda rows, keys: seen.append(rows) or plain(rows, keys))
    assert len([m for m in moved(st.latest_in_partitions(obs, boxes, ["stationID"])) if {"i_step", "stationID"} <= m]) == 1
    assert {r.stationID for r in seen[0].select("stationID").distinct().collect()} == {f"S{k}" for k in range(5, 24, 6)}


def test_distinct_stations_of_windows_are_counted_without_a_row_per_station(spark, fixed_plan):
    obs = observed(spark)
    wanted = obs.select(F.date_add("dates", 3).alias("date_fin"))
    for days in (WINDOW_DAYS, 4):
        plain = st.window_dates(obs, wanted, days).groupBy("date_fin").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("stationID").alias("stations"))
        got = st.window_dates(st.with_last_seen(obs), wanted, days).groupBy("date_fin").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(st.first_in_window(days)).alias("stations"))
        same(got, plain)
        assert not [m for m in moved(got) if {"date_fin", "stationID"} <= m]


def test_block_means_of_points_that_move_once(spark, fixed_plan):
    rng = np.random.default_rng(1)
    rows = [(date(2024, 1, 1) + timedelta(int(rng.integers(3))), k, float(rng.uniform(-10, 210)), float(rng.uniform(-10, 210)),
             float(rng.normal()) if rng.random() > .3 else None, None if k % 2 else 1.0 * k) for k in range(900)]
    cells = spark.createDataFrame(rows, "dates date, cell_id long, x double, y double, a double, b double")
    raster = ra.Raster(0.0, 200.0, 10.0, 20, 20)
    got, long = ra.rasterize_blocks(cells, raster, 4, ("a", "b")), ra.rasterize(cells, raster, ("a", "b"))
    last = {}
    for d, k, x, y, a, b in rows:
        if 0 <= x < 200 and 0 < y <= 200:
            last[d, int((200 - y) // 10), int(x // 10)] = (a, b)
    assert {(r.dates, r.row, r.col, r["var"]): r.value for r in long.collect()} == {(*k, v): w for k, pair in last.items() for v, w in zip("ab", pair)}
    want = {(r.dates, r["var"], r.row, r.col): r.value for r in ra.block_mean(long, 4).collect()}
    found = {(r.dates, r["var"], r.row, r.col): r.value for r in got.collect()}
    assert found.keys() == want.keys() and all(v == pytest.approx(want[k]) if v is not None else want[k] is None for k, v in found.items())
    assert len(moved(got)) == 1


def test_cell_days_meet_their_cells_where_they_are_made(spark, fixed_plan, tmp_path):
    lines = [(k % 13, k % 5, 1 + k % 7, 1.0 + k, 0.01 * (k % 9), 0.01 * (k % 4), "NAR"[k % 3], f"2024-01-{1 + k % 9:02d} 00:00:00") for k in range(400)]
    names = "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, t string"
    spark.createDataFrame(lines, names).withColumn("l_shipdate", F.to_timestamp("t")).write.parquet(f"{tmp_path}/lineitem.parquet")
    days = ad.interpolated(spark, str(tmp_path))
    cells = spark.range(13).withColumnRenamed("id", "cell_id").hint("merge")
    both = days.join(cells, "cell_id")
    least = {}
    for part, _, _, quantity, *_, day in lines:
        least[part, day[:10]] = min(quantity, least.get((part, day[:10]), quantity))
    assert {(r.cell_id, str(r.dates)): r.MinTemperature for r in both.collect()} == {k: pytest.approx(v / 2 - 5) for k, v in least.items()}
    assert len([m for m in moved(both) if "dates" in m]) == 1


def test_station_sets_hold_each_station_once_and_only_what_is_used(spark):
    obs = spark.createDataFrame(stations(600, 1), OBS)
    sets = cb._station_sets(obs, ["dates", "i_step"], {"MaxTemperature": "s_tmax"}, cb.DEFAULTS)
    assert sets.count() == 600 and not {"s_tmin", "s_tdew", "s_event", "s_amount"} & set(sets.columns)
    found = cb.predictions_table(obs, ["dates", "i_step"], {"MaxTemperature": ((30.0, 3.0),)})
    assert found.count() == 600 and found.where("pred is null").count() == 0
