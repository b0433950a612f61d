"""Stations of windows, counted per set of partitions, and what is written of placed stations."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from skygrid.operators import calibrate as cb, stations as st
from skygrid.sources import tables

BOXES = [(k, 300000.0 * k, 300000.0 * k + 60000.0, 0.0, 60000.0, 5) for k in range(3)] + [(9, 30000.0, 90000.0, 0.0, 60000.0, 5)]


def observed(spark):
    rows = []
    for k in range(24):
        for d in range(k % 5, 60, 1 + k % 7):
            # Every sixth station moves to another partition, and one leaves all of them for some days.
            x = 2e4 + 300000.0 * (k % 3) + (300000.0 if k % 6 == 5 and d > 20 else 0.0) + (1e7 if k == 4 and 10 < d < 30 else 0.0)
            rows.append((f"S{k}", date(2024, 1, 1) + timedelta(d), x, 1e4 * (k % 4)))
    return spark.createDataFrame(rows + rows[:7] + [("S99", date(2024, 1, 3), None, 0.0)], "stationID string, dates date, x double, y double")


def test_counts_per_set_are_those_of_placed_stations(spark):
    obs = observed(spark)
    boxes = spark.createDataFrame(BOXES, "i_step int, xmin double, xmax double, ymin double, ymax double, topo_ncells long")
    wanted = spark.createDataFrame([(date(2024, 1, 1) + timedelta(k),) for k in range(0, 90, 2)], "date_fin date")
    placed = st.stations_in_partitions(obs, boxes)
    want = cb.window_frames(placed, wanted, 17).join(
        placed.select("i_step", "stationID", "dates"), "i_step").where("dates between date_sub(date_fin, 16) and date_fin").groupBy("date_fin", "i_step").agg(
        F.count_distinct("stationID").alias("n_stations"))
    got = cb.station_counts_in(obs, boxes, wanted, 17)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 100


def test_station_days_move_before_they_are_placed(spark, tmp_path):
    obs = observed(spark).withColumnRenamed("dates", "date_fin")
    boxes = spark.createDataFrame(BOXES, "i_step int, xmin double, xmax double, ymin double, ymax double, topo_ncells long")
    params = spark.createDataFrame([(date(2024, 1, 2), 1, 0.5)], "date_fin date, i_step int, tmin_n double")
    moved = []

    def place(days):
        moved.append(days.count())
        return st.stations_in_partitions(days, boxes)

    tables.store_interpolator(obs, params, str(tmp_path / "placed"), place=place)
    tables.store_interpolator(st.stations_in_partitions(obs, boxes), params, str(tmp_path / "plain"))
    a, b = (tables.load_interpolator(spark, str(tmp_path / n)) for n in ("placed", "plain"))
    for x, y in zip(a, b):
        assert x.count() and sorted(map(str, x.select(sorted(x.columns)).collect())) == sorted(map(str, y.select(sorted(y.columns)).collect()))
    assert moved == [obs.count()] and a[0].count() > moved[0]


def test_raw_days_are_made_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    obs = observed(spark)
    tables.write_raw(obs.mapInArrow(counted, obs.schema), str(tmp_path / "raw"))
    assert seen.value == obs.count() == spark.read.parquet(str(tmp_path / "raw")).count()
