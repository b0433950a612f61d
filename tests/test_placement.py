"""Cell-days stay where they are made, whether or not cells are small enough to be broadcast."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skygrid.operators import interpolate as ip
from skygrid.sources import tables
from tests.test_method import OBS, stations


@pytest.fixture
def no_broadcast(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.length()):
        yield from nodes(children.apply(i))


def moved_cell_days(df):
    """Exchanges whose rows have both a date and a cell."""
    found = []
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange":
            out = node.output()
            names = {out.apply(i).name() for i in range(out.length())}
            if {"dates", "cell_id"} <= names:
                found.append(names)
    return found


def grid_and_stations(spark):
    obs = spark.createDataFrame(stations(20, 12), OBS)
    topo = spark.createDataFrame(
        [(k, k % 2, 4e5 + 2500.0 * k, 42e5 + 2500.0 * k, 40.0 * k, 5.0, 90.0, 1.0 * k) for k in range(40)],
        "cell_id long, partition int, x double, y double, elevation double, slope double, aspect double, TPI double")
    return topo, obs


def test_cell_days_are_not_shuffled(spark, no_broadcast, monkeypatch):
    topo, obs = grid_and_stations(spark)
    monkeypatch.setattr(ip.nb, "ROWS_PER_CHUNK", 7)
    placed = ip.finish_cells(ip.interpolate(topo, obs), topo, days=obs)
    assert moved_cell_days(placed) == []
    # Without the days, the join with the terrain moves them: the measure sees it.
    plain = ip.finish_cells(ip.interpolate(topo, obs), topo)
    assert len(moved_cell_days(plain)) == 1
    assert placed.columns == plain.columns
    a, b = (sorted(map(tuple, df.drop("geom_text", "geom_hex").collect())) for df in (placed, plain))
    assert len(a) == 40 * 12 and a == [pytest.approx(r) for r in b]


def test_write_makes_cell_days_once(spark, tmp_path):
    topo, obs = grid_and_stations(spark)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    cells = ip.finish_cells(ip.interpolate(topo, obs), topo, days=obs).drop("day", "month", "year")
    tables.write_interpolated(cells.mapInArrow(counted, cells.schema), str(tmp_path / "cells"), 100, 150)
    back = spark.read.parquet(str(tmp_path / "cells"))
    assert back.count() == seen.value == 40 * 12
    days = back.groupBy("year", "month", "day").agg(F.count_distinct("dates").alias("n"), F.min("dates").alias("d")).collect()
    assert len(days) == 12 and all(r.n == 1 for r in days) and min(r.d for r in days) == date(2024, 5, 1) and max(r.d for r in days) == date(2024, 5, 1) + timedelta(11)
