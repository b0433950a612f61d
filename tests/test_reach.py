"""Sums of cells as arrays against sums over joined pairs."""

from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skygrid.operators import interpolate as ip, neighbours as nb, reach as rc
from tests.test_method import OBS, stations
from tests.test_placement import nodes

KEYS = ["dates", "i_step", "chunk", "slice"]


def tables(spark):
    rows = [list(r) for r in stations(24, 5)]
    names = [f.split()[0] for f in OBS.split(", ")]
    # Missing values, a station without a height, one without a place, and a row twice.
    for c, k in (("DewTemperature", 3), ("Precipitation", 5), ("elevation", 7), ("x", 11)):
        for r in rows[k::13]:
            r[names.index(c)] = None
    obs = spark.createDataFrame([*rows, rows[20]], OBS)
    cells = [(k, k % 2, 4e5 + 7000.0 * k, 42e5 + 1500.0 * k, 40.0 * k, 5.0, 90.0, 1.0 * k) for k in range(30)]
    topo = spark.createDataFrame([*cells, cells[4], cells[4]], "cell_id long, partition int, x double, y double, elevation double, slope double, aspect double, TPI double")
    return topo, obs


def joined(topo, obs, params, variables):
    """The same from a join of every cell-day with its sources."""
    sources = ip.as_sources(obs, ["dates", "i_step"]).withColumns({"chunk": F.lit(0), "slice": F.lit(0)})
    days = params if params is not None else obs.select("dates", "i_step").distinct()
    days = days.join(ip.rain_slopes(ip.as_sources(obs, ["dates", "i_step"]), ["dates", "i_step"]), ["dates", "i_step"], "left")
    cells = topo.select(F.col("partition").alias("i_step"), "cell_id", "x", "y", (F.col("elevation") / 1000.0).alias("z"))
    targets = days.join(cells, "i_step").withColumns({"chunk": F.lit(0), "slice": F.lit(0)})
    smoothing = ip.fixed_smoothing(variables) if params is None else ip.column_smoothing(variables)
    return ip.weighted_moments(targets, sources, KEYS, [*KEYS, "cell_id"], list(variables), smoothing)


@pytest.mark.parametrize("chosen", [False, True])
def test_same_as_joined_pairs(spark, chosen):
    topo, obs = tables(spark)
    variables = tuple(ip.SOURCE_VALUES)
    params = None
    if chosen:
        params = obs.select("dates", "i_step").distinct().where(F.col("dates") != obs.agg(F.max("dates")).first()[0])
        n = F.dayofmonth("dates").cast("double")
        params = params.withColumns({f"n_{v}": 3.0 + n + k for k, v in enumerate(variables)} | {f"alpha_{v}": F.lit(2.0 + k) for k, v in enumerate(variables)})
    got, want = ip.interpolate(topo, obs, params, variables), joined(topo, obs, params, variables)
    names = ["dates", "i_step", "cell_id", "x", "y", "z", *[c for c in want.columns if c[:2] in ("w_", "c_", "wz", "wt", "wu", "wv")]]
    a, b = ({tuple(r)[:3]: tuple(r)[3:] for r in df.select(*names).collect()} for df in (got, want))
    assert a.keys() == b.keys() and len(a) == got.count() == 30 * (4 if chosen else 5)
    for k, v in b.items():
        assert a[k] == pytest.approx(v, rel=1e-8, abs=1e-9), k


def test_pairs_are_not_rows(spark):
    topo, obs = tables(spark)
    found = []
    for node in nodes(ip.interpolate(topo, obs)._jdf.queryExecution().sparkPlan()):
        out = node.output()
        if {"sx", "cell_id"} <= {out.apply(i).name() for i in range(out.length())}:
            found.append(node.nodeName())
    assert found == []


def test_no_sources_and_radius_of_rows_that_repeat(spark):
    targets = spark.createDataFrame([(1, 0, 7, 0.0, 0.0), (1, 0, 7, 0.0, 0.0), (1, 0, 8, 0.0, 1000.0), (2, 0, 9, 0.0, 0.0)], "i_step int, chunk int, cell_id long, x double, y double")
    sources = spark.createDataFrame([(1, 0, 3000.0 * k, 0.0, 1.0 if k else None) for k in range(40)], "i_step int, chunk int, sx double, sy double, s_tmin double")
    got = nb.estimate_radii(targets, sources, ["i_step", "chunk"], ["i_step", "chunk", "cell_id"], {"MinTemperature": "s_tmin"}, ip.fixed_smoothing(["MinTemperature"]))
    r2 = {r.cell_id: r.rp2_MinTemperature for r in got.collect()}
    assert got.columns == [*targets.columns, "rp2_MinTemperature"] and sorted(r2) == [7, 8, 9]
    assert r2[9] == 140000.0**2 and 0 < r2[8] < 140000.0**2 and r2[7] != pytest.approx(r2[8], rel=1e-3)


def test_every_row_of_a_cell_is_published(spark):
    topo, obs = tables(spark)
    moments = ip.interpolate(topo, obs)
    placed, plain = (ip.finish_cells(moments, topo, days=days).drop("geom_hex", "geom_text") for days in (obs, None))
    a, b = (sorted(df.collect(), key=lambda r: (r.dates, r.cell_id)) for df in (placed, plain))
    assert placed.columns == plain.columns and len(a) == len(b) == 32 * 5
    for x, y in zip(a, b):
        assert tuple(x) == pytest.approx(tuple(y))


def test_near_stations_like_their_pairs(spark, monkeypatch):
    """Counts, least and mean distances without a row per pair, in blocks smaller than a chunk."""
    monkeypatch.setattr("skygrid.operators.reach.MOST", 64)
    cells = [(k, k % 3, k % 2, 7.0 * k, 5.0 * (k % 7)) for k in range(60)]
    targets = spark.createDataFrame(
        [*cells, cells[4], (None, 0, 0, 50.0, 9.0), (100, 0, 0, None, 9.0), (101, 0, 0, 9e9, 0.0), (102, 8, 0, 1.0, 1.0)],
        "cell_id long, i_step int, chunk int, x double, y double")
    sources = spark.createDataFrame(
        [(f"s{k % 19}" if k % 5 else None, k % 3, k % 2, 11.0 * (k % 31), 4.0 * (k % 9)) for k in range(80)]
        + [("far", 0, 0, None, 1.0), ("nan", 0, 0, float("nan"), 1.0), ("alone", 9, 0, 1.0, 1.0)], "s_id string, i_step int, chunk int, sx double, sy double")
    r, keys = F.sqrt("r2"), ["i_step", "chunk"]
    want = nb.near_pairs(targets, sources, keys, F.lit(55.0**2)).groupBy("cell_id").agg(
        F.count("s_id").alias("n"), F.min(r).alias("nearest"), F.avg(r).alias("mean_r"))
    found = nb.near_stations(targets, sources, keys, "cell_id", "s_id", 55.0)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    got, want = ({x.cell_id: tuple(x)[1:] for x in df.collect()} for df in (found, want))
    assert got.keys() == want.keys() and got[102] == (0, None, None) and got[101] == (0, None, None)
    for k, row in want.items():
        assert got[k] == pytest.approx(row, abs=1e-9), k


def test_passes_look_near_the_block(monkeypatch):
    """Of the sources of a day only those near a block of targets are looked at again; before, all of them were."""
    class Counted:
        n = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def take(self, a, indices, axis=None, **kwargs):
            Counted.n += len(a) * len(indices)
            return np.take(a, indices, axis=axis, **kwargs)

    rng = np.random.default_rng(4)
    size, own, days = 700, 900, 3
    x, y, z = 3e5 + rng.uniform(0, 3e4, size), 41e5 + rng.uniform(0, 3e4, size), rng.uniform(0, 1, size)
    cells = pa.table({"cell_id": np.arange(size), "x": x, "y": y, "z": z})
    sx, sy = 3e5 + rng.uniform(-1e5, 13e4, own), 41e5 + rng.uniform(-1e5, 13e4, own)
    u, v = rng.normal(0, 3, (days, own)), rng.normal(0, 3, (days, own))
    dates = pa.array(np.repeat(np.arange(days, dtype=np.int32), own)).cast(pa.date32())
    sources = pa.table({"dates": dates, "is_day": [False] * own * days, "sx": np.tile(sx, days), "sy": np.tile(sy, days), "sz": [0.5] * own * days, "s_u": u.ravel(), "s_v": v.ravel()})
    heads = pa.table({"dates": pa.array(np.arange(days, dtype=np.int32)).cast(pa.date32()), "is_day": [True] * days})
    names = ["dates", "cell_id", *rc.sum_names(["Wind"])]
    kinds = {n: pa.date32() if n == "dates" else pa.int64() if n == "cell_id" else pa.float64() for n in names}
    n, alpha, start, passes = 5.0, 3.0, 140000.0, 3
    work = rc.place_sums(["Wind"], {"Wind": "s_u"}, {"Wind": (n, alpha)}, {"radius": start, "passes": passes, "max_f": 0.6}, names, kinds)
    monkeypatch.setattr(rc, "np", Counted())
    got = work(cells, pa.concat_tables([sources, heads], promote_options="default")).sort_by([("dates", "ascending"), ("cell_id", "ascending")])
    assert 0 < Counted.n < size * own * days / 2
    r2 = (x[:, None] - sx) ** 2 + (y[:, None] - sy) ** 2
    rp2 = np.full(size, start**2)
    for k in range(passes + 1):
        w = np.where(r2 <= rp2[:, None], np.exp(-alpha * r2 / rp2[:, None]) - np.exp(-alpha), 0.0)
        mean = (1 - np.exp(-alpha)) / alpha - np.exp(-alpha)
        rp2 = np.where(w.sum(axis=1) > 0, (1 if k == passes - 1 else 2) * n * mean * rp2 / w.sum(axis=1), rp2)
    for name, want in (("w_Wind", np.tile(w.sum(axis=1), days)), ("wu_Wind", (u @ w.T).ravel()), ("wv_Wind", (v @ w.T).ravel())):
        assert np.allclose(got.column(name).to_numpy(), want, rtol=1e-8, atol=1e-9), name
