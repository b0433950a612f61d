"""Known answers, brute force and traps."""

import base64
import math
import struct
import zlib
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.functions import calendar as cal, color, geo, weather
from skygrid.operators import bitmaps as bm, calibrate as cb, grid, interpolate as ip, neighbours as nb
from skygrid.operators import rasters as ra, regions as rg, stations as st, validate as va
from skygrid.params import BITMAP_RAMP, CALIBRATED, DAILY_GRID, DEFAULTS, STUDY_GRID


def one(df):
    return df.collect()[0]


def test_grid_sizes():
    assert sum(len(v) for v in DAILY_GRID.values()) == 139
    assert sum(len(v) for v in STUDY_GRID.values()) == 825


def test_projection(spark):
    df = spark.createDataFrame([(-3.0, 40.0), (-8.9, 43.2), (4.2, 36.1)], "lon double, lat double")
    x, y = geo.lonlat_to_xy(F.col("lon"), F.col("lat"))
    lon, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    rows = df.select("*", x.alias("x"), y.alias("y")).select("*", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert rows[0].x == pytest.approx(500000.0, abs=1e-6)
    assert rows[0].y == pytest.approx(4427757.219, abs=0.01)
    for r in rows:
        assert r.lon2 == pytest.approx(r.lon, abs=1e-9) and r.lat2 == pytest.approx(r.lat, abs=1e-9)


def test_wkb(spark):
    points = [(300137.25, 4100137.5), (-0.1, 1e-3), (0.0, -123456.789), (2.0**40, 1.0), (3.9999999999999996, 1023.9999999999999)]
    df = spark.createDataFrame(points, "x double, y double")
    for r in df.select("x", "y", geo.point_wkb_hex(F.col("x"), F.col("y")).alias("h")).collect():
        assert r.h == struct.pack("<BIdd", 1, 1, r.x, r.y).hex().upper()


def test_weight_ends(spark):
    a = 3.0
    df = spark.createDataFrame([(0.0,), (1.0,), (1.1,)], "r2 double")
    w = [r.w for r in df.select(nb.gaussian_weight(F.col("r2"), F.lit(1.0), F.lit(a)).alias("w")).collect()]
    assert w == pytest.approx([1 - math.exp(-a), 0.0, 0.0])


def test_humidity_and_means(spark):
    r = one(spark.range(1).select(
        weather.relative_humidity(F.lit(11.0), F.lit(11.0)).alias("rh"),
        weather.dew_point(F.lit(20.0), F.lit(100.0)).alias("td"),
        weather.mean_temperature(F.lit(0.0), F.lit(10.0)).alias("tm")))
    assert (r.rh, r.td, r.tm) == pytest.approx((100.0, 20.0, 6.06))


def test_flat_slope_gets_flat_radiation(spark):
    lat, doy = F.lit(math.radians(-20.0)), F.lit(246.0)
    r = one(spark.range(1).select(
        weather.flat_radiation(lat, doy).alias("ra"),
        weather.slope_radiation(lat, doy, F.lit(0.0), F.lit(0.0)).alias("rs")))
    # FAO-56 example 8: 32.2 MJ per m2 and day on 3 September at 20 degrees south.
    assert r.ra == pytest.approx(32.2, abs=0.1) and r.rs == pytest.approx(r.ra, rel=1e-9)


def test_tilted_plane(spark):
    rows = [(r, c, 100.0 - 10.0 * c) for r in range(4) for c in range(4)]
    out = grid.terrain(spark.createDataFrame(rows, "row long, col long, value double"), 10.0).filter("slope is not null").collect()
    assert len(out) == 4
    for t in out:  # falls to the east by 10 m in 10 m
        assert (t.slope, t.aspect, t.TPI) == pytest.approx((45.0, 90.0, 0.0))


def brute_radius(d2, n, alpha):
    rp2 = DEFAULTS.initial_radius_m**2
    for k in range(DEFAULTS.radius_passes):
        w = np.where(d2 <= rp2, np.exp(-alpha * d2 / rp2) - math.exp(-alpha), 0.0).sum()
        if w > 0:
            bar = (1 - math.exp(-alpha)) / alpha - math.exp(-alpha)
            rp2 = (n if k == 2 else 2 * n) / (w / bar / (math.pi * rp2)) / math.pi
    return rp2


def stations(n=60, days=3, seed=5, slope=-6.5):
    rng = np.random.default_rng(seed)
    out = []
    for s in range(n):
        x, y, z = 4e5 + rng.uniform(0, 1.2e5), 42e5 + rng.uniform(0, 1.2e5), float(rng.uniform(0, 2000))
        for d in range(days):
            t = 12.0 + d + slope * z / 1000
            out.append((date(2024, 5, 1) + timedelta(d), s % 2, f"S{s}", x, y, z, t, t + 8.0, t - 2.0,
                        float(max(0.0, rng.normal(1, 3))), 3.0, 90.0))
    return out


OBS = ("dates date, i_step int, stationID string, x double, y double, elevation double, MinTemperature double, "
       "MaxTemperature double, DewTemperature double, Precipitation double, WindSpeed double, WindDirection double")


def test_linear_field_is_reproduced(spark):
    obs = spark.createDataFrame(stations(), OBS)
    topo = spark.createDataFrame(
        [(k, k % 2, 4e5 + 2500.0 * k, 42e5 + 2500.0 * k, 40.0 * k, 5.0, 90.0, 0.0) for k in range(40)],
        "cell_id long, partition int, x double, y double, elevation double, slope double, aspect double, TPI double")
    cells = ip.finish_cells(ip.interpolate(topo, obs), topo).collect()
    assert len(cells) == 40 * 3
    for c in cells:
        want = 12.0 + (c.dates - date(2024, 5, 1)).days - 6.5 * c.elevation / 1000
        assert c.MinTemperature == pytest.approx(want, abs=1e-6)
        assert c.ThermalAmplitude == pytest.approx(8.0, abs=1e-6)
        assert c.WindSpeed == pytest.approx(3.0) and c.WindDirection == pytest.approx(90.0)
        assert c.MaxRelativeHumidity >= c.MeanRelativeHumidity >= c.MinRelativeHumidity
        assert c.Precipitation >= 0 and c.PET >= 0 and c.Radiation >= 0


def test_full_daily_grid_against_brute_force(spark):
    rows = stations(24, 2, slope=0.0)
    rng = np.random.default_rng(1)
    rows = [r[:6] + (float(rng.normal(10, 4)),) + r[7:] for r in rows]
    got = {
        (r.dates, r.i_step, r.N, r.alpha): (r.n_obs, r.sum_abs)
        for r in cb.error_table(
            spark.createDataFrame(rows, OBS), ["dates", "i_step"], {"MinTemperature": DAILY_GRID["MinTemperature"]}).collect()}
    assert len(got) == 4 * 40
    for (d, step, n, alpha), (count, sum_abs) in got.items():
        here = [r for r in rows if r[0] == d and r[1] == step]
        total = seen = 0
        for i, t in enumerate(here):
            others = here[:i] + here[i + 1:]
            d2 = np.array([(t[3] - o[3])**2 + (t[4] - o[4])**2 for o in others])
            rp2 = brute_radius(d2, n, alpha)
            w = np.where(d2 <= rp2, np.exp(-alpha * d2 / rp2) - math.exp(-alpha), 0.0)
            if not w.sum() > 0:
                continue
            dz = np.array([(o[5] - t[5]) / 1000 for o in others])
            v = np.array([o[6] for o in others])
            mz, mv = (w * dz).sum() / w.sum(), (w * v).sum() / w.sum()
            var = (w * dz * dz).sum() / w.sum() - mz * mz
            b = ((w * dz * v).sum() / w.sum() - mz * mv) / var if (w > 0).sum() >= 5 and var > 0.01 else 0.0
            total, seen = total + abs(mv - b * mz - t[6]), seen + 1
        assert (count, sum_abs) == (seen, pytest.approx(total, abs=1e-6))


@pytest.mark.parametrize("variable", ["DewTemperature", "PrecipitationEvent", "PrecipitationAmount"])
def test_array_passes_equal_joined_passes(spark, variable):
    """The kernel against the general interpolation, which works by joins, for two choices."""
    obs = spark.createDataFrame(stations(30, 2), OBS)
    pairs = ((10.0, 3.0), (20.0, 12.0))
    got = {(r.dates, r.i_step, r.stationID, r.N): r.pred for r in cb.loo_predictions(obs, ["dates", "i_step"], variable, pairs).collect()}
    keys = ["dates", "i_step", "chunk"]
    for n, alpha in pairs:
        sources = ip.as_sources(obs, ["dates", "i_step"]).withColumn("chunk", F.lit(0)).filter(F.col(ip.SOURCE_VALUES[variable]).isNotNull())
        targets = sources.select(*keys, F.col("s_id").alias("t_id"), F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("sz").alias("z"))
        if variable == "PrecipitationAmount":
            targets = targets.join(ip.rain_slopes(sources, ["dates", "i_step"]), ["dates", "i_step"])
        smooth = {variable: (F.lit(n), F.lit(alpha))}
        moments = ip.weighted_moments(targets, sources, keys, [*keys, "t_id"], [variable], smooth, ("t_id", "s_id"))
        rows = moments.select(*keys, "t_id", ip.predicted(variable).alias("pred")).collect()
        assert rows and len(rows) * len(pairs) == len(got)
        for r in rows:
            assert got[r.dates, r.i_step, r.t_id, n] == (None if r.pred is None else pytest.approx(r.pred, abs=1e-8))


def test_small_values_have_statistics(spark):
    rows = [(1, o, 0.9 * o) for o in (0.0, 1e-4, 2e-4, 3e-4, 4e-4)]
    r = one(va.cv_stats(spark.createDataFrame(rows, "k int, obs double, pred double"), ["k"]))
    assert r.r2 == pytest.approx(1.0) and r.relative_bias == pytest.approx(-0.1)
    sums = spark.createDataFrame(rows, "k int, obs double, pred double").groupBy("k").agg(*[F.sum(e).alias(n) for n, e in cb.error_sums().items()])
    assert one(sums.select(va.r2_column().alias("r2"))).r2 == pytest.approx(1.0)


def test_wkt_parts_and_holes(spark):
    wkt = "MULTIPOLYGON ((( 0 0, 40000  0, 40000 40000,0 40000, 0 0),(10000 10000, 20000 10000, 20000 20000, 10000 20000, 10000 10000)), ((0 0, 0 -5000, 5000 -5000, 5000 0, 0 0)))"
    edges = rg.wkt_edges(spark.createDataFrame([(1, wkt), (2, "POLYGON EMPTY"), (3, None)], "id int, wkt string"), "id")
    assert [(r.part, round(r.area_km, 6)) for r in rg.area_top(edges, "id", 10.0, 5).collect()] == [(0, 1500.0), (1, 25.0)]


def test_wkb_of_what_is_not_finite(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("inf"), 1.0), (1.0, None)], "x double, y double")
    assert [r.h for r in df.select(geo.point_wkb_hex(F.col("x"), F.col("y")).alias("h")).collect()] == [None] * 3


def test_rolled_calibration_equals_windows(spark, tmp_path):
    obs = spark.createDataFrame(stations(20, 20), OBS)
    small = {"MinTemperature": ((10.0, 3.0), (20.0, 10.0)), "PrecipitationEvent": ((5.0, 5.0), (10.0, 20.0))}
    wanted = obs.select(F.col("dates").alias("date_fin"))
    rolled = cb.calibrate(obs, wanted, small, str(tmp_path / "rows"), 5)
    frames = st.window_dates(obs, wanted, 5)
    exact = cb.calibrate_frames(frames, small)
    key = lambda r: (r.date_fin, r.i_step, r.variable)
    rows = [sorted(map(tuple, x.collect())) for x in (rolled, exact)]
    assert [r[:-1] for r in rows[0]] == [r[:-1] for r in rows[1]]
    assert [r[-1] for r in rows[0]] == pytest.approx([r[-1] for r in rows[1]], abs=1e-9)
    assert len({key(r) for r in exact.collect()}) == 20 * 2 * 2


def test_hot_group_is_split_without_change(spark, monkeypatch):
    obs = spark.createDataFrame(stations(30, 1), OBS)
    whole = cb.loo_predictions(obs, ["dates", "i_step"], "MaxTemperature").orderBy("stationID").collect()
    monkeypatch.setattr(cb, "STATIONS_PER_CHUNK", 4)
    split = cb.loo_predictions(obs, ["dates", "i_step"], "MaxTemperature").orderBy("stationID").collect()
    assert [r.pred for r in split] == pytest.approx([r.pred for r in whole], abs=1e-9)


def test_station_counts_of_windows(spark):
    days = [(date(2024, 1, d), 1, s) for d, s in ((1, "A"), (3, "A"), (3, "B"), (9, "A"), (10, "C"))]
    placed = spark.createDataFrame(days, "dates date, i_step int, stationID string")
    wanted = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 16)], "date_fin date")
    got = {r.date_fin.day: r.n_stations for r in cb.window_station_counts(placed, cb.window_frames(placed, wanted, 4), 4).collect()}
    want = {f: len({s for d, _, s in days if f - 3 <= d.day <= f}) for f in range(1, 16)}
    assert got == {f: n for f, n in want.items() if n}


def test_traps(spark):
    obs = spark.createDataFrame(
        [("A", None, 0.0, 10.0), ("A", None, 0.0, 20.0), ("B", 1.0, None, 30.0), ("C", 0.0, 2.0, 40.0)],
        "stationID string, Precipitation double, WindSpeed double, WindDirection double")
    masked = {r.stationID: r for r in st.mask_dead_sensors(obs, st.black_hole_sums(obs)).collect()}
    assert masked["A"].WindDirection is None and masked["A"].WindSpeed is None
    assert masked["B"].Precipitation == 1.0 and masked["B"].WindDirection is None
    assert masked["C"].Precipitation is None and masked["C"].WindDirection == 40.0
    scrubbed = one(st.normalize(spark.createDataFrame([(float("nan"), 4.0)], "Precipitation double, MinTemperature double")))
    assert scrubbed.Precipitation is None and scrubbed.MinTemperature == 4.0
    ids = spark.createDataFrame([("a/b_2024_3_16_170.nc",)], "p string").select(cal.interpolator_id(F.col("p")).alias("i"))
    assert one(ids).i == "170"


def test_multipolygon_with_hole(spark):
    wkt = "MULTIPOLYGON (((0 0, 40000 0, 40000 40000, 0 40000, 0 0), (10000 10000, 20000 10000, 20000 20000, 10000 20000, 10000 10000)), ((90000 0, 95000 0, 95000 5000, 90000 0)))"
    edges = rg.wkt_edges(spark.createDataFrame([(1, wkt)], "rid long, wkt string"), "rid")
    cells = spark.createDataFrame([(1, 5000.0, 5000.0), (2, 15000.0, 15000.0), (3, 94000.0, 1000.0), (4, 50000.0, 1000.0)], "cell_id long, x double, y double")
    assert {r.cell_id for r in rg.cells_in_regions(cells, edges, "rid").collect()} == {1, 3}


def decode_png(text):
    data = base64.b64decode(text.removeprefix("data:image/png;base64,"))
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, body, size = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at:at + 8])
        part = data[at + 8:at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n:at + 12 + n])[0] == zlib.crc32(kind + part)
        if kind == b"IHDR":
            size = struct.unpack(">II", part[:8])
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(size[1], 1 + 4 * size[0])
    assert not raw[:, 0].any()
    return raw[:, 1:].reshape(size[1], size[0], 4)


def test_colours_of_lab(spark):
    known = [(53.2408, 80.0925, 67.2032, "FF0000"), (100.0, 0.0, 0.0, "FFFFFF"), (0.0, 0.0, 0.0, "000000"), (50.0, 0.0, 0.0, "777777"), (87.7347, -86.1827, 83.1793, "00FF00")]
    df = spark.createDataFrame(known, "l double, a double, b double, want string")
    assert all(r.h == r.want for r in color.with_hex(df, ("l", "a", "b"), "h").collect())
    assert color.lab_of("#FF0000") == pytest.approx((53.2408, 80.0925, 67.2032), abs=1e-2)
    # The ramp's own colours stand at eighths of the range.
    cells = spark.createDataFrame([(date(2024, 1, 1), v, 0, k, float(k)) for v in ("PET", "WindSpeed") for k in range(9)], "dates date, var string, row long, col long, value double")
    got = {(r["var"], r["col"]): r["color"] for r in ra.colorize(cells).collect()}
    for k in range(9):
        assert got["PET", k] == BITMAP_RAMP[k] + "FF" and got["WindSpeed", 8 - k] == BITMAP_RAMP[k] + "FF"


def test_png_from_strips(spark):
    raster = ra.Raster(0.0, 50.0, 1.0, 50, 30)
    rng = np.random.default_rng(3)
    cells = [(date(2024, 1, 1), v, r, c, float(rng.integers(0, 999))) for v in ("PET", "MeanTemperature")
             for r in range(50) for c in range(30) if not 8 <= r < 24 and rng.random() < 0.5]
    colored = ra.colorize(spark.createDataFrame(cells, "dates date, var string, row long, col long, value double"))
    images = {r["var"]: decode_png(r["base64_string"]) for r in bm.bitmap_images(colored, raster, 8).collect()}
    want = {v: np.full((50, 30, 4), (255, 255, 255, 0), np.uint8) for v in images}
    for r in colored.collect():
        want[r["var"]][r["row"], r["col"]] = list(bytes.fromhex(r["color"][1:]))
    for v in images:
        assert (images[v] == want[v]).all()


def test_pipeline_end_to_end(spark, tmp_path):
    from skygrid.plans import daily

    rows = [("aemet" if k % 3 else "ria", *r) for k, r in enumerate(stations(30, 18))]
    obs = spark.createDataFrame(rows, "service string, " + OBS).drop("i_step", "DewTemperature")
    obs = obs.withColumns({
        "slope": F.lit(3.0), "aspect": F.lit(90.0), "MinRelativeHumidity": F.lit(40.0), "MaxRelativeHumidity": F.lit(90.0)})
    lon, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    obs = obs.withColumns({"lon": lon, "lat": lat})
    topo = spark.createDataFrame(
        [(k, 1 + k % 2, 4e5 + 10000.0 * (k % 12), 42e5 + 10000.0 * (k // 12), 10.0 * k, 5.0, 90.0, 0.0) for k in range(144)],
        "cell_id long, partition int, x double, y double, elevation double, slope double, aspect double, TPI double")
    wkt = "POLYGON ((390000 4190000, 460000 4190000, 460000 4260000, 390000 4260000, 390000 4190000))"
    regions = spark.createDataFrame([(1, "provincia", "P", "08", wkt)], "region_id long, admin_level string, name string, cpro string, wkt string")
    store = daily.Store(str(tmp_path))
    choices = {v: ((10.0, 5.0), (20.0, 10.0)) for v in CALIBRATED}

    def run(*days, keep=None):
        spine = keep and spark.createDataFrame([(date(2024, 5, d),) for d in keep], "dates date")
        wanted = spark.createDataFrame([(date(2024, 5, d),) for d in days], "date_fin date")
        return daily.run(
            spark, [obs.filter("service = 'aemet'"), obs.filter("service = 'ria'")], topo, regions, wanted,
            ra.Raster(390000.0, 4330000.0, 10000.0, 14, 14), ra.Raster(-4.3, 39.2, 0.3, 6, 6), store, choices, spine)

    def files(day):
        return {p: p.stat().st_mtime_ns for name in ("best", "cv", "series", "bitmaps") for p in (tmp_path / name).rglob(f"*{day}*/*.parquet")}

    run(17)
    before = files("2024-05-17")
    assert len(before) >= 4
    cells = run(17, 18)
    assert files("2024-05-17") == before
    assert cells.count() == 288 and cells.filter("MinTemperature is null").count() == 0
    assert spark.read.parquet(store.path("series")).count() == 2
    assert spark.read.parquet(store.path("calibrations")).count() == 4
    assert len(spark.read.parquet(store.path("calibrations")).columns) == 24
    assert spark.read.parquet(store.path("bitmaps")).count() == 22
    assert spark.read.parquet(store.path("interpolators/params")).count() == 4
    spine = spark.createDataFrame([(date(2024, 5, 18),)], "dates date")
    assert daily.current(spark, store, "cv", spine).select("dates").distinct().count() == 1
    assert {r.stat for r in spark.read.parquet(store.path("cv")).select("stat").distinct().collect()} == {
        "bias", "mae", "relative_bias", "n", "r2", "n_stations"}
    # A third run has nothing to do but to drop what the spine no longer holds.
    assert run(18, keep=[18, 19]).select("dates").distinct().collect() == [(date(2024, 5, 18),)]
    days = {"best": "date_fin", "cv": "dates", "series": "dates", "bitmaps": "published", "interpolators/obs": "date_fin", "interpolators/params": "date_fin"}
    for name, day in days.items():
        assert [str(r[0]) for r in spark.read.parquet(store.path(name)).select(day).distinct().collect()] == ["2024-05-18"]
    assert spark.read.parquet(store.path("calibrations")).count() == 2
    assert not files("2024-05-17") and files("2024-05-18")


def test_numbering_of_a_hot_bucket(spark):
    rows = [(1, k) for k in range(5000)] + [(2, 7), (0, 3), (0, 1)]
    df = spark.createDataFrame(rows, "b int, k int").repartition(7)
    got = {(r.b, r.k): r.n for r in grid.row_numbers(df, ["b"], ["k"], "n").collect()}
    assert got == {r: i + 1 for i, r in enumerate(sorted(rows))}
    sizes = grid.row_chunks(df, ["b"], ["k"], 4).groupBy("chunk").count().collect()
    assert sorted(r["count"] for r in sizes) == [1250, 1251, 1251, 1251] and grid.row_chunks(df.limit(0), ["b"], ["k"], 4).count() == 0


def test_rollup_reads_cells_once(spark):
    cells = spark.createDataFrame([(c, date(2024, 1, d), float(c * d) if c != 3 else None) for c in range(6) for d in (1, 2)], "cell_id int, dates date, v double")
    members = spark.createDataFrame([(0, 10), (1, 10), (2, 11), (3, 12), (2, 12)], "cell_id int, rid int")
    levels = spark.createDataFrame([("town", r, r) for r in (10, 11, 12)] + [("land", r, r // 12) for r in (10, 11, 12)], "admin_level string, rid int, region int")
    got = {(r.admin_level, r.region, r.dates.day): (r.n, r.v) for r in rg.rollup(cells, members, levels, ["v"]).collect()}
    assert got["town", 10, 2] == (2, 1.0) and got["town", 12, 1] == (2, 2.0) and got["land", 0, 2] == (3, 2.0) and got["land", 1, 2] == (2, 4.0) and len(got) == 10


def test_only_wanted_windows_multiply(spark):
    obs = spark.createDataFrame([(date(2024, 1, 1) + timedelta(d), d) for d in range(60)], "dates date, k int")
    wanted = spark.createDataFrame([(date(2024, 1, 20),), (date(2024, 1, 21),), (date(2024, 1, 20),)], "date_fin date")
    rows = st.window_dates(obs, wanted, 5).collect()
    assert sorted((r.date_fin.day, r.k) for r in rows) == [(f, f - 1 - k) for f in (20, 21) for k in range(4, -1, -1)]
    assert st.window_dates(obs, wanted, 5).columns == ["dates", "k", "date_fin"]


def test_landed_files_become_raw_days(spark, tmp_path):
    from skygrid.plans import daily
    from skygrid.sources import feeds, tables

    rows = [("2024-05-01 10:00:00", "S1", -3.0, 40.0, 5.0), ("2024-05-02 10:00:00", "S1", -3.0, 40.0, 6.0), ("2024-05-01 00:00:00", "S9", 30.0, 40.0, 7.0)]
    landed = spark.createDataFrame(rows, "timestamp string, stationID string, lon double, lat double, MinTemperature double")
    landed.write.json(str(tmp_path / "aemet"))
    read = feeds.read_feeds(spark, {"aemet": (str(tmp_path / "aemet"), "json")}).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    wanted = spark.createDataFrame([(date(2024, 5, 1),)], "dates date")
    store = daily.Store(str(tmp_path / "store"))
    daily.store_raw([daily.from_feeds(read, wanted, F.lit(date(2024, 6, 1)))], store)
    raw = tables.scan_raw(spark, store.path("raw")).collect()
    assert [(r.stationID, r.dates, r.service, r.MinTemperature) for r in raw] == [("S1", "2024-05-01", "aemet", 5.0)]
    assert raw[0].x == pytest.approx(5e5, abs=1e-6)


def test_feeds_become_raw_days(spark):
    from skygrid.plans import daily

    rows = [("2024-05-01 10:00:00", "S1", -3.0, 40.0, "aemet"), ("2024-05-02 10:00:00", "S1", -3.0, 40.0, "aemet"), ("2024-05-09 00:00:00", "S2", 0.0, 41.0, "ria")]
    landed = spark.createDataFrame(rows, "timestamp string, stationID string, lon double, lat double, service string").withColumn("timestamp", F.to_timestamp("timestamp"))
    wanted = spark.createDataFrame([(date(2024, 5, 1),), (date(2024, 5, 9),)], "dates date")
    out = daily.from_feeds(landed, wanted, F.lit(date(2024, 5, 5))).orderBy("dates").collect()
    assert [(r.stationID, r.dates) for r in out] == [("S2", date(2024, 5, 9))] and out[0].y > 4.5e6
    assert len(daily.from_feeds(landed, wanted, F.lit(date(2024, 5, 6))).collect()) == 2


def test_partition_with_one_station_is_published(spark, tmp_path):
    from skygrid.plans import daily

    obs = spark.createDataFrame([(date(2024, 5, 1), 1, "S1", 4e5, 42e5, 100.0, 1.0, 9.0, 0.5, 0.0, 3.0, 90.0)], OBS)
    topo = spark.createDataFrame([(k, 1, 4e5 + k, 42e5, 100.0, 5.0, 90.0, 0.0) for k in range(3)],
                                 "cell_id long, partition int, x double, y double, elevation double, slope double, aspect double, TPI double")
    store = daily.Store(str(tmp_path))
    obs.write.parquet(store.path("placed"))
    wanted = spark.createDataFrame([(date(2024, 5, 1),)], "date_fin date")
    best = cb.best_params(cb.error_table(obs.withColumnRenamed("dates", "date_fin"), ["date_fin", "i_step"], {"MinTemperature": ((30.0, 3.0),)}), ["date_fin", "i_step"])
    assert best.count() == 0
    assert [r.MinTemperature for r in daily.interpolate(spark, topo, wanted, best, store).collect()] == pytest.approx([1.0] * 3)
