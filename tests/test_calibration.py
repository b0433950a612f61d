"""Calibration windows in arrays against a plain Python version: all five variables, both grids, chunks, moved stations."""

import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.functions import geo
from skygrid.operators import calibrate as cb, interpolate as ip, stations as st, validate as va
from skygrid.params import CALIBRATED, DAILY_GRID, DEFAULTS, STUDY_GRID
from tests.test_method import OBS

NAMES = ("n_obs", "sum_abs", "sum_err", "sum_obs", "sum_pred", "sum_oo", "sum_pp", "sum_op")


def observations(days, n=10, seed=3):
    """Two partitions; some values are missing, some days dry, and one partition has a day without stations."""
    rng = np.random.default_rng(seed)
    out = []
    for s in range(n):
        x, y, z = 4e5 + rng.uniform(0, 1.5e5), 42e5 + rng.uniform(0, 1.5e5), float(rng.uniform(0, 2000))
        for k, d in enumerate(days):
            if s % 2 and k == 1:
                continue
            t = float(rng.normal(10, 4))
            rain = float(max(0.0, rng.normal(0, 3))) if k % 3 else float(rng.uniform(0.1, 9))
            out.append((d, s % 2, f"S{s}", x, y, z, t if rng.random() > .1 else None, t + 8.0, t - 2.0, rain if rng.random() > .1 else None, 3.0, 90.0))
    return out


def value_of(row, variable):
    rain = row[9]
    return {
        "MinTemperature": row[6], "MaxTemperature": row[7], "DewTemperature": row[8],
        "PrecipitationEvent": None if rain is None else float(rain > 0), "PrecipitationAmount": rain if rain else None}[variable]


def rain_slope(rows):
    wet = [(r[5] / 1000, math.log(r[9])) for r in rows if r[9]]
    if len(wet) < DEFAULTS.regression_min_stations:
        return 0.0
    z, q = map(np.array, zip(*wet))
    return ((z - z.mean()) * (q - q.mean())).mean() / z.var() if z.var() > DEFAULTS.regression_min_variance_km2 else 0.0


def prediction(target, others, variable, n, alpha, slope):
    r2 = np.array([(target[3] - o[3])**2 + (target[4] - o[4])**2 for o in others])
    rp2 = DEFAULTS.initial_radius_m**2
    for k in range(DEFAULTS.radius_passes + 1):
        w = np.where(r2 <= rp2, np.exp(-alpha * r2 / rp2) - math.exp(-alpha), 0.0)
        total = w.sum()
        if k < DEFAULTS.radius_passes and total > 0:
            mean = (1 - math.exp(-alpha)) / alpha - math.exp(-alpha)
            rp2 = (n if k == DEFAULTS.radius_passes - 1 else 2 * n) * mean * rp2 / total
    if not total > 0:
        return None
    v = np.array([value_of(o, variable) for o in others])
    dz = np.array([(o[5] - target[5]) / 1000 for o in others])
    if variable == "PrecipitationEvent":
        return float((w * v).sum() / total >= DEFAULTS.event_cut - ip.EVEN)
    if variable == "PrecipitationAmount":
        f = np.clip(np.tanh(-slope * dz / 2), -DEFAULTS.amount_max_f, DEFAULTS.amount_max_f)
        return float((w * v * (1 + f) / (1 - f)).sum() / total)
    mz, mv = (w * dz).sum() / total, (w * v).sum() / total
    var = (w * dz * dz).sum() / total - mz * mz
    steep = (w > 0).sum() >= DEFAULTS.regression_min_stations and var > DEFAULTS.regression_min_variance_km2
    return float(mv - (((w * dz * v).sum() / total - mz * mv) / var if steep else 0.0) * mz)


def plain_sums(rows, choices):
    """{(date, partition, variable): (choice, sum)} from single predictions."""
    out = {}
    for d, step in sorted({r[:2] for r in rows}):
        here = [r for r in rows if r[:2] == (d, step)]
        slope = rain_slope(here)
        for variable, pairs in choices.items():
            known = [r for r in here if value_of(r, variable) is not None]
            sums = np.zeros((len(pairs), len(NAMES)))
            for t in known:
                others = [r for r in known if r[2] != t[2]]
                o = value_of(t, variable)
                for k, (n, alpha) in enumerate(pairs):
                    q = prediction(t, others, variable, n, alpha, slope) if others else None
                    if q is not None:
                        sums[k] += (1.0, abs(q - o), q - o, o, q, o * o, q * q, o * q)
            out[d, step, variable] = sums
    return out


def same_choices(got, want, choices):
    """Each found row has the least mean error of its window (errors equal to six decimals are equal), and its choice's sums."""
    assert {(r.date_fin, r.i_step, r.variable) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        total, last = want[r.date_fin, r.i_step, r.variable]
        k = choices[r.variable].index((r.N, r.alpha))
        mae = np.where(total[:, 0] > 0, total[:, 1] / np.maximum(total[:, 0], 1), np.inf)
        assert r.mae == pytest.approx(mae[k], abs=1e-8) and mae[k] <= mae.min() + 1.1e-6
        lower = [c for c, m in zip(choices[r.variable], mae) if m < mae[k] + 1e-9 and c < (r.N, r.alpha)]
        assert not lower
        assert r.window == pytest.approx(total[k], abs=1e-6) and r.today == pytest.approx(last[k], abs=1e-6)


@pytest.mark.parametrize("per_chunk,stretch", [(256, 128), (2, 5)])
def test_daily_grid(spark, tmp_path, monkeypatch, per_chunk, stretch):
    monkeypatch.setattr(cb, "STATIONS_PER_CHUNK", per_chunk)
    monkeypatch.setattr(cb, "STRETCH_DAYS", stretch)
    days = [date(2024, 1, d) for d in (1, 3, 9, 10, 30)] + [date(2024, 2, 2)]
    rows = observations(days)
    sums = plain_sums(rows, DAILY_GRID)
    ends = [date(2024, 1, 1) + timedelta(k) for k in range(0, 60, 3)]
    want = {}
    for end in ends:
        for step in (0, 1):
            for variable in CALIBRATED:
                zero = np.zeros((len(DAILY_GRID[variable]), len(NAMES)))
                inside = [s for (d, i, v), s in sums.items() if i == step and v == variable and 0 <= (end - d).days < 17]
                total = sum(inside, zero)
                if total[:, 0].any():
                    want[end, step, variable] = total, sums.get((end, step, variable), zero)
    obs = spark.createDataFrame(rows, OBS)
    assert tuple(cb.error_sums()) == NAMES
    wanted = spark.createDataFrame([(e,) for e in ends + ends[:2]], "date_fin date")
    windows = cb.calibrated_windows(obs, wanted, DAILY_GRID, str(tmp_path / "rows"))
    same_choices(windows.collect(), want, DAILY_GRID)
    counts = cb.window_station_counts(obs, cb.window_frames(obs, wanted, 17))
    stats = {(r.dates, r.interpolator_id, r.variable, r.stat): r.value for r in va.cv_tables(windows, counts).collect()}
    for r in windows.collect():
        key = r.date_fin, str(r.i_step), r.variable
        assert (*key, "r2") in stats and (*key, "n_stations") in stats
        assert ((*key, "mae") in stats) == (r.today[0] > 0)
        if r.today[0]:
            assert stats[*key, "mae"] == pytest.approx(r.today[1] / r.today[0]) and stats[*key, "n"] == r.today[0]
    assert cb.calibrated_windows(obs, wanted.limit(0), DAILY_GRID, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("per_chunk", [256, 2])
def test_study_grid(spark, tmp_path, monkeypatch, per_chunk):
    monkeypatch.setattr(cb, "STATIONS_PER_CHUNK", per_chunk)
    rows = observations([date(2024, 1, 2), date(2024, 1, 16), date(2024, 1, 17), date(2024, 2, 5)], 8, 7)
    scored = [r for r in rows if r[0].day <= 16]
    sums = plain_sums(scored, STUDY_GRID)
    want = {}
    for (d, step, variable), s in sums.items():
        end = d.replace(day=16)
        total, last = want.get((end, step, variable), (0.0, np.zeros_like(s)))
        want[end, step, variable] = total + s, s if d == end else last
    want = {k: v for k, v in want.items() if v[0][:, 0].any()}
    days = spark.createDataFrame(scored, OBS).withColumn("date_fin", F.date_add(F.trunc("dates", "MM"), 15))
    same_choices(cb.best_of_windows(days, STUDY_GRID, str(tmp_path / "rows")).collect(), want, STUDY_GRID)


def test_moved_station_in_the_daily_plan(spark, tmp_path):
    from skygrid.plans import daily

    rows = [list(r) for r in observations([date(2024, 5, 1) + timedelta(k) for k in range(24)], 12)]
    for r in rows:
        # S2 moves on the 9th, S4 goes up on the 20th; S6 is away for longer than a window before it moves.
        if r[2] == "S2" and r[0].day >= 9:
            r[3] += 30000.0
        if r[2] == "S4" and r[0].day >= 20:
            r[5] += 900.0
        if r[2] == "S6" and r[0].day == 24:
            r[4] -= 20000.0
    rows = [("aemet", *r) for r in rows if r[3] is not None and not (r[2] == "S6" and 3 <= r[0].day < 24)]
    obs = spark.createDataFrame(rows, "service string, " + OBS).drop("i_step", "DewTemperature").withColumns({
        "slope": F.lit(3.0), "aspect": F.lit(90.0), "MinRelativeHumidity": F.lit(40.0), "MaxRelativeHumidity": F.lit(90.0)})
    lon, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    topo = spark.createDataFrame(
        [(k, 1 + k % 2, 4e5 + 10000.0 * (k % 12), 42e5 + 10000.0 * (k // 12), 10.0 * k, 5.0, 90.0, 0.0) for k in range(24)],
        "cell_id long, partition int, x double, y double, elevation double, slope double, aspect double, TPI double")
    store = daily.Store(str(tmp_path))
    choices = {v: ((10.0, 5.0), (20.0, 10.0)) for v in CALIBRATED}
    daily.store_raw([obs.withColumns({"lon": lon, "lat": lat})], store)
    wanted = spark.createDataFrame([(date(2024, 5, d),) for d in (8, 10, 19, 24)], "date_fin date")
    best = daily.calibrate(spark, topo, wanted, store, choices)
    placed = spark.read.parquet(store.path("placed"))
    exact = cb.calibrate_frames(st.latest_attributes(st.window_dates(placed, wanted), ["date_fin", "i_step", "stationID"]), choices)
    fixed = cb.calibrate(placed, wanted, choices, str(tmp_path / "fixed"))
    found, want, plain = ({(r.date_fin, r.i_step, r.variable): (r.N, r.alpha, r.mae) for r in x.collect()} for x in (best, exact, fixed))
    assert found.keys() == want.keys() and len(want) == 4 * 2 * 5
    for k, v in want.items():
        assert found[k] == pytest.approx(v, abs=1e-9)
    # Only windows with a move differ from those in which every day has its own position.
    assert {k[0].day for k in want if plain[k][2] != pytest.approx(want[k][2], abs=1e-9)} == {10, 19, 24}
    assert {r.date_fin.day for r in spark.read.parquet(store.path("moved_windows")).collect()} == {10, 19, 24}
    assert spark.read.parquet(store.path("cv")).where("stat = 'r2'").count() == len(want)


def test_moves_far_apart_meet_in_no_window(spark):
    rows = [(date(2024, 1, 1), 1, "A", 0.0), (date(2024, 1, 18), 1, "A", 1.0), (date(2024, 3, 1), 1, "B", 0.0), (date(2024, 3, 17), 1, "B", 1.0)]
    placed = spark.createDataFrame(rows, "dates date, i_step int, stationID string, x double").withColumns({c: F.lit(0.0) for c in ("elevation", "slope", "aspect", "y")})
    wanted = spark.createDataFrame([(date(2024, 1, 1) + timedelta(k),) for k in range(100)], "date_fin date")
    assert [r.date_fin for r in cb.moved_windows(placed, wanted).collect()] == [date(2024, 3, 17)]
