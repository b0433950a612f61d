"""Leave-one-out predictions of large station sets: few passes over all pairs, and the same results as over all of them."""

import numpy as np
import pyarrow as pa
import pytest

from skygrid.operators import calibrate as cb, loo
from skygrid.operators.interpolate import SOURCE_VALUES
from skygrid.params import CALIBRATED, DEFAULTS

GRID = {v: (DEFAULTS.smoothing[v], (8.0, 2.0)) for v in CALIBRATED}
VALUES = {v: SOURCE_VALUES[v] for v in CALIBRATED}


def station_set(n, seed=3):
    rng = np.random.default_rng(seed)
    wet = rng.random(n) < 0.6
    rain = rng.gamma(1.0, 4.0, n)
    columns = {
        "sx": 3e5 + rng.uniform(0, 230e3, n), "sy": 41e5 + rng.uniform(0, 230e3, n), "sz": rng.uniform(0, 2.0, n),
        **{c: rng.normal(10, 5, n) for c in ("s_tmin", "s_tmax", "s_tdew")}, "s_event": wet.astype(float), "s_amount": np.where(wet, rain, np.nan)}
    # Missing values, a place that is not known, stations far from all others, and a station twice.
    columns["s_tdew"][::9] = np.nan
    columns["sx"][12] = np.nan
    columns["sx"][6:10] = 9e6, 9.001e6, 9.002e6, 9.3e6
    ids = [f"ST{k}" for k in range(n)]
    ids[11] = ids[10]
    return pa.RecordBatch.from_pydict({
        "day": [1] * n, "_set": ["1 0"] * n, "s_id": ids, "is_target": [k % 3 == 0 for k in range(n)], **{c: v.tolist() for c, v in columns.items()}})


def rows(batch, grid):
    out = [x for b in loo.predicted_rows(iter([batch]), ["day"], VALUES, grid, cb._numbers(DEFAULTS)) for x in b.to_pylist()]
    return sorted(((r["variable"], r["N"], r["stationID"], r["obs"]), r["pred"]) for r in out)


def test_packed_sets_give_the_same(monkeypatch):
    batch = station_set(700)
    got = rows(batch, GRID)
    monkeypatch.setattr(loo, "LARGE", 1 << 30)
    want = rows(batch, GRID)
    assert [k for k, _ in got] == [k for k, _ in want] and len(got) > 1900
    assert sum(p is None for _, p in got) == sum(p is None for _, p in want) > 0
    for (key, a), (_, b) in zip(got, want):
        assert a == (b if b is None else pytest.approx(b, rel=1e-9, abs=1e-9)), key


def test_one_pass_over_all_pairs(monkeypatch):
    """Later passes work on the pairs in reach: the exponentials were four for each pair and choice before."""
    class Counted:
        n = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, x, *args, **kwargs):
            Counted.n += np.size(x)
            return np.exp(x, *args, **kwargs)

    monkeypatch.setattr(loo, "np", Counted())
    n = 1200
    rows(station_set(n), {"MaxTemperature": (DEFAULTS.smoothing["MaxTemperature"],)})
    assert n * n / 3 < Counted.n < 1.8 * n * n / 3


def test_variables_share_their_weights(monkeypatch):
    """Temperatures with the same stations and the same choice have the same radii."""
    calls = []
    monkeypatch.setattr(loo, "_grown", lambda *a, f=loo._grown: calls.append(1) or f(*a))
    temperatures = {v: ((30.0, 3.0),) for v in loo.TEMPERATURES[:2]}
    batch = station_set(40)
    both = rows(batch, temperatures)
    together = len(calls)
    one = rows(batch, {"MaxTemperature": ((30.0, 3.0),)})
    assert together == len(calls) - together
    assert [x for x in both if x[0][0] == "MaxTemperature"] == one
