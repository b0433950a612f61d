"""Radii and weighted sums as arrays, in the task that holds a chunk of targets and the sources around them.

Joined row by row, every pair of target and source is formed again for each radius pass and day. Here the distances of a block of
targets are worked out once for all days of its place, the first pass (one radius for all) is a product of weights with the days'
sources, and the later passes work on the pairs within reach only. Spark deals targets and sources out and brings them together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Tasks get these functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs of a block of targets held at once.
MOST = 1 << 18
# Targets of a block for all days of a place, few enough to lie close together, and their pairs with all places of sources.
TARGETS = 256
MOST_PLACES = 1 << 21
# Pairs are looked up to this many times the squared radius, so that the next passes find theirs among them.
MARGIN = 2.0
TEMPERATURES = ("MinTemperature", "MaxTemperature", "DewTemperature")


def _mean(alpha):
    return (1.0 - np.exp(-alpha)) / alpha - np.exp(-alpha)


def _grown(rp2: np.ndarray, total: np.ndarray, n, alpha, factor: float) -> np.ndarray:
    """The next squared radius; a target whose disc holds no weight keeps its own."""
    held = total > 0
    return np.where(held, factor * n * _mean(alpha) * rp2 / np.where(held, total, 1.0), rp2)


def first_weights(r2: np.ndarray, start: float, alpha) -> np.ndarray:
    """Truncated Gaussian of (target, source) within the radius that all targets start from."""
    alpha = np.asarray(alpha)[..., None] if np.ndim(alpha) else alpha
    w = np.exp(r2 * (-alpha / start))
    w -= np.exp(-alpha)
    return np.maximum(w, 0.0, out=w)


def settled(r2: np.ndarray, total: np.ndarray, n, alpha, p: dict, pairs: bool = True):
    """Squared radii after all passes, and the pairs (target, source, weight) in them.

    ``r2`` (target, source) has sources with a value only; ``total`` are the sums of the first pass. ``n`` and ``alpha`` are numbers
    or one number per target.
    """
    size, last = r2.shape[1], p["passes"] - 1
    floor = np.exp(-alpha)
    rp2 = _grown(np.full(len(r2), p["radius"] ** 2), total, n, alpha, 1.0 if last == 0 else 2.0)
    held = None
    for k in range(1, last + 2):
        if k > last and not pairs:
            break
        if held is None or (rp2 > held).any():
            held = MARGIN * rp2
            inside = r2 <= held[:, None]
            row = np.repeat(np.arange(len(r2)), np.count_nonzero(inside, axis=1))
            at = np.flatnonzero(inside)
            near = r2.ravel()[at]
        w = np.exp(near * (-alpha / rp2)[row])
        w -= floor[row] if np.ndim(floor) else floor
        np.maximum(w, 0.0, out=w)
        if k <= last:
            rp2 = _grown(rp2, np.bincount(row, w, len(r2)), n, alpha, 1.0 if k == last else 2.0)
    if not pairs:
        return rp2, None
    kept = np.flatnonzero(w > 0)
    row, at = row[kept], at[kept]
    return rp2, (row, at - row * size, w[kept])


def _squares(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray) -> np.ndarray:
    """Squared distances (target, source); infinite where a place is not known."""
    dx, dy = x[:, None] - sx, y[:, None] - sy
    dx *= dx
    dy *= dy
    dx += dy
    return np.where(np.isnan(dx), np.inf, dx) if np.isnan(dx).any() else dx


def _blocks(targets: int, sources: int):
    step = max(1, MOST // max(1, sources))
    return ((a, min(targets, a + step)) for a in range(0, targets, step))


def _doubles(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(float)


def _codes(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """A number per distinct row of the columns; missing values are equal."""
    if not names:
        return np.zeros(table.num_rows, int)
    return table.select(list(names)).to_pandas().groupby(list(names), dropna=False, sort=False).ngroup().to_numpy()


def near_sums(targets: pa.Table, sources: pa.Table, target_id: str, far2: float) -> pa.Table:
    """One row per target of a group: sources with an id and all sources within the squared distance, the least distance and the sum of distances."""
    x, y, sx, sy = (_doubles(*c) for c in ((targets, "x"), (targets, "y"), (sources, "sx"), (sources, "sy")))
    known = sources.column("_known").to_numpy().astype(bool)
    n, k, least, total = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.full(len(x), np.inf), np.zeros(len(x))
    # Along x, so that a block meets the sources of its strip only; a metre more, for rounding.
    far = np.sqrt(far2) + 1.0
    along, order = np.argsort(sx, kind="stable"), np.argsort(x, kind="stable")
    sx, sy, known = sx[along], sy[along], known[along]
    all_known = known.all()
    for a, b in _blocks(len(x), len(sx)) if len(sx) else ():
        at = order[a:b]
        # Unknown places come last.
        strip = slice(np.searchsorted(sx, x[at[0]] - far), np.searchsorted(sx, x[at[-1]] + far, "right"))
        if strip.start >= strip.stop:
            continue
        r2 = _squares(x[at], y[at], sx[strip], sy[strip])
        inside = r2 <= far2
        k[at] = np.count_nonzero(inside, axis=1)
        n[at] = k[at] if all_known else np.count_nonzero(inside & known[strip], axis=1)
        least[at] = np.sqrt(r2.min(axis=1))
        r2[~inside] = 0.0
        total[at] = np.sqrt(r2, out=r2).sum(axis=1)
    return pa.table({
        target_id: targets.column(target_id), "n": n, "_k": k, "nearest": pa.array(least, mask=k == 0), "_total": total})


def radii(targets: pa.Table, sources: pa.Table, ids: Sequence[str], variables: Sequence[str], leave_out: tuple[str, str] | None, p: dict) -> pa.Table:
    """One row per target of a group with ``rp2_<v>``; ``n_<v>`` and ``alpha_<v>`` are dropped from its columns.

    Rows of one target each bring their pairs to the first pass, and are one target from then on.
    """
    _, first, times = np.unique(_codes(targets, ids), return_index=True, return_counts=True)
    t = targets.take(pa.array(first))
    x, y, sx, sy = (_doubles(*c) for c in ((t, "x"), (t, "y"), (sources, "sx"), (sources, "sy")))
    out = {v: np.empty(len(first)) for v in variables}
    has = {v: sources.column(f"_has_{v}").to_numpy().astype(bool) for v in variables}
    n, alpha = ({v: _doubles(t, f"_{c}_{v}") for v in variables} for c in ("n", "alpha"))
    if leave_out:
        # Only ids that are known differ from others.
        mine, theirs = t.column(leave_out[0]).to_pandas(), sources.column(leave_out[1]).to_pandas()
    for a, b in _blocks(len(first), len(sx)):
        r2 = _squares(x[a:b], y[a:b], sx, sy)
        if leave_out:
            one, other = mine[a:b].to_numpy()[:, None], theirs.to_numpy()[None, :]
            differ = (one != other) & mine[a:b].notna().to_numpy()[:, None] & theirs.notna().to_numpy()[None, :]
            r2 = np.where(differ.astype(bool), r2, np.inf)
        for v in variables:
            own = r2 if has[v].all() else r2[:, has[v]]
            total = first_weights(own, p["radius"] ** 2, alpha[v][a:b]).sum(axis=1) * times[a:b]
            out[v][a:b] = settled(own, total, n[v][a:b], alpha[v][a:b], p, pairs=False)[0]
    t = t.select([c for c in t.column_names if not c.startswith(("_n_", "_alpha_"))])
    for v in variables:
        t = t.append_column(f"rp2_{v}", pa.array(out[v], pa.float64()))
    return t


def sum_names(variables: Sequence[str]) -> list[str]:
    """The sums of each variable in the order they come out."""
    out = []
    for v in variables:
        out.append(f"w_{v}")
        if v in TEMPERATURES:
            out += [f"{k}_{v}" for k in ("c", "wz", "wt", "wzz", "wzt")]
        elif v == "Wind":
            out += ["wu_Wind", "wv_Wind"]
        else:
            out.append(f"wt_{v}")
    return out


class Day:
    """The sources of one day of a place and what its variables are smoothed with."""

    def __init__(self, day: int, rows: np.ndarray, head: int, place: np.ndarray, values: dict[str, np.ndarray], smooth: dict[str, tuple[float, float]], slope: float):
        self.day, self.rows, self.head, self.slope = day, rows, head, slope
        # Variables with the same sources and the same choice have the same radii and weights.
        self.groups: dict[tuple, list[str]] = {}
        for v, value in values.items():
            has = ~np.isnan(value[rows])
            self.groups.setdefault((has.tobytes(), *smooth[v]), []).append(v)
        self.own = {key: rows[~np.isnan(values[vs[0]][rows])] for key, vs in self.groups.items()}
        self.count = {key: np.bincount(place[own], minlength=int(place.max(initial=-1)) + 1).astype(float) for key, own in self.own.items()}


def _compact(x: np.ndarray, y: np.ndarray, most: int) -> list[np.ndarray]:
    """Targets in blocks of ``most`` at most that lie close together."""
    bands = max(1, round(float(np.sqrt(len(x) / most))))
    along = np.argsort(x, kind="stable")
    order = np.concatenate([band[np.argsort(y[band], kind="stable")] for band in np.array_split(along, bands)])
    return [order[a:a + most] for a in range(0, len(order), most)]


def _weights(r2: np.ndarray, rp2: np.ndarray, alpha: float, into: np.ndarray) -> np.ndarray:
    """Truncated Gaussian of (target, source) for a radius per target."""
    w = np.multiply(r2, (-alpha / rp2)[:, None], out=into)
    # Cut at the radius before the exponential, which is slow where it underflows.
    np.maximum(w, np.full(r2.shape[1], -alpha), out=w)
    np.exp(w, out=w)
    w -= np.exp(np.full(32, -alpha))[0]
    return w


class Block:
    """Targets that lie close together and their squared distances to the places of sources."""

    def __init__(self, x: np.ndarray, y: np.ndarray, z: np.ndarray, spots: np.ndarray):
        self.x, self.y, self.z, self.spots = x, y, z, spots
        self.r2 = _squares(x, y, spots[0], spots[1])
        self.memory = [np.empty(0), np.empty(0)]
        self.box = [(np.nanmin(c), np.nanmax(c)) if not np.isnan(c).all() else (-np.inf, np.inf) for c in (x, y)]

    def _array(self, k: int, width: int) -> np.ndarray:
        """One of two arrays (target, ``width``), whose memory the next call gets, too."""
        size = len(self.x) * width
        if self.memory[k].size < size:
            self.memory[k] = np.empty(size)
        return self.memory[k][:size].reshape(len(self.x), width)

    def _near(self, at: np.ndarray, far2: float) -> np.ndarray:
        """Which of the places lie within a distance of the block's box, all if that is most of them."""
        far = np.sqrt(far2) + 1.0
        (x0, x1), (y0, y1) = self.box
        x, y = self.spots[0][at], self.spots[1][at]
        inside = (x >= x0 - far) & (x <= x1 + far) & (y >= y0 - far) & (y <= y1 + far)
        near = np.flatnonzero(inside)
        return near if 4 * len(near) < 3 * len(at) else np.arange(len(at))

    def settled(self, place: np.ndarray, total: np.ndarray, n: float, alpha: float, p: dict) -> tuple[np.ndarray, np.ndarray]:
        """Weights (target, source) after all passes, and which sources they are of: those in no target's radius are left out.

        ``place`` says where the sources are, ``total`` are the sums of the first pass.
        """
        last = p["passes"] - 1
        rp2 = _grown(np.full(len(self.x), p["radius"] ** 2), total, n, alpha, 1.0 if last == 0 else 2.0)
        held = -1.0
        for k in range(1, last + 2):
            if rp2.max(initial=0.0) > held:
                held = MARGIN * rp2.max(initial=0.0)
                near = self._near(place, held)
                r2 = np.take(self.r2, place[near], axis=1, out=self._array(0, len(near)), mode="clip")
            w = _weights(r2, rp2, alpha, self._array(1, len(near)))
            if k <= last:
                rp2 = _grown(rp2, w.sum(axis=1), n, alpha, 1.0 if k == last else 2.0)
        return w, near


def _day_sums(w: np.ndarray, group: Sequence[str], source: np.ndarray, z: np.ndarray, s: dict[str, np.ndarray], slope: float, p: dict) -> dict[str, np.ndarray]:
    """Weighted sums of the variables of a group over (target, source); a sum over an unknown height is unknown."""
    out = {}
    total = w.sum(axis=1)
    heights = s["sz"][source]
    lost = np.isnan(heights)
    # As in SQL, a source without a height weighs, but adds nothing to sums over heights, and its rain takes the greatest step.
    mid = heights[~lost].mean() if not lost.all() else 0.0
    known, rise = (~lost).astype(float), np.where(lost, 0.0, heights - mid)
    own = z - mid
    temperatures = [v for v in group if v in TEMPERATURES]
    if temperatures:
        value = [s[v][source] for v in temperatures]
        sums = w @ np.stack([known, rise, rise * rise, *[c for v in value for c in (v, known * v, rise * v)]], axis=1)
        count = np.count_nonzero(w > 0, axis=1)
        weight, first, second = sums[:, 0], sums[:, 1], sums[:, 2]
        for k, v in enumerate(temperatures):
            whole, flat, steep = (sums[:, 3 + 3 * k + i] for i in range(3))
            out |= {f"c_{v}": count, f"wz_{v}": first - own * weight, f"wt_{v}": whole, f"wzz_{v}": second - 2.0 * own * first + own * own * weight,
                    f"wzt_{v}": steep - own * flat}
    for v in group:
        out[f"w_{v}"] = total
        if v == "PrecipitationAmount" and (slope or lost.any() or np.isnan(z).any()):
            at = np.flatnonzero(w)
            row = at // w.shape[1]
            col = source[at - row * w.shape[1]]
            dz = s["sz"][col] - z[row]
            f = np.where(np.isnan(dz), p["max_f"], np.clip(np.tanh(-slope * dz / 2.0), -p["max_f"], p["max_f"]))
            out[f"wt_{v}"] = np.bincount(row, w.ravel()[at] * s[v][col] * (1.0 + f) / (1.0 - f), len(w))
        elif v == "Wind":
            out["wu_Wind"], out["wv_Wind"] = (w @ np.stack([s["s_u"][source], s["s_v"][source]], axis=1)).T
        elif v not in TEMPERATURES:
            out[f"wt_{v}"] = w @ s[v][source]
    return out


def place_sums(variables: Sequence[str], values: dict[str, str], fixed: dict[str, tuple[float, float]] | None, p: dict, names: Sequence[str],
               kinds: dict[str, pa.DataType]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A function from the cells and the rows (days and station-days) of a place to its cell-days with their sums.

    A row marked ``is_day`` names a day and its smoothing (``n_<v>, alpha_<v>``, unless ``fixed``) and rain slope; the others are sources.
    ``names`` are the columns put out, with their types.
    """
    outs = sum_names(variables)

    def sums(cells: pa.Table, rows: pa.Table) -> pa.Table:
        code = _codes(cells, ["cell_id"])
        _, first, times = np.unique(code, return_index=True, return_counts=True)
        t = cells.take(pa.array(first))
        x, y, z = (_doubles(t, c) for c in "xyz")
        marks = rows.column("is_day").to_numpy().astype(bool)
        days = rows.filter(pa.array(marks))
        rows = rows.filter(pa.array(~marks))
        day = rows.column("dates").cast(pa.int32()).to_numpy()
        heads = days.column("dates").cast(pa.int32()).to_numpy()
        s = {c: _doubles(rows, c) for c in ("sx", "sy", "sz", *dict.fromkeys([*(values[v] for v in variables), *(["s_v"] if "Wind" in variables else [])]))}
        s |= {v: s[values[v]] for v in variables}
        # A place is one however many days it has a source.
        spots, place = np.unique(np.stack([s["sx"], s["sy"]]), axis=1, return_inverse=True)
        place = place.reshape(-1)
        slope = _doubles(days, "rain_slope") if "PrecipitationAmount" in variables else np.zeros(len(heads))
        choice = {v: (_doubles(days, f"n_{v}"), _doubles(days, f"alpha_{v}")) for v in variables} if fixed is None else None
        of_day = {}
        by_day = np.argsort(day, kind="stable")
        for k, d in enumerate(heads):
            own = by_day[np.searchsorted(day[by_day], d, "left"):np.searchsorted(day[by_day], d, "right")]
            smooth = fixed or {v: (float(choice[v][0][k]), float(choice[v][1][k])) for v in variables}
            of_day[int(d)] = Day(int(d), own, k, place, {v: s[v] for v in variables}, smooth, float(slope[k]))
        listed = list(of_day.values())
        size = len(first)
        found = {c: np.full((len(listed), size), np.nan) for c in outs}
        # Sources of a day by place, for the first pass of all days at once: one product of matrices for each shape.
        by_alpha: dict[float, list[tuple[int, tuple]]] = {}
        for k, d in enumerate(listed):
            for key in d.groups:
                by_alpha.setdefault(key[2], []).append((k, key))
        for block in _compact(x, y, max(1, min(TARGETS, MOST_PLACES // max(1, spots.shape[1])))) if size else ():
            here = Block(x[block], y[block], z[block], spots)
            for alpha, days_of in by_alpha.items():
                counts = np.zeros((spots.shape[1], len(days_of)))
                for i, (k, key) in enumerate(days_of):
                    counts[:len(listed[k].count[key]), i] = listed[k].count[key]
                totals = first_weights(here.r2, p["radius"] ** 2, alpha) @ counts * times[block][:, None]
                for i, (k, key) in enumerate(days_of):
                    d = listed[k]
                    w, near = here.settled(place[d.own[key]], totals[:, i], key[1], alpha, p)
                    for c, sums_of in _day_sums(w, d.groups[key], d.own[key][near], here.z, s, d.slope, p).items():
                        found[c][k, block] = sums_of
        which = np.tile(np.arange(size), len(listed))
        at = pa.array(which)
        made = {}
        for v in variables:
            weightless = ~(found[f"w_{v}"] > 0)
            for c in sum_names([v]):
                if c.startswith("c_"):
                    made[c] = pa.array(np.nan_to_num(found[c]).astype(np.int64).ravel())
                else:
                    made[c] = pa.array(found[c].ravel(), mask=(weightless | np.isnan(found[c])).ravel())
        made["dates"] = pa.array(np.repeat(np.array([d.day for d in listed], np.int32), size)).cast(pa.date32())
        if "terrain" in names:
            all_rows = cells.column("terrain").combine_chunks().take(pa.array(np.argsort(code, kind="stable")))
            limits = pa.array(np.concatenate([[0], np.cumsum(times)]), pa.int32())
            made["terrain"] = pa.ListArray.from_arrays(limits, all_rows, type=kinds["terrain"]).take(at)
        columns = [made[c] if c in made else t.column(c).take(at).combine_chunks() for c in names]
        return pa.Table.from_arrays([c.cast(kinds[n]) if c.type != kinds[n] else c for n, c in zip(names, columns)], list(names))

    return sums
