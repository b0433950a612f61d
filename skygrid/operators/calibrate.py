"""Leave-one-out errors, grid search of smoothing parameters, and cross-validation sums.

A leave-one-out prediction depends on the day, the station set and the parameters, not on the window it
is counted in. Errors are therefore worked out once per day and added up over each window with running
range sums, instead of once per day for every window that holds it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrid.functions import calendar as cal, geo
from skygrid.operators import interpolate as ip, loo, neighbours as nb, stations as st, windows as wn
from skygrid.params import CALIBRATED, DEFAULTS, SHORT_NAMES, STATION_BUFFER_M, WINDOW_DAYS, InterpolationParams
from skygrid.sources import folders, tables

# Sets are many and pairs are formed some targets at a time, so only very large sets are repeated.
STATIONS_PER_CHUNK = 4096
# Days of a partition that one task works through, with those of the window before them.
STRETCH_DAYS = 128
Grid = dict[str, tuple[tuple[float, float], ...]]

def error_sums() -> dict[str, Column]:
    """What is summed per day and parameter pair; every statistic over any set of days follows from it."""
    o, q = F.col("obs"), F.col("pred")
    return {
        "n_obs": F.lit(1.0), "sum_abs": F.abs(q - o), "sum_err": q - o, "sum_obs": o, "sum_pred": q,
        "sum_oo": o * o, "sum_pp": q * q, "sum_op": o * q,
    }


def _station_sets(frames: DataFrame, group: list[str], used: dict[str, str], p: InterpolationParams) -> DataFrame:
    """Stations of every set with the values used, sorted by set in the task that holds it; a large set once per chunk of its targets."""
    sources = ip.as_sources(frames, group, p)
    # Only sets of several chunks are listed, one for thousands of station-days at most: no station-day moves to learn its set's count.
    large = nb.chunk_counts(sources, group, STATIONS_PER_CHUNK).where("chunks > 1")
    known = sources.where(" and ".join(f"`{g}` is not null" for g in group))
    spread = F.pmod(F.xxhash64("s_id"), F.col("chunks"))
    chunked = known.join(F.broadcast(large), group, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = chunked.select(
        *group, F.concat_ws(" ", *group, "chunk").alias("_set"), F.col("s_id").cast("string").alias("s_id"), (spread == F.col("chunk")).alias("is_target"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in ("sx", "sy", "sz", *dict.fromkeys(used.values()))])
    return nb.place(rows, ["_set"]).sortWithinPartitions("_set")


def _numbers(p: InterpolationParams) -> dict:
    return {
        "radius": p.initial_radius_m, "passes": p.radius_passes, "least": p.regression_min_stations,
        "variance": p.regression_min_variance_km2, "max_f": p.amount_max_f, "cut": p.event_cut, "even": ip.EVEN}


def _fields(frames: DataFrame, group: list[str]) -> str:
    return ", ".join(f"`{g}` {frames.schema[g].dataType.simpleString()}" for g in group) + ", variable string, N double, alpha double"


def predictions_table(frames: DataFrame, group: list[str], grid: Grid, p: InterpolationParams = DEFAULTS) -> DataFrame:
    """Prediction of each station-day from all other stations of its group, for each variable and (N, alpha).

    ``frames`` holds station-days with the ``group`` columns, which name the station set.
    """
    values, numbers = {v: ip.SOURCE_VALUES[v] for v in grid}, _numbers(p)
    return _station_sets(frames, group, values, p).mapInArrow(
        lambda batches: loo.predicted_rows(batches, group, values, grid, numbers), _fields(frames, group) + ", stationID string, obs double, pred double")


def loo_predictions(
    frames: DataFrame, group: list[str], variable: str, pairs: tuple[tuple[float, float], ...] | None = None,
    p: InterpolationParams = DEFAULTS,
) -> DataFrame:
    """The same for one variable, by default with its standard choice."""
    return predictions_table(frames, group, {variable: pairs or (p.smoothing[variable],)}, p)


def error_table(
    frames: DataFrame, group: list[str], grid: Grid, p: InterpolationParams = DEFAULTS
) -> DataFrame:
    """Error sums per group, variable and (N, alpha); stations no other station reaches are left out."""
    values, numbers, names = {v: ip.SOURCE_VALUES[v] for v in grid}, _numbers(p), list(error_sums())
    parts = _station_sets(frames, group, values, p).mapInArrow(
        lambda batches: loo.summed_rows(batches, group, values, grid, numbers, names),
        _fields(frames, group) + "".join(f", {n} double" for n in names))
    return parts.groupBy(*group, "variable", "N", "alpha").agg(*[F.sum(n).alias(n) for n in names])


def window_frames(days: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Each (date_fin, i_step) whose window holds at least one station-day of the partition."""
    spread = days.select("i_step", "dates").distinct().withColumn(
        "date_fin", F.explode(F.sequence("dates", F.date_add("dates", window - 1))))
    return spread.select("i_step", "date_fin").distinct().join(
        wanted.select("date_fin").distinct(), "date_fin", "left_semi")


def rolled_errors(daily: DataFrame, frames: DataFrame, grid: Grid, window: int = WINDOW_DAYS) -> DataFrame:
    """Error sums over the window that ends on each ``date_fin``.

    A zero row per wanted date stands in the day order, so dates without stations get their window too.
    """
    names = list(error_sums())
    choices = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.lit(n).alias("N"), F.lit(a).alias("alpha"))
        for v, pairs in grid.items() for n, a in pairs
    ])
    marks = frames.select("i_step", F.col("date_fin").alias("dates"), F.inline(choices)).select(
        "i_step", "dates", "variable", "N", "alpha", *[F.lit(0.0).alias(c) for c in names], F.lit(True).alias("mark"))
    rows = daily.select(
        "i_step", "dates", "variable", "N", "alpha", *names, F.lit(False).alias("mark")).unionByName(marks)
    span = Window.partitionBy("i_step", "variable", "N", "alpha").orderBy(F.unix_date("dates")).rangeBetween(
        -(window - 1), 0)
    summed = rows.select(
        F.col("dates").alias("date_fin"), "i_step", "variable", "N", "alpha", "mark",
        *[F.sum(c).over(span).alias(c) for c in names])
    return summed.filter(F.col("mark") & (F.col("n_obs") > 0.5)).drop("mark")


def best_params(errors: DataFrame, keys: list[str], count: str = "n_obs") -> DataFrame:
    """(N, alpha) of least mean absolute error; errors equal to six decimals go to the lower N, then alpha."""
    mae = F.col("sum_abs") / F.col(count)
    best = errors.groupBy(*keys, "variable").agg(
        F.min(F.struct(F.round(mae, 6).alias("even"), F.col("N"), F.col("alpha"), mae.alias("mae"))).alias("b"))
    return best.select(*keys, "variable", F.col("b.N").alias("N"), F.col("b.alpha").alias("alpha"), F.col("b.mae").alias("mae"))


def _best_rows(units: DataFrame, plan: wn.Plan, p: InterpolationParams) -> DataFrame:
    """One row per window and variable from station-days with ``i_step, first, slot`` (their unit and place in it) and ``dates``."""
    keys = ["i_step", "first", "slot", "dates"]
    sources = ip.as_sources(units, keys, p)
    # A unit is cut by its fullest day.
    counts = sources.groupBy("i_step", "first", "dates").agg(F.count(F.lit(1)).alias("n")).groupBy("i_step", "first").agg(
        F.ceil(F.max("n") / STATIONS_PER_CHUNK).cast("int").alias("chunks"))
    chunked = sources.join(counts, ["i_step", "first"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    used = {v: ip.SOURCE_VALUES[v] for v in plan.grid}
    unit = F.concat_ws(" ", "i_step", "first", "chunk")
    rows = chunked.select(
        "i_step", F.col("first").cast("long"), F.col("slot").cast("long"), "chunks", unit.alias("_unit"), F.concat_ws(" ", unit, "dates").alias("_set"),
        F.col("s_id").cast("string").alias("s_id"), (F.pmod(F.xxhash64("s_id"), F.col("chunks")) == F.col("chunk")).alias("is_target"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in ("sx", "sy", "sz", *dict.fromkeys(used.values()))])
    numbers = _numbers(p)
    kind = units.schema["i_step"].dataType.simpleString()
    schema = f"i_step {kind}, day int, variable string, N double, alpha double, mae double, window array<double>, today array<double>"
    sets = nb.place(rows, ["_unit"]).sortWithinPartitions("_unit", "_set")
    return sets.mapInArrow(lambda batches: wn.best_rows(batches, plan, used, numbers), schema + ", slot int, part array<double>")


def _joined(found: DataFrame, plan: wn.Plan) -> DataFrame:
    """Rows of windows, with those of units that came in chunks."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    parts = found.where("part is not null").select("i_step", "day", "variable", "slot", "part").repartition("i_step", "day").sortWithinPartitions("i_step", "day")
    whole = found.where("part is null").unionByName(parts.mapInArrow(lambda batches: wn.joined_rows(batches, plan), schema))
    return whole.select(F.date_from_unix_date("day").alias("date_fin"), "i_step", "variable", "N", "alpha", "mae", "window", "today")


def _plan(grid: Grid, window: int, ends: np.ndarray | None) -> wn.Plan:
    return wn.Plan({v: tuple(sorted(pairs)) for v, pairs in grid.items()}, tuple(error_sums()), STRETCH_DAYS, window, ends)


def calibrated_windows(
    placed: DataFrame, wanted: DataFrame, grid: Grid, path: str, window: int = WINDOW_DAYS, p: InterpolationParams = DEFAULTS
) -> DataFrame:
    """Best choice per variable for each window end and partition, with the error sums of the window and of its last day.

    ``placed`` holds masked station-days of each partition (``dates, i_step``); ``path`` is a folder for what the tasks put out.
    The wanted ``date_fin`` are known to every task: they are days of a calendar.
    """
    ends = np.array(sorted(r[0] for r in wanted.select(F.unix_date("date_fin")).distinct().collect() if r[0] is not None), np.int64)
    plan = _plan(grid, window, ends)
    day = F.unix_date("dates")
    inside = wanted.select(F.explode(F.sequence(F.date_sub("date_fin", window - 1), "date_fin")).alias("dates")).distinct()
    block = F.explode(F.sequence(F.floor(day / STRETCH_DAYS), F.floor((day + window - 1) / STRETCH_DAYS)))
    units = placed.join(F.broadcast(inside), "dates", "left_semi").withColumn("block", block).withColumns({
        "first": F.col("block") * STRETCH_DAYS - (window - 1), "slot": day - F.col("block") * STRETCH_DAYS + (window - 1)})
    found = _best_rows(units, plan, p)
    found.write.mode("overwrite").parquet(path)
    return _joined(placed.sparkSession.read.schema(found.schema).parquet(path), plan)


def best_of_windows(days: DataFrame, grid: Grid, path: str, p: InterpolationParams = DEFAULTS) -> DataFrame:
    """The same where each row of ``days`` says which window it is in (``date_fin``), and windows have nothing in common."""
    plan = _plan(grid, 0, None)
    units = days.withColumns({"first": F.unix_date("date_fin"), "slot": (F.col("dates") == F.col("date_fin")).cast("int")})
    found = _best_rows(units, plan, p)
    found.write.mode("overwrite").parquet(path)
    return _joined(days.sparkSession.read.schema(found.schema).parquet(path), plan)


def moved_windows(placed: DataFrame, wanted: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """(date_fin, i_step) of the wanted windows that hold days of a station from before and after a change of its attributes.

    A station's days between two changes are an island; a window meets two of them if it ends on the later one's first day or
    after, and begins on the earlier one's last day or before.
    """
    attrs = F.struct(*st.STATION_ATTRS)
    order = Window.partitionBy("i_step", "stationID").orderBy("dates")
    before = placed.select("i_step", "stationID", "dates", attrs.alias("a")).withColumns({"was": F.lag("a").over(order), "seen": F.lag("dates").over(order)})
    moves = before.where(F.col("was").isNotNull() & ~F.col("was").eqNullSafe(F.col("a")))
    spans = moves.where(F.datediff("dates", "seen") < window).select("i_step", F.explode(F.sequence("dates", F.date_add("seen", window - 1))).alias("date_fin"))
    return spans.distinct().join(wanted.select("date_fin").distinct(), "date_fin", "left_semi")


def with_latest_attributes(
    windows: DataFrame, placed: DataFrame, moved: DataFrame, grid: Grid, path: str, window: int = WINDOW_DAYS, p: InterpolationParams = DEFAULTS
) -> DataFrame:
    """Calibrated windows where those of ``moved`` are worked out again, with each station's latest attributes on all its days."""
    # A moved window has at most ``window`` days: its rows are listed by an equi-join on partition and day.
    days = moved.withColumn("dates", F.explode(F.sequence(F.date_sub("date_fin", window - 1), "date_fin")))
    frames = st.latest_attributes(placed.join(days, ["i_step", "dates"]), ["date_fin", "i_step", "stationID"])
    keys = ["date_fin", "i_step"]
    return windows.join(moved, keys, "left_anti").unionByName(best_of_windows(frames, grid, path, p))


def sums_in(windows: DataFrame, column: str) -> DataFrame:
    """The sums that an array column holds, under their names."""
    return windows.select("*", *[F.col(column)[k].alias(name) for k, name in enumerate(error_sums())])


def calibrate(
    placed: DataFrame, wanted: DataFrame, grid: Grid, path: str, window: int = WINDOW_DAYS, p: InterpolationParams = DEFAULTS
) -> DataFrame:
    """Best parameters per variable for each window end and partition."""
    return chosen(calibrated_windows(placed, wanted, grid, path, window, p))


def chosen(windows: DataFrame) -> DataFrame:
    return windows.select("date_fin", "i_step", "variable", "N", "alpha", "mae")


def calibrate_frames(frames: DataFrame, grid: Grid, p: InterpolationParams = DEFAULTS) -> DataFrame:
    """The same from window frames, where a station may have moved inside a window.

    Errors are worked out for every window on its own, with the window's latest station attributes:
    for a few dates at a time.
    """
    errors = error_table(frames, ["date_fin", "i_step", "dates"], grid, p)
    names = list(error_sums())
    summed = errors.groupBy("date_fin", "i_step", "variable", "N", "alpha").agg(*[F.sum(c).alias(c) for c in names])
    return best_params(summed, ["date_fin", "i_step"])


def _station_steps(placed: DataFrame, window: int) -> DataFrame:
    """How many stations more a partition's window holds from day ``d`` on, and whether any reported on it."""
    order = Window.partitionBy("i_step", "stationID").orderBy("dates")
    seen = placed.select("i_step", "stationID", "dates").distinct()
    leaves = F.least(F.date_add("dates", window), F.coalesce(F.lead("dates").over(order), F.date_add("dates", window)))
    spans = seen.withColumn("leaves", leaves)
    return spans.select("i_step", F.inline(F.array(
        F.struct(F.col("dates").alias("d"), F.lit(1).alias("step")),
        F.struct(F.col("leaves").alias("d"), F.lit(-1).alias("step")),
    ))).groupBy("i_step", "d").agg(F.sum("step").alias("step"), (F.max("step") > 0).alias("reported"))


def _running_stations(steps: DataFrame, frames: DataFrame) -> DataFrame:
    marks = frames.select("i_step", F.col("date_fin").alias("d"), F.lit(0).cast("bigint").alias("step"), F.lit(True).alias("mark"))
    rows = steps.select("i_step", "d", "step", F.lit(False).alias("mark")).unionByName(marks)
    running = F.sum("step").over(Window.partitionBy("i_step").orderBy("d").rangeBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("n_stations", running).filter("mark").select(
        F.col("d").alias("date_fin"), "i_step", "n_stations")


def window_station_counts(placed: DataFrame, frames: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """Distinct stations per window, as a running sum of stations entering and leaving it."""
    return _running_stations(_station_steps(placed, window), frames)


def station_counts_in(obs: DataFrame, boxes: DataFrame, wanted: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """The same for the partitions whose buffered box holds the stations of ``obs``, without a row per station-day and partition.

    Stations in the same partitions enter and leave together: their steps are added up per set of partitions first, and only those sums
    are repeated under each partition of the set. A station that has been in different sets is placed day by day.
    """
    spots = obs.select("stationID", "x", "y").distinct()
    sets = st.stations_in_partitions(spots, boxes).groupBy("stationID", "x", "y").agg(F.sort_array(F.collect_set("i_step")).alias("steps"))
    of_spot = spots.join(sets, ["stationID", "x", "y"], "left").select("stationID", F.coalesce("steps", F.array().cast(sets.schema["steps"].dataType)).alias("steps"))
    of_station = of_spot.groupBy("stationID").agg(F.min("steps").alias("steps"), (F.min("steps") != F.max("steps")).alias("moved"))
    of_station = tables.materialize(of_station, folders.new_folder(obs.sparkSession, "station_sets"))
    fixed = of_station.where("not moved and size(steps) > 0")
    # A set goes by the name of its least station.
    named = fixed.groupBy("steps").agg(F.min("stationID").alias("set"))
    at = fixed.join(named, "steps").select("stationID", "set")
    days = obs.select("stationID", "dates", "x", "y")
    here = days.join(at, "stationID").select(F.col("set").alias("i_step"), "stationID", "dates")
    steps = _station_steps(here, window).withColumnRenamed("i_step", "set").join(named, "set").select(
        F.explode("steps").alias("i_step"), "d", "step", "reported")
    moved = days.join(of_station.where("moved").select("stationID"), "stationID", "left_semi")
    steps = steps.unionByName(_station_steps(st.stations_in_partitions(moved, boxes), window)).groupBy("i_step", "d").agg(
        F.sum("step").alias("step"), F.max("reported").alias("reported"))
    steps = tables.materialize(steps, folders.new_folder(obs.sparkSession, "station_steps"))
    frames = window_frames(steps.where("reported").select("i_step", F.col("d").alias("dates")), wanted, window)
    return _running_stations(steps, frames)


def calibration_table(best: DataFrame, station_counts: DataFrame, boxes: DataFrame) -> DataFrame:
    """One row of 24 columns per day and partition."""
    picks = []
    for variable, short in SHORT_NAMES.items():
        for part, source in (("n", "N"), ("alpha", "alpha"), ("mae", "mae")):
            picks.append(F.max(F.when(F.col("variable") == variable, F.col(source))).alias(f"{short}_{part}"))
    wide = best.groupBy("date_fin", "i_step").agg(*picks)
    d = F.col("date_fin")
    ordered = [f"{s}_{k}" for k in ("n", "alpha", "mae") for s in SHORT_NAMES.values()]
    b = STATION_BUFFER_M
    return wide.join(station_counts, ["date_fin", "i_step"]).join(boxes, "i_step").select(
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"), "i_step",
        F.col("n_stations").cast("int").alias("n_stations"), *ordered,
        geo.box_wkt(F.col("xmin") - b, F.col("ymin") - b, F.col("xmax") + b, F.col("ymax") + b).alias("buffer"),
        geo.box_wkt(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")).alias("topo_bbox"),
        "topo_ncells", cal.interpolator_name(d, F.col("i_step")).alias("interpolator_path"),
    )


def params_wide(best: DataFrame) -> DataFrame:
    """Calibrated parameters as ``n_<v>, alpha_<v>`` columns for the interpolation; defaults where none were found."""
    picks = []
    for variable in CALIBRATED:
        here = F.col("variable") == variable
        n, alpha = DEFAULTS.smoothing[variable]
        picks += [
            F.coalesce(F.max(F.when(here, F.col("N"))), F.lit(n)).alias(f"n_{variable}"),
            F.coalesce(F.max(F.when(here, F.col("alpha"))), F.lit(alpha)).alias(f"alpha_{variable}"),
        ]
    wide = best.groupBy(F.col("date_fin").alias("dates"), "i_step").agg(*picks)
    n, alpha = DEFAULTS.smoothing["Wind"]
    return wide.withColumns({"n_Wind": F.lit(n), "alpha_Wind": F.lit(alpha)})


def month_windows(dates: DataFrame) -> DataFrame:
    """Calibration study: windows of 16 days from each month's first day, named by their last day."""
    first = F.trunc("dates", "MM").cast("date")
    return dates.select(first.alias("date_ini"), F.date_add(first, 15).alias("date_fin")).distinct()


def summary(calibrations: DataFrame) -> DataFrame:
    """Mean, exact median, least and greatest of every error column per partition, and the first box."""
    aggs = [
        fn(c).alias(f"{c}_{name}")
        for c in calibrations.columns if c.endswith("mae")
        for name, fn in (("mean", F.avg), ("median", F.median), ("min", F.min), ("max", F.max))
    ]
    if "topo_bbox" in calibrations.columns:
        aggs.append(F.min_by("topo_bbox", F.struct("year", "month", "day")).alias("topo_bbox"))
    return calibrations.groupBy("i_step").agg(*aggs)


def histograms(df: DataFrame, widths: dict[str, float]) -> DataFrame:
    """Per column name, counts in bins of its width, and counts relative to its fullest bin; one scan for all."""
    bins = F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.floor(F.col(c) / w).cast("bigint").alias("bin")) for c, w in widths.items()]))
    counts = df.select(bins).groupBy("name", "bin").agg(F.count(F.lit(1)).alias("n"))
    # One row per bin is left: a name's window is small.
    return counts.withColumn("ncount", F.col("n") / F.max("n").over(Window.partitionBy("name")))


def histograms_2d(df: DataFrame, pairs: dict[str, tuple[str, str]], wx: float, wy: float, facets: list[str]) -> DataFrame:
    """Per name, counts over bins of its two columns for each facet; one scan for all."""
    bins = F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.floor(F.col(x) / wx).cast("bigint").alias("bx"), F.floor(F.col(y) / wy).cast("bigint").alias("by"))
        for name, (x, y) in pairs.items()]))
    return df.select(*facets, bins).groupBy("name", "bx", "by", *facets).agg(F.count(F.lit(1)).alias("n"))
