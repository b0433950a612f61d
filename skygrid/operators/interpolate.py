"""Weather at targets from weighted sums over the stations in reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skygrid.functions import geo, weather
from skygrid.operators import neighbours as nb, reach as rc
from skygrid.params import DEFAULTS, InterpolationParams

# The source column that is not NULL where a source counts for the variable.
SOURCE_VALUES = {
    "MinTemperature": "s_tmin", "MaxTemperature": "s_tmax", "DewTemperature": "s_tdew",
    "PrecipitationEvent": "s_event", "PrecipitationAmount": "s_amount", "Wind": "s_u",
}
# Where cells of a partition's chunk are placed, with all days of a slice.
PLACE = ("i_step", "chunk", "slice")
SLICE_DAYS = 32
# Cells of a place: its station-days move once for all of them.
CELLS_PER_CHUNK = 8192
# Shares this close to the event cut count as reaching it.
EVEN = 1e-9
TEMPERATURES = ("MinTemperature", "MaxTemperature", "DewTemperature")


def as_sources(obs: DataFrame, keys: list[str], p: InterpolationParams = DEFAULTS) -> DataFrame:
    """Station-days as sources: position, height in km, and one column per interpolated quantity."""
    rain = F.col("Precipitation")
    turn = F.radians("WindDirection")
    return obs.select(
        *keys, F.col("stationID").alias("s_id"), F.col("x").alias("sx"), F.col("y").alias("sy"),
        (F.col("elevation") / 1000.0).alias("sz"),
        F.col("MinTemperature").alias("s_tmin"), F.col("MaxTemperature").alias("s_tmax"),
        F.col("DewTemperature").alias("s_tdew"),
        F.when(rain.isNotNull(), F.when(rain > p.wet_threshold_mm, 1.0).otherwise(0.0)).alias("s_event"),
        F.when(rain > p.wet_threshold_mm, rain).alias("s_amount"),
        (F.col("WindSpeed") * F.sin(turn)).alias("s_u"), (F.col("WindSpeed") * F.cos(turn)).alias("s_v"),
    )


def rain_slopes(sources: DataFrame, group: list[str]) -> DataFrame:
    """Change of log rain per km of height over the wet stations of a group, in one aggregate.

    Rain that is exponential in height has (Pi-Pj)/(Pi+Pj) = tanh(b (zi-zj) / 2) for every pair, so the
    slope of log rain gives the pair regression without forming pairs.
    """
    wet = F.col("s_amount").isNotNull()
    z, q = F.when(wet, F.col("sz")), F.ln("s_amount")
    sums = sources.groupBy(*group).agg(
        F.count("s_amount").alias("n"), F.covar_pop(z, q).alias("zq"), F.var_pop(z).alias("zz"))
    enough = (F.col("n") >= DEFAULTS.regression_min_stations) & (F.col("zz") > DEFAULTS.regression_min_variance_km2)
    return sums.select(*group, F.when(enough, F.col("zq") / F.col("zz")).otherwise(0.0).alias("rain_slope"))


Smoothing = dict[str, tuple[Column, Column]]


def fixed_smoothing(variables, p: InterpolationParams = DEFAULTS) -> Smoothing:
    """The default station count and shape of each variable, as literals."""
    return {v: (F.lit(p.smoothing[v][0]), F.lit(p.smoothing[v][1])) for v in variables}


def column_smoothing(variables) -> Smoothing:
    """Station count and shape from the targets' own columns ``n_<v>, alpha_<v>``."""
    return {v: (F.col(f"n_{v}"), F.col(f"alpha_{v}")) for v in variables}


def _weight(v: str, alpha: Column) -> Column:
    w = nb.gaussian_weight(F.col("r2"), F.col(f"rp2_{v}"), alpha)
    return F.when(F.col(SOURCE_VALUES[v]).isNotNull() & (w > 0), w)


def moment_sums(variables: list[str], smoothing: Smoothing, p: InterpolationParams = DEFAULTS) -> list[Column]:
    """Weighted sums of each variable; heights are relative to the target's."""
    dz = F.col("sz") - F.col("z")
    out: list[Column] = []
    for v in variables:
        w, value = _weight(v, smoothing[v][1]), F.col(SOURCE_VALUES[v])
        out.append(F.sum(w).alias(f"w_{v}"))
        if v in TEMPERATURES:
            out += [
                F.count(w).alias(f"c_{v}"), F.sum(w * dz).alias(f"wz_{v}"), F.sum(w * value).alias(f"wt_{v}"),
                F.sum(w * dz * dz).alias(f"wzz_{v}"), F.sum(w * dz * value).alias(f"wzt_{v}"),
            ]
        elif v == "PrecipitationAmount":
            f = F.greatest(F.lit(-p.amount_max_f), F.least(
                F.lit(p.amount_max_f), F.tanh(-F.col("rain_slope") * dz / 2.0)))
            out.append(F.sum(w * value * (1.0 + f) / (1.0 - f)).alias(f"wt_{v}"))
        elif v == "Wind":
            out += [F.sum(w * F.col("s_u")).alias("wu_Wind"), F.sum(w * F.col("s_v")).alias("wv_Wind")]
        else:
            out.append(F.sum(w * value).alias(f"wt_{v}"))
    return out


def predicted(v: str, p: InterpolationParams = DEFAULTS) -> Column:
    """Value at the target from its sums; NULL where no station is in reach."""
    w = F.when(F.col(f"w_{v}") > 0, F.col(f"w_{v}"))
    if v in TEMPERATURES:
        mean_z, mean_t = F.col(f"wz_{v}") / w, F.col(f"wt_{v}") / w
        var_z = F.col(f"wzz_{v}") / w - mean_z * mean_z
        cov = F.col(f"wzt_{v}") / w - mean_z * mean_t
        enough = (F.col(f"c_{v}") >= p.regression_min_stations) & (var_z > p.regression_min_variance_km2)
        return mean_t - F.when(enough, cov / F.when(var_z > 0, var_z)).otherwise(0.0) * mean_z
    share = F.col(f"wt_{v}") / w
    if v == "PrecipitationEvent":
        # Stations at equal distances make exact halves; the last bit of a sum must not decide them.
        return F.when(share >= p.event_cut - EVEN, 1.0).when(share.isNotNull(), 0.0)
    return share


def wind_speed() -> Column:
    w = F.when(F.col("w_Wind") > 0, F.col("w_Wind"))
    u, v = F.col("wu_Wind") / w, F.col("wv_Wind") / w
    return F.sqrt(u * u + v * v)


def wind_direction() -> Column:
    u, v = F.col("wu_Wind"), F.col("wv_Wind")
    return F.when(F.col("w_Wind") > 0, F.pmod(F.degrees(F.atan2(u, v)) + 360.0, F.lit(360.0)))


def weighted_moments(
    targets: DataFrame, sources: DataFrame, keys: list[str], ids: list[str], variables: list[str], smoothing: Smoothing,
    leave_out: tuple[str, str] | None = None, p: InterpolationParams = DEFAULTS,
) -> DataFrame:
    """Radius passes and one more pass for the sums. Targets carry x, y, z."""
    values = {v: SOURCE_VALUES[v] for v in variables}
    reached = nb.estimate_radii(targets, sources, keys, ids, values, smoothing, leave_out, p)
    pairs = nb.near_pairs(reached, sources, keys, nb.widest(variables), leave_out)
    return pairs.groupBy(*ids).agg(*nb.carried(targets, ids), *moment_sums(variables, smoothing, p))


def chunked_cells(topo: DataFrame, days: DataFrame, columns: list[Column | str]) -> DataFrame:
    """Cells with ``columns``, once per slice of days in which their partition has any, in the places of their chunk and slice.

    A slice is ``SLICE_DAYS`` days, so what moves here is that part of the cell-days.
    """
    counts = nb.chunk_counts(topo.withColumnRenamed("partition", "i_step"), ["i_step"], CELLS_PER_CHUNK)
    spread = F.pmod(F.xxhash64("cell_id"), F.col("chunks")).cast("int")
    slices = days.select("i_step", slice_of("dates").alias("slice")).distinct()
    cells = topo.withColumnRenamed("partition", "i_step").join(counts, "i_step").select("i_step", spread.alias("chunk"), *columns)
    return nb.place(cells.join(slices, "i_step"), list(PLACE))


def slice_of(day: str) -> Column:
    return F.floor(F.unix_date(day) / SLICE_DAYS).cast("int")


def interpolate(
    topo: DataFrame, obs: DataFrame, params: DataFrame | None = None,
    variables: tuple[str, ...] = tuple(SOURCE_VALUES), p: InterpolationParams = DEFAULTS,
) -> DataFrame:
    """Weighted sums for each cell on each date its partition has stations.

    ``obs`` holds station-days with ``dates`` and ``i_step``; ``params``, when given, one row of
    ``n_<v>, alpha_<v>`` per date and partition (only those are interpolated, inner join).
    Cells once per slice of days and the station-days of that slice meet in one place, where the cell-days are made (``reach``); they are
    never shuffled. With all variables, terrain travels with the cells, for ``finish_cells``.
    """
    variables = list(variables)
    group = ["dates", "i_step"]
    kind = obs.schema["i_step"].dataType
    topo = topo.withColumn("partition", F.col("partition").cast(kind))
    counts = nb.chunk_counts(topo.withColumnRenamed("partition", "i_step"), ["i_step"], CELLS_PER_CHUNK)
    values = {v: SOURCE_VALUES[v] for v in variables}
    used = list(dict.fromkeys([*values.values(), *(["s_v"] if "Wind" in variables else [])]))
    sources = as_sources(obs, group, p)
    frames = obs.select(*group).distinct() if params is None else params.select(*group, *[f"{c}_{v}" for v in variables for c in ("n", "alpha")])
    if "PrecipitationAmount" in variables:
        frames = frames.join(rain_slopes(sources, group), group, "left").withColumn(
            "rain_slope", F.coalesce("rain_slope", F.lit(0.0)))
    # A day goes along as a row of its own, so that what it is smoothed with is not joined to each of its station-days.
    rows = frames.withColumn("is_day", F.lit(True)).unionByName(
        sources.select(*group, "sx", "sy", "sz", *used, F.lit(False).alias("is_day")), allowMissingColumns=True)
    rows = rows.where("dates is not null").withColumn("slice", slice_of("dates"))
    rows = nb.repeat_sources(rows, counts, ["i_step"])
    # Both sides may come from one frame: the keys of one are named anew.
    rows = nb.place(rows.withColumns({k: F.col(k).alias(k) for k in PLACE}), list(PLACE))
    carried = set(variables) == set(SOURCE_VALUES) and {"slope", "aspect", "TPI"} <= set(topo.columns)
    z = (F.col("elevation") / 1000.0).alias("z")
    base = terrain_light(topo, ("partition", "x", "y")) if carried else topo
    cells = chunked_cells(base, frames, ["cell_id", "x", "y", z, *([F.struct(*TERRAIN).alias("terrain")] if carried else [])])
    names = ["dates", *PLACE, "cell_id", "x", "y", "z", *(["terrain"] if carried else []), *rc.sum_names(variables)]
    types = {f.name: f.dataType for f in cells.schema} | {"dates": T.DateType()}
    if carried:
        # A cell-day has the terrain of each row that its cell has.
        types["terrain"] = T.ArrayType(types["terrain"])
    schema = T.StructType([T.StructField(c, types.get(c, T.LongType() if c.startswith("c_") else T.DoubleType())) for c in names])
    numbers = {"radius": p.initial_radius_m, "passes": p.radius_passes, "max_f": p.amount_max_f}
    work = rc.place_sums(
        variables, values, {v: p.smoothing[v] for v in variables} if params is None else None, numbers, names,
        {f.name: f.type for f in to_arrow_schema(schema)})
    return cells.groupBy(*PLACE).cogroup(rows.groupBy(*PLACE)).applyInArrow(work, schema)


# What ``terrain_light`` puts out beside the cell and its place.
TERRAIN = ("lat", "elevation", "slope", "aspect", "TPI", "geom_hex", "geom_text", "lat_tilted", "shift", "pressure")


def terrain_light(topo: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the derived variables need of a cell and no date changes, worked out once per cell."""
    _, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    cells = topo.select(
        "cell_id", *keep, F.radians(lat).alias("lat"), "elevation", "slope", "aspect", "TPI",
        geo.point_wkb_hex(F.col("x"), F.col("y")).alias("geom_hex"), geo.point_wkt(F.col("x"), F.col("y")).alias("geom_text"))
    tilted, shift = weather.equivalent_latitude(F.col("lat"), F.col("slope"), F.col("aspect"))
    return cells.withColumns({"lat_tilted": tilted, "shift": shift, "pressure": weather.air_pressure(F.col("elevation"))})


def finish_cells(moments: DataFrame, topo: DataFrame, p: InterpolationParams = DEFAULTS, days: DataFrame | None = None) -> DataFrame:
    """Published variables of each cell and date from the sums.

    With ``days``, the terrain that came with the cell-days is used where they are; without, cells and cell-days are shuffled by cell.
    """
    carried = days is not None and "terrain" in moments.columns
    base = moments.where("cell_id is not null").select(
        "dates", "i_step", "cell_id", "x", "y", *([F.inline("terrain")] if carried else []),
        predicted("MinTemperature", p).alias("MinTemperature"), predicted("MaxTemperature", p).alias("_max"),
        predicted("DewTemperature", p).alias("dew"), predicted("PrecipitationEvent", p).alias("event"),
        predicted("PrecipitationAmount", p).alias("amount"),
        wind_speed().alias("WindSpeed"), wind_direction().alias("WindDirection"),
    )
    if not carried:
        base = base.join(terrain_light(topo), "cell_id")
    # Smoothing is per variable: the maximum is kept at or above the minimum.
    base = base.withColumn("MaxTemperature", F.greatest("MinTemperature", "_max"))
    base = base.withColumns({
        "DOY": F.dayofyear("dates"),
        "Precipitation": F.when(F.col("event") == 1, F.coalesce("amount", F.lit(0.0))).when(F.col("event") == 0, 0.0),
    })
    lo, hi, dew, doy = F.col("MinTemperature"), F.col("MaxTemperature"), F.col("dew"), F.col("DOY").cast("double")
    base = base.withColumns({"dec": weather.declination(doy), "dist": weather.sun_distance(doy)})
    base = base.withColumn("half_day", weather.half_day(F.col("lat"), F.col("dec")))
    base = base.withColumns({
        "flat": weather.flat_from_angles(F.col("lat"), F.col("dec"), F.col("dist"), F.col("half_day"), p),
        "potential": weather.slope_from_angles(
            F.col("lat_tilted"), F.col("shift"), F.col("dec"), F.col("dist"), F.col("half_day"), p),
        "e_dew": weather.vapour_pressure(dew), "e_min": weather.vapour_pressure(lo), "e_max": weather.vapour_pressure(hi),
        "MeanTemperature": weather.mean_temperature(lo, hi),
    })
    e_dew = F.col("e_dew")
    base = base.withColumn("Radiation", weather.radiation_from(
        F.col("potential"), F.col("flat"), F.col("dist"), F.col("half_day"), F.col("pressure"), hi - lo, e_dew,
        F.col("Precipitation"), p))
    base = base.withColumn("PET", weather.pet_from(
        F.col("flat"), F.col("Radiation"), F.col("elevation"), F.col("pressure"), lo, hi, F.col("e_min"), F.col("e_max"),
        e_dew, F.col("WindSpeed"), p))
    d = F.col("dates")
    return base.select(
        "dates", F.col("i_step").alias("partition"), "cell_id", "x", "y", "elevation", "slope", "aspect", "TPI", "DOY",
        "MeanTemperature", "MinTemperature", "MaxTemperature",
        weather.humidity_from(e_dew, weather.vapour_pressure(F.col("MeanTemperature"))).alias("MeanRelativeHumidity"),
        weather.humidity_from(e_dew, F.col("e_max")).alias("MinRelativeHumidity"),
        weather.humidity_from(e_dew, F.col("e_min")).alias("MaxRelativeHumidity"),
        "Precipitation", "Radiation", "WindSpeed", "WindDirection", "PET",
        weather.thermal_amplitude(lo, hi).alias("ThermalAmplitude"),
        F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"), "geom_hex", "geom_text",
    )
