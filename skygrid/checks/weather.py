"""Interpolation, calibration and cross-validation over the whole test tables.

Cell-days are many, so results are shown per date (or per day and partition): every cell of every date
is interpolated, and the summary of each date is compared.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from skygrid.checks.geometry import LONLAT_STEP, members
from skygrid.checks.layout import CELL_NUMS, placed_table, stored, topo_table
from skygrid.checks.registry import query, sql
from skygrid.functions import geo, weather
from skygrid.operators import calibrate as cb, grid, interpolate as ip, neighbours as nb, stations as st, validate as va
from skygrid.params import CALIBRATED, DAILY_GRID, DEFAULTS, STUDY_GRID
from skygrid.schema import CELL_VARIABLES
from skygrid.sources import adapters as ad, folders, tables

# ---- SQL twins of the method, written from the papers' formulas ------------------------------------

SOURCES_SQL = """select dates, i_step, stationid as s_id, x as sx, y as sy, elevation / 1000e0 as sz, mintemperature as s_tmin,
  maxtemperature as s_tmax, dewtemperature as s_tdew,
  case when precipitation > 0 then 1e0 when precipitation <= 0 then 0e0 end as s_event, case when precipitation > 0 then precipitation end as s_amount,
  windspeed * sin(radians(winddirection)) as s_u, windspeed * cos(radians(winddirection)) as s_v from v_placed"""
# Log-rain slope from centred pairs of the wet stations' own table.
RAIN_SQL = """select dates, i_step, case when count(*) >= 5 and var_pop(sz) > 1e-2 then regr_slope(ln(s_amount), sz) else 0e0 end as b
  from v_src where s_amount is not null group by dates, i_step"""
VALUE = ip.SOURCE_VALUES


def _w(v, n, a, rp):
    return f"case when {VALUE[v]} is not null and r <= {rp} then exp(-({a}) * power(r / {rp}, 2)) - exp(-({a})) end"


def radius_steps(target: str, source: str, keys: str, ids: str, variables: dict[str, tuple[str, str]], leave_out: str = "",
                 name: str = "") -> tuple[dict[str, str], str]:
    """Three passes of the radius as steps; ``variables`` maps a variable to (N, alpha) as SQL."""
    ids_t = ", ".join(f"t.{c}" for c in ids.split())
    join = " and ".join(f"t.{k} = s.{k}" for k in keys.split()) + leave_out
    steps = {f"{name}p0": f"select *, {', '.join(f'140000e0 as rp_{v}' for v in variables)} from {target}"}
    for k in (1, 2, 3):
        two = "2e0 * " if k < 3 else ""
        rps = ", ".join(f"t.rp_{v}" for v in variables)
        sums = ", ".join(f"sum({_w(v, n, a, 'rp_' + v)}) as w_{v}" for v, (n, a) in variables.items())
        new = ", ".join(
            f"""case when w_{v} > 0 then sqrt({two}({n}) / (w_{v} / ((1e0 - exp(-({a}))) / ({a}) - exp(-({a}))) / (pi() * power(rp_{v}, 2)) * pi()))
            else rp_{v} end as rp_{v}""" for v, (n, a) in variables.items())
        steps[f"{name}p{k}"] = f"""select {ids.replace(' ', ', ')}, {new} from (
          select {ids_t.replace('t.', '')}, {rps.replace('t.', '')}, {sums} from (
            select {ids_t}, {rps}, s.* exclude ({keys.replace(' ', ', ')}), sqrt(power(t.x - s.sx, 2) + power(t.y - s.sy, 2)) as r
            from {name}p{k - 1} t left join {source} s on {join})
          group by all)"""
    return steps, join


def moments_step(prev: str, source: str, join: str, keys: str, ids: str, variables: dict[str, tuple[str, str]]) -> str:
    """Predictions of each target from its weighted sums."""
    ids_t = ", ".join(f"t.{c}" for c in ids.split())
    sums, out = [], []
    for v, (n, a) in variables.items():
        w = f"({_w(v, n, a, 'rp_' + v)})"
        val = VALUE[v]
        pos = f"case when {w} > 0 then {w} end"
        if v in ip.TEMPERATURES:
            sums += [f"sum({pos}) as w_{v}", f"count({pos}) as c_{v}", f"sum({pos} * (sz - z)) as wz_{v}", f"sum({pos} * {val}) as wt_{v}",
                     f"sum({pos} * (sz - z) * (sz - z)) as wzz_{v}", f"sum({pos} * (sz - z) * {val}) as wzt_{v}"]
            var = f"(wzz_{v} / w_{v} - power(wz_{v} / w_{v}, 2))"
            out.append(f"""case when w_{v} > 0 then wt_{v} / w_{v} - case when c_{v} >= 5 and {var} > 1e-2
              then (wzt_{v} / w_{v} - wz_{v} / w_{v} * wt_{v} / w_{v}) / {var} else 0e0 end * wz_{v} / w_{v} end as {v}""")
        elif v == "PrecipitationAmount":
            f = "greatest(-6e-1, least(6e-1, 1e0 - 2e0 / (exp(coalesce(b, 0e0) * (z - sz)) + 1e0)))"
            sums += [f"sum({pos}) as w_{v}", f"sum({pos} * {val} * (1e0 + {f}) / (1e0 - {f})) as wt_{v}"]
            out.append(f"case when w_{v} > 0 then wt_{v} / w_{v} end as {v}")
        elif v == "Wind":
            sums += [f"sum({pos}) as w_{v}", f"sum({pos} * s_u) as wu", f"sum({pos} * s_v) as wv"]
            out += ["case when w_Wind > 0 then sqrt(power(wu / w_Wind, 2) + power(wv / w_Wind, 2)) end as WindSpeed",
                    "case when w_Wind > 0 then fmod(degrees(atan2(wu, wv)) + 360e0, 360e0) end as WindDirection"]
        else:
            sums += [f"sum({pos}) as w_{v}", f"sum({pos} * {val}) as wt_{v}"]
            out.append(f"case when w_{v} > 0 then case when wt_{v} / w_{v} >= 5e-1 - 1e-9 then 1e0 else 0e0 end end as {v}")
    return f"""select {ids.replace(' ', ', ')}, {', '.join(out)} from (select {ids.replace(' ', ', ')}, {', '.join(sums)} from (
        select t.*, s.* exclude ({keys.replace(' ', ', ')}), sqrt(power(t.x - s.sx, 2) + power(t.y - s.sy, 2)) as r
        from {prev} t left join {source} s on {join}) group by all)"""


def _default(variables):
    return {v: (f"{DEFAULTS.smoothing[v][0]!r}e0".replace(".0e0", "e0"), f"{DEFAULTS.smoothing[v][1]!r}e0".replace(".0e0", "e0")) for v in variables}


def day_steps(*variables: str) -> dict[str, str]:
    """All cells on all dates their partition has stations, down to predictions in ``v_day``."""
    params = _default(variables)
    ids = "dates i_step cell_id x y z b" if "PrecipitationAmount" in variables else "dates i_step cell_id x y z"
    rain = ", r.b" if "PrecipitationAmount" in variables else ""
    join_rain = " left join v_rain r on r.dates = f.dates and r.i_step = f.i_step" if rain else ""
    steps = {
        "v_src": SOURCES_SQL, "v_rain": RAIN_SQL,
        "v_cell_t": f"""select f.dates, f.i_step, c.cell_id, c.x, c.y, c.elevation / 1000e0 as z{rain}
          from v_topo c join (select distinct dates, i_step from v_src) f on f.i_step = c.partition{join_rain}""",
    }
    radius, join = radius_steps("v_cell_t", "v_src", "dates i_step", ids, params, name="c_")
    return steps | radius | {"v_day": moments_step("c_p3", "v_src", join, "dates i_step", ids, params)}


def day_moments(spark, sf, *variables):
    return ip.interpolate(topo_table(spark, sf), placed_table(spark, sf), variables=variables)


# ---- pairs and radii ----------------------------------------------------------------------------

_STATIC = {
    "v_st": "select m.i_step, s.stationid as s_id, s.x as sx, s.y as sy, s.elevation / 1000e0 as sz, 1e0 as s_tmin from v_member m join v_stations s on s.stationid = m.stationid",
    "v_ct": "select partition as i_step, cell_id, x, y, elevation / 1000e0 as z from v_topo",
    "v_pr": "select t.cell_id, s.s_id, sqrt(power(t.x - s.sx, 2) + power(t.y - s.sy, 2)) as r from v_ct t join v_st s on s.i_step = t.i_step",
}


def static_targets(spark, sf):
    return ad.topo(spark, sf).select(
        F.col("partition").alias("i_step"), "cell_id", "x", "y", (F.col("elevation") / 1000.0).alias("z"))


def static_sources(spark, sf):
    near = st.stations_in_partitions(ad.stations(spark, sf), grid.partition_boxes(ad.topo(spark, sf)))
    return near.select("i_step", F.col("stationID").alias("s_id"), F.col("x").alias("sx"), F.col("y").alias("sy"), F.lit(1.0).alias("s_tmin"))


def static_chunks(spark, sf):
    """Cells and stations of partitions, by chunk."""
    targets, sources = static_targets(spark, sf), static_sources(spark, sf)
    counts = nb.chunk_counts(targets, ["i_step"])
    return nb.chunk_targets(targets, ["i_step"], "cell_id"), nb.repeat_sources(sources, counts, ["i_step"])


def static_pairs(spark, sf, reach):
    return nb.near_pairs(*static_chunks(spark, sf), ["i_step", "chunk"], F.lit(reach * reach))


@query("join_cell_station", sql("v_member v_topo", """
  select c.cell_id, count(r) as n, min(r) as nearest, avg(r) as mean_r from v_ct c left join (select * from v_pr where r <= 80000e0) p
  on p.cell_id = c.cell_id group by c.cell_id""", "", "cell_id n", "nearest mean_r", more=_STATIC))
def join_cell_station(spark, sf):
    return nb.near_stations(*static_chunks(spark, sf), ["i_step", "chunk"], "cell_id", "s_id", 80000.0)


@query("truncated_gaussian_weight", sql("v_member v_topo", """
  select cell_id, s_id, 1000e0 * case when r <= 140000e0 then exp(-3e0 * power(r / 140000e0, 2)) - exp(-3e0) else 0e0 end as w from v_pr
  where r <= 160000e0""", "s_id", "cell_id", "w", more=_STATIC))
def truncated_gaussian_weight(spark, sf):
    w = nb.gaussian_weight(F.col("r2"), F.lit(140000.0**2), F.lit(3.0))
    return static_pairs(spark, sf, 160000.0).filter(F.col("s_id").isNotNull()).select("cell_id", "s_id", (1000.0 * w).alias("w"))


_RADIUS, _ = radius_steps("v_ct", "v_st", "i_step", "i_step cell_id x y z", {"MinTemperature": ("30e0", "3e0")}, name="r_")


@query("estimate_radius", sql(
    "v_member v_topo", 'select cell_id, rp_MinTemperature / 1000e0 as radius_km from r_p3', "", "cell_id", "radius_km", more=_STATIC | _RADIUS))
def estimate_radius(spark, sf):
    targets = nb.chunk_targets(static_targets(spark, sf), ["i_step"], "cell_id")
    sources = nb.repeat_sources(static_sources(spark, sf), nb.chunk_counts(static_targets(spark, sf), ["i_step"]), ["i_step"])
    keys = ["i_step", "chunk"]
    radii = nb.estimate_radii(
        targets, sources, keys, keys + ["cell_id"], {"MinTemperature": "s_tmin"}, ip.fixed_smoothing(["MinTemperature"]))
    return radii.select("cell_id", (nb.radius_m("MinTemperature") / 1000.0).alias("radius_km"))


# ---- one variable at a time ---------------------------------------------------------------------

def _by_date(columns):
    return ", ".join(f"avg({c}) as {c}, count({c}) as n_{c}" for c in columns)


def _summed(df, columns):
    return df.groupBy("dates").agg(*[a for c in columns for a in (F.avg(c).alias(c), F.count(c).alias(f"n_{c}"))])


def _register(name, variables, outputs):
    outs = list(outputs)

    @query(name, sql("v_placed v_topo", f"select dates, {_by_date(outs)} from v_day group by dates", "dates",
                     " ".join(f"n_{c}" for c in outs), " ".join(outs), more=day_steps(*variables)))
    def run(spark, sf):
        moments = day_moments(spark, sf, *variables)
        return _summed(moments.select("dates", *[e().alias(c) for c, e in outputs.items()]), outs)


_register("interp_temperature", ip.TEMPERATURES, {v: (lambda v=v: ip.predicted(v)) for v in ip.TEMPERATURES})
_register("interp_precip_event", ["PrecipitationEvent"], {"PrecipitationEvent": lambda: ip.predicted("PrecipitationEvent")})
_register("interp_precip_amount", ["PrecipitationAmount"], {"PrecipitationAmount": lambda: ip.predicted("PrecipitationAmount")})
_register("interp_wind", ["Wind"], {"WindSpeed": ip.wind_speed, "WindDirection": ip.wind_direction})


# ---- derived variables --------------------------------------------------------------------------

def es(t):
    return f"6108e-4 * exp(17.27e0 * ({t}) / (({t}) + 237.3e0))"


@query("mean_temperature", sql("v_interp", """
  select cell_id, dates, 0.606e0 * maxtemperature + 0.394e0 * mintemperature as meantemperature from v_interp""", "dates", "cell_id", "MeanTemperature"))
def mean_temperature(spark, sf):
    return ad.interpolated(spark, sf).select("cell_id", "dates", weather.mean_temperature(
        F.col("MinTemperature"), F.col("MaxTemperature")).alias("MeanTemperature"))


@query("relative_humidity", sql("v_norm", f"""
  select stationid as "stationID", dates, least(100e0, 100e0 * ({es('dewtemperature')}) / ({es('maxtemperature')})) as lo,
    least(100e0, 100e0 * ({es('dewtemperature')}) / ({es('meantemperature')})) as mid,
    least(100e0, 100e0 * ({es('dewtemperature')}) / ({es('mintemperature')})) as hi from v_norm""", "stationID dates", "", "lo mid hi"))
def relative_humidity(spark, sf):
    dew = F.col("DewTemperature")
    return st.normalize(ad.obs(spark, sf)).select("stationID", "dates", *[
        weather.relative_humidity(dew, F.col(t)).alias(n)
        for n, t in (("lo", "MaxTemperature"), ("mid", "MeanTemperature"), ("hi", "MinTemperature"))])


def light_steps(source: str, dew: str) -> dict[str, str]:
    """Radiation and evapotranspiration of rows with terrain, latitude ``lat`` in degrees and weather."""
    clip = "least(1e0, greatest(-1e0, {}))"
    half = "acos(" + clip.format("-tan({}) * tan(dec)") + ")"
    pressure = "101.3e0 * power((293e0 - 65e-4 * elevation) / 293e0, 5.26e0)"
    return {
        "v_l1": f"""select *, {dew} as td, radians(lat) as phi, radians(slope) as si, radians(aspect) as ai,
          409e-3 * sin(2e0 * pi() / 365e0 * dayofyear(dates) - 1.39e0) as dec, 1e0 + 33e-3 * cos(2e0 * pi() / 365e0 * dayofyear(dates)) as dist from {source}""",
        "v_l2": f"""select *, {half.format('phi')} as h0, asin({clip.format('cos(si) * sin(phi) + sin(si) * cos(phi) * cos(ai)')}) as phi1,
          atan2(sin(si) * sin(ai), cos(si) * cos(phi) - sin(si) * sin(phi) * cos(ai)) as shift from v_l1""",
        "v_l3": f"""select *, {half.format('phi1')} as h1, 24e0 * 60e0 / pi() * 82e-3 * dist * (h0 * sin(phi) * sin(dec) + cos(phi) * cos(dec) * sin(h0)) as flat from v_l2""",
        "v_l4": "select *, greatest(-h1 - shift, -h0) as t0, least(h1 - shift, h0) as t1 from v_l3",
        "v_l5": f"""select *, greatest(0e0, 12e0 * 60e0 / pi() * 82e-3 * dist * case when t1 > t0 then
            sin(dec) * sin(phi1) * (t1 - t0) + cos(dec) * cos(phi1) * (sin(t1 + shift) - sin(t0 + shift)) else 0e0 end) as potential,
          greatest(0e0, maxtemperature - mintemperature) as amp, {pressure} as pz,
          flat / (82e-3 * 60e0 * dist * greatest(h0 * 24e0 / pi(), 1e-1)) as sine from v_l4""",
        "v_l6": f"""select *, potential * greatest(0e0, power(87e-2, pz / 101.3e0 / greatest(sine, 5e-2)) - 61e-3 * ({es('td')}))
            * (1e0 - 9e-1 * exp(-(31e-3 + 201e-3 * exp(-185e-3 * amp)) * power(amp, 1.5e0)))
            * case when precipitation > 0 then 75e-2 else 1e0 end as rad from v_l5""",
        "v_l7": f"""select *, (mintemperature + maxtemperature) / 2e0 as tm, ({es('mintemperature')} + {es('maxtemperature')}) / 2e0 as ess,
          {es('td')} as ea, 665e-6 * pz as gamma, coalesce(windspeed, 2e0) as u2,
          least(1e0, greatest(3e-1, rad / greatest(1e-1, (75e-2 + 2e-5 * elevation) * flat))) as ratio from v_l6""",
        "v_l8": f"""select *, 4098e0 * ({es('tm')}) / power(tm + 237.3e0, 2) as delta, 77e-2 * rad - 4.903e-9 * (power(maxtemperature + 273.16e0, 4)
            + power(mintemperature + 273.16e0, 4)) / 2e0 * (34e-2 - 14e-2 * sqrt(ea)) * (1.35e0 * ratio - 35e-2) as net from v_l7""",
        "v_light": """select *, greatest(0e0, (408e-3 * delta * net + gamma * 900e0 / (tm + 273e0) * u2 * (ess - ea)) / (delta + gamma * (1e0 + 34e-2 * u2)))
          as evap from v_l8""",
    }


_LIT = LONLAT_STEP | {"v_lit": "select i.*, l.lat from v_icells i join v_ll l on l.cell_id = i.cell_id"} | light_steps("v_lit", "mintemperature - 2e0")


def lit_cells(spark, sf):
    cells = ad.interpolated(spark, sf).join(ip.terrain_light(ad.topo(spark, sf)), "cell_id")
    dew, lo, hi = F.col("MinTemperature") - 2.0, F.col("MinTemperature"), F.col("MaxTemperature")
    lat, doy, z = F.col("lat"), F.dayofyear("dates").cast("double"), F.col("elevation")
    cells = cells.withColumns({
        "flat": weather.flat_radiation(lat, doy), "potential": weather.slope_radiation(lat, doy, F.col("slope"), F.col("aspect"))})
    cells = cells.withColumn("rad", weather.radiation(
        F.col("potential"), F.col("flat"), lat, doy, z, lo, hi, dew, F.col("Precipitation")))
    return cells.withColumn("evap", weather.pet(F.col("flat"), F.col("rad"), z, lo, hi, dew, F.col("WindSpeed")))


@query("radiation", sql("v_icells", "select * from v_light", "dates", "cell_id", "flat potential rad", more=_LIT))
def radiation(spark, sf):
    return lit_cells(spark, sf).select("cell_id", "dates", "flat", "potential", "rad")


@query("pet", sql("v_icells", "select * from v_light", "dates", "cell_id", "evap", more=_LIT))
def pet(spark, sf):
    return lit_cells(spark, sf).select("cell_id", "dates", "evap")


# ---- whole days ---------------------------------------------------------------------------------

_DAY = day_steps(*ip.SOURCE_VALUES) | LONLAT_STEP | {
    "v_pre": """select d.* exclude (mintemperature, maxtemperature), d.mintemperature, greatest(d.mintemperature, d.maxtemperature) as maxtemperature,
      case when precipitationevent = 1 then coalesce(precipitationamount, 0e0) when precipitationevent = 0 then 0e0 end as precipitation,
      t.elevation, t.slope, t.aspect, l.lat from v_day d join v_topo t on t.cell_id = d.cell_id join v_ll l on l.cell_id = d.cell_id""",
} | light_steps("v_pre", "dewtemperature") | {
    "v_full": f"""select dates, i_step, cell_id, mintemperature, maxtemperature, 0.606e0 * maxtemperature + 0.394e0 * mintemperature as meantemperature,
      least(100e0, 100e0 * ({es('td')}) / ({es('0.606e0 * maxtemperature + 0.394e0 * mintemperature')})) as meanrelativehumidity,
      least(100e0, 100e0 * ({es('td')}) / ({es('maxtemperature')})) as minrelativehumidity,
      least(100e0, 100e0 * ({es('td')}) / ({es('mintemperature')})) as maxrelativehumidity,
      precipitation, rad as radiation, windspeed, winddirection, evap as pet, maxtemperature - mintemperature as thermalamplitude from v_light""",
}


def interpolated_days(spark, sf):
    topo = topo_table(spark, sf)
    return ip.finish_cells(ip.interpolate(topo, placed_table(spark, sf)), topo, days=placed_table(spark, sf))


@query("interpolate_day", sql("v_placed v_topo", f"select dates, count(*) as n, {_by_date(CELL_VARIABLES)} from v_full group by dates", "dates",
    "n " + " ".join(f"n_{c}" for c in CELL_VARIABLES), CELL_NUMS, more=_DAY))
def interpolate_day(spark, sf):
    return interpolated_days(spark, sf).groupBy("dates").agg(F.count(F.lit(1)).alias("n"), *[
        a for c in CELL_VARIABLES for a in (F.avg(c).alias(c), F.count(c).alias(f"n_{c}"))])


@query("interpolated_regions", sql("v_placed v_topo v_inside", """
  select i.rid, d.dates, count(*) as n, avg(mintemperature) as mintemperature from v_day d join v_inside i on i.cell_id = d.cell_id
  group by i.rid, d.dates""", "dates", "rid n", "MinTemperature", more=day_steps("MinTemperature")))
def interpolated_regions(spark, sf):
    cells = day_moments(spark, sf, "MinTemperature").select("dates", "cell_id", ip.predicted("MinTemperature").alias("MinTemperature"))
    return cells.join(members(spark, sf), "cell_id").groupBy("rid", "dates").agg(
        F.count(F.lit(1)).alias("n"), F.avg("MinTemperature").alias("MinTemperature"))


# ---- leave-one-out and calibration --------------------------------------------------------------

def loo_steps(grid_: dict) -> dict[str, str]:
    """Leave-one-out predictions of all variables for all choices, down to ``v_loo``."""
    steps = {"v_src": SOURCES_SQL, "v_rain": RAIN_SQL}
    ends = []
    for k, (v, pairs) in enumerate(grid_.items()):
        values = ", ".join(f"({n}e0, {a}e0)" for n, a in pairs)
        steps[f"v_t{k}"] = f"""select t.dates, t.i_step, t.s_id as t_id, t.sx as x, t.sy as y, t.sz as z, t.{VALUE[v]} as obs, coalesce(r.b, 0e0) as b, g.nn, g.aa
          from v_src t left join v_rain r on r.dates = t.dates and r.i_step = t.i_step cross join (values {values}) g(nn, aa) where t.{VALUE[v]} is not null"""
        steps[f"v_s{k}"] = f"select * from v_src where {VALUE[v]} is not null"
        ids = "dates i_step t_id x y z obs b nn aa"
        params = {v: ("nn", "aa")}
        radius, join = radius_steps(f"v_t{k}", f"v_s{k}", "dates i_step", ids, params, " and t.t_id <> s.s_id", name=f"l{k}_")
        steps |= radius
        steps[f"v_m{k}"] = moments_step(f"l{k}_p3", f"v_s{k}", join, "dates i_step", ids, params)
        ends.append(f"select dates, i_step, t_id, '{v}' as variable, nn, aa, obs, {v} as pred from v_m{k}")
    steps["v_loo"] = " union all ".join(ends)
    return steps


_DEFAULT_GRID = {v: (DEFAULTS.smoothing[v],) for v in CALIBRATED}


@query("loo_predictions", sql("v_placed", """
  select variable, i_step, count(*) as n, count(pred) as n_pred, avg(pred) as pred, avg(abs(pred - obs)) as mae from v_loo group by variable, i_step""",
    "variable", "i_step n n_pred", "pred mae", more=loo_steps(_DEFAULT_GRID)))
def loo_predictions(spark, sf):
    here = placed_table(spark, sf)
    return cb.predictions_table(here, ["dates", "i_step"], _DEFAULT_GRID).groupBy("variable", "i_step").agg(
        F.count(F.lit(1)).alias("n"), F.count("pred").alias("n_pred"), F.avg("pred").alias("pred"),
        F.avg(F.abs(F.col("pred") - F.col("obs"))).alias("mae"))


# Leave-one-out over all 139 (or 825) choices takes plain SQL hours on whole tables, so these queries have none; the
# tests hold their steps against brute force on a small table.


def every_day(spark, sf):
    return ad.obs(spark, sf).select(F.col("dates").alias("date_fin"))


def calibrated(spark, sf):
    """Windows of every day with their best choices and error sums, written once for the queries that read them."""
    def write(path):
        tables.materialize(cb.calibrated_windows(placed_table(spark, sf), every_day(spark, sf), DAILY_GRID, folders.new_folder(spark, "rows"), 17), path)

    return spark.read.parquet(stored(spark, sf, "windows", write))


def window_counts(spark, sf):
    return cb.station_counts_in(ad.obs(spark, sf), grid.partition_boxes(ad.topo(spark, sf)), every_day(spark, sf), 17)


@query("calibrate")
def calibrate(spark, sf):
    return cb.chosen(calibrated(spark, sf)).groupBy("date_fin", "variable").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("N").alias("sum_n"), F.sum("alpha").alias("sum_alpha"), F.avg("mae").alias("mae"))


@query("calibrate_month")
def calibrate_month(spark, sf):
    # Only days inside a study window are scored, and windows have no day in common.
    days = placed_table(spark, sf).filter(F.dayofmonth("dates") <= 16).withColumn("date_fin", F.date_add(F.trunc("dates", "MM"), 15))
    return cb.chosen(cb.best_of_windows(days, STUDY_GRID, folders.new_folder(spark, "rows")))


@query("calibration_table")
def calibration_table(spark, sf):
    # The two outlines are checked by wkt_text, where coordinates are rounded first.
    return cb.calibration_table(cb.chosen(calibrated(spark, sf)), window_counts(spark, sf), grid.partition_boxes(ad.topo(spark, sf))).drop("buffer", "topo_bbox")


@query("cv_tables")
def cv_tables(spark, sf):
    return va.cv_tables(calibrated(spark, sf), window_counts(spark, sf)).groupBy("dates", "variable", "stat").agg(
        F.count_distinct("interpolator_id").alias("partitions"), F.count("value").alias("n_values"), F.avg("value").alias("value"))
