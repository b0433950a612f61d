"""Joins, aggregates, windows and reshaping of station and calibration tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from skygrid.checks.geometry import members
from skygrid.checks.layout import CELL_NUMS, boxes_table, masked, placed_table, stored
from skygrid.checks.registry import query, sql
from skygrid.checks.weather import loo_steps
from skygrid.functions import columns
from skygrid.operators import calibrate as cb, grid, neighbours as nb, regions as rg, stations as st, validate as va
from skygrid.params import DEFAULTS, SHORT_NAMES
from skygrid.schema import CELL_VARIABLES
from skygrid.sources import adapters as ad, folders, tables


def n_rows():
    return F.count(F.lit(1)).alias("n")


@query("black_hole_sums", sql("v_sums", """
  select stationid as "stationID", psum as precipitation_sum, wsum as windspeed_sum from v_sums""",
    "stationID", "", "Precipitation_sum WindSpeed_sum"))
def black_hole_sums(spark, sf):
    return st.black_hole_sums(ad.obs(spark, sf))


@query("semi_black_hole", sql("v_obs v_sums", """
  select stationid as "stationID", dates, precipitation from v_obs where stationid in (select stationid from v_sums where psum <= 0)""",
    "stationID dates", "", "Precipitation"))
def semi_black_hole(spark, sf):
    obs = ad.obs(spark, sf)
    dead = st.black_hole_sums(obs).filter("Precipitation_sum <= 0")
    return obs.join(dead, "stationID", "left_semi").select("stationID", "dates", "Precipitation")


@query("join_station_partition", sql("v_member", """
  select stationid as "stationID", i_step from v_member""", "stationID", "i_step"))
def join_station_partition(spark, sf):
    return st.stations_in_partitions(ad.stations(spark, sf), grid.partition_boxes(ad.topo(spark, sf))).select("stationID", "i_step")


@query("join_window", sql("v_obs", """
  select f.date_fin, count(*) as n, count(distinct o.stationid) as stations, sum(o.precipitation) as precipitation
  from (select distinct dates as date_fin from v_obs) f join v_obs o on o.dates between f.date_fin - 16 and f.date_fin group by f.date_fin""",
    "date_fin", "n stations", "Precipitation"))
def join_window(spark, sf):
    obs = ad.obs(spark, sf)
    wanted = obs.select(F.col("dates").alias("date_fin"))
    return st.window_dates(st.with_last_seen(obs), wanted).groupBy("date_fin").agg(
        n_rows(), F.count_if(st.first_in_window()).alias("stations"), F.sum("Precipitation").alias("Precipitation"))


@query("join_calibration", sql("v_interp v_topo v_calib", """
  select c.date_fin, c.i_step, count(*) as n, min(c.tmin_n) as tmin_n, avg(i.mintemperature) as mintemperature
  from v_interp i join v_topo t on t.cell_id = i.cell_id join v_calib c on c.date_fin = i.dates and c.i_step = t.partition % 29
  group by c.date_fin, c.i_step""", "date_fin", "i_step n", "tmin_n MinTemperature"))
def join_calibration(spark, sf):
    cells = ad.interpolated_cells(spark, sf).select(
        F.col("dates").alias("date_fin"), (F.col("partition") % 29).alias("i_step"), "MinTemperature")
    params = ad.calibrations(spark, sf).select("date_fin", "i_step", "tmin_n")
    return cells.join(params, ["date_fin", "i_step"]).groupBy("date_fin", "i_step").agg(
        n_rows(), F.min("tmin_n").alias("tmin_n"), F.avg("MinTemperature").alias("MinTemperature"))


@query("distinct_partitions", sql("v_topo", "select distinct partition from v_topo", "", "partition"))
def distinct_partitions(spark, sf):
    return ad.topo(spark, sf).select("partition").distinct()


_MEANS = ", ".join(f"avg({c}) as {c}" for c in CELL_NUMS.split())


@query("region_daily_means", sql("v_inside v_interp", f"""
  select i.rid, c.dates, {_MEANS} from v_inside i join v_interp c on c.cell_id = i.cell_id group by i.rid, c.dates""",
    "dates", "rid", CELL_NUMS))
def region_daily_means(spark, sf):
    return rg.region_daily(ad.interpolated(spark, sf), members(spark, sf), ["rid"])


@query("region_daily_means_nan", sql("v_inside v_interp", """
  select i.rid, c.dates, avg(windspeed) as windspeed, avg(case when c.cell_id % 7 <> 0 then pet end) as pet
  from v_inside i join v_interp c on c.cell_id = i.cell_id group by i.rid, c.dates""", "dates", "rid", "WindSpeed PET"))
def region_daily_means_nan(spark, sf):
    holed = ad.interpolated(spark, sf).withColumns({
        "WindSpeed": F.coalesce("WindSpeed", F.lit(float("nan"))),
        "PET": F.when(F.col("cell_id") % 7 != 0, F.col("PET")).otherwise(float("nan"))})
    return rg.region_daily(holed, members(spark, sf), ["rid"], ["WindSpeed", "PET"], skip_nan=True)


@query("admin_rollup", sql("v_inside v_interp v_centres", """
  select l.admin_level, l.region, c.dates, count(*) as n, avg(mintemperature) as mintemperature, avg(precipitation) as precipitation
  from v_inside i join v_centres g on g.rid = i.rid join v_interp c on c.cell_id = i.cell_id
  cross join lateral (values ('municipio', g.rid), ('comarca', g.rid % 10), ('provincia', g.province)) l(admin_level, region)
  group by l.admin_level, l.region, c.dates""", "admin_level dates", "region n", "MinTemperature Precipitation"))
def admin_rollup(spark, sf):
    levels = F.array(*[
        F.struct(F.lit(level).alias("admin_level"), region.cast("bigint").alias("region"))
        for level, region in (("municipio", F.col("rid")), ("comarca", F.col("rid") % 10), ("provincia", F.col("province")))])
    named = ad.regions(spark, sf).select("rid", F.inline(levels))
    return rg.rollup(ad.interpolated(spark, sf), members(spark, sf), named, ["MinTemperature", "Precipitation"])


@query("station_count", sql("v_placed", """
  select dates, i_step, count(distinct stationid) as n_stations from v_placed group by dates, i_step""", "dates", "i_step n_stations"))
def station_count(spark, sf):
    # A station has one row per date, so rows are stations; where it stands is worked out once per station, not per day.
    stations = ad.obs(spark, sf).select("stationID", "x", "y").distinct()
    member = st.stations_in_partitions(stations, grid.partition_boxes(ad.topo(spark, sf))).select("stationID", "i_step")
    return ad.obs(spark, sf).select("stationID", "dates").join(member, "stationID").groupBy("dates", "i_step").agg(F.count(F.lit(1)).alias("n_stations"))


@query("window_station_count", sql("v_obs v_member", """
  select f.date_fin, m.i_step, count(distinct o.stationid) as n_stations
  from (select distinct dates as date_fin from v_obs) f join v_obs o on o.dates between f.date_fin - 16 and f.date_fin
  join v_member m on m.stationid = o.stationid group by f.date_fin, m.i_step""", "date_fin", "i_step n_stations"))
def window_station_count(spark, sf):
    obs = ad.obs(spark, sf)
    wanted = obs.select(F.col("dates").alias("date_fin"))
    return cb.station_counts_in(obs, grid.partition_boxes(ad.topo(spark, sf)), wanted, 17)


@query("cell_count", sql("v_topo", "select partition, count(*) as topo_ncells from v_topo group by partition", "", "partition topo_ncells"))
def cell_count(spark, sf):
    return ad.topo(spark, sf).groupBy("partition").agg(F.count(F.lit(1)).alias("topo_ncells"))


_MAES = [f"{s}_mae" for s in SHORT_NAMES.values()]
_SUMMARY = ", ".join(f"avg({c}) as {c}_mean, median({c}) as {c}_median, min({c}) as {c}_min, max({c}) as {c}_max" for c in _MAES)


@query("calibration_summary", sql("v_calib", f"""
  select i_step, {_SUMMARY}, arg_min(box, date_fin) as topo_bbox from (select *, 'BOX ' || n_stations || ' ' || date_fin as box from v_calib) group by i_step""",
    "topo_bbox", "i_step", " ".join(f"{c}_{k}" for c in _MAES for k in ("mean", "median", "min", "max"))))
def calibration_summary(spark, sf):
    table = ad.calibrations(spark, sf).withColumn(
        "topo_bbox", F.concat(F.lit("BOX "), F.col("n_stations").cast("string"), F.lit(" "), F.col("date_fin").cast("string")))
    return cb.summary(table)


# Leave-one-out predictions of one variable with its standard choice.
_ONE = {"MaxTemperature": (DEFAULTS.smoothing["MaxTemperature"],)}
_PRED = loo_steps(_ONE) | {"v_pred": "select dates, i_step, t_id as stationid, obs, pred from v_loo where pred is not null"}
_CV = """bias, mae, relative_bias, n, case when vo > 1e-9 and vp > 1e-9 then r * r end as r2 from (
  select i_step, avg(pred - obs) as bias, avg(abs(pred - obs)) as mae,
    case when abs(sum(obs)) > 1e-12 * sum(abs(obs)) then sum(pred - obs) / sum(obs) end as relative_bias, count(*) as n,
    corr(pred, obs) as r, var_pop(obs) as vo, var_pop(pred) as vp from v_pred group by i_step)"""


def predictions(spark, sf):
    def write(path):
        tables.materialize(cb.predictions_table(placed_table(spark, sf), ["dates", "i_step"], _ONE), path)

    return spark.read.parquet(stored(spark, sf, "predictions", write)).select("dates", "i_step", "stationID", "obs", "pred").where("pred is not null")


@query("cv_stats", sql("v_placed", f"select i_step, {_CV}", "", "i_step n", "bias mae relative_bias r2", more=_PRED))
def cv_stats(spark, sf):
    return va.cv_stats(predictions(spark, sf), ["i_step"])


# Wide daily statistics per partition, as a cross-validation returns them.
_STATS = """select i_step, dates, avg(pred - obs) as "MaxTemperature_date_bias", avg(abs(pred - obs)) as "MaxTemperature_date_mae",
  count(*) as "MaxTemperature_date_n", min(pred) as "MaxTemperature_date_low", avg(pred) as "Min_date_Temperature_date_bias" from v_pred group by i_step, dates"""
_LAST = "select * from v_stats qualify row_number() over (partition by i_step order by dates desc) = 1"
_LONG = """select i_step, dates, variable_date_stat, value from (select i_step, dates, "MaxTemperature_date_bias", "MaxTemperature_date_mae",
  cast("MaxTemperature_date_n" as double) as "MaxTemperature_date_n", "MaxTemperature_date_low", "Min_date_Temperature_date_bias" from v_last) unpivot include nulls (value for variable_date_stat in
  ("MaxTemperature_date_bias", "MaxTemperature_date_mae", "MaxTemperature_date_n", "MaxTemperature_date_low", "Min_date_Temperature_date_bias"))"""
_SPLIT = """select i_step, dates, value, case when variable_date_stat like 'Min%' then 'Min_date_Temperature' else 'MaxTemperature' end as variable,
  list_last(string_split(variable_date_stat, '_')) as stat from v_long"""
_STEPS = _PRED | {"v_stats": _STATS, "v_last": _LAST, "v_long": _LONG, "v_split": _SPLIT}


def date_stats(spark, sf):
    err = F.col("pred") - F.col("obs")
    return predictions(spark, sf).groupBy("i_step", "dates").agg(
        F.avg(err).alias("MaxTemperature_date_bias"), F.avg(F.abs(err)).alias("MaxTemperature_date_mae"),
        F.count(F.lit(1)).alias("MaxTemperature_date_n"), F.min("pred").alias("MaxTemperature_date_low"),
        F.avg("pred").alias("Min_date_Temperature_date_bias"))


def last_stats(spark, sf):
    return va.last_row(date_stats(spark, sf), ["i_step"])


def long_stats(spark, sf):
    return va.unpivot_stats(last_stats(spark, sf), ["i_step", "dates"])


@query("last_stat_row", sql("v_placed", "select * from v_last", "dates", "i_step MaxTemperature_date_n",
    "MaxTemperature_date_bias MaxTemperature_date_mae MaxTemperature_date_low Min_date_Temperature_date_bias", more=_STEPS))
def last_stat_row(spark, sf):
    return last_stats(spark, sf)


@query("unpivot_stats", sql("v_placed", "select * from v_long", "dates variable_date_stat", "i_step", "value", more=_STEPS))
def unpivot_stats(spark, sf):
    return long_stats(spark, sf)


@query("split_by_regex", sql("v_placed", "select * from v_split", "dates variable stat", "i_step", "value", more=_STEPS))
def split_by_regex(spark, sf):
    return va.split_stats(long_stats(spark, sf))


@query("filter_stats", sql("v_placed", "select * from v_split where stat in ('bias', 'mae', 'relative_bias', 'n')",
    "dates variable stat", "i_step", "value", more=_STEPS))
def filter_stats(spark, sf):
    return va.keep_stats(va.split_stats(long_stats(spark, sf)))


def counted(spark, sf):
    return predictions(spark, sf).groupBy("i_step").agg(F.count_distinct("stationID").alias("n_stations"))


@query("cv_station_count", sql("v_placed", """
  select s.i_step, s.variable, 'n_stations' as stat, c.n as value from (select distinct i_step, variable from v_split) s
  join (select i_step, count(distinct stationid) as n from v_pred group by i_step) c on c.i_step = s.i_step""",
    "variable stat", "i_step", "value", more=_STEPS))
def cv_station_count(spark, sf):
    return va.station_count_rows(va.split_stats(long_stats(spark, sf)), counted(spark, sf), ["i_step"])


@query("union_stats", sql("v_placed", f"""
  select i_step, variable, stat, value from v_split where stat in ('bias', 'mae', 'n')
  union all select i_step, 'MaxTemperature', 'r2', r2 from (select i_step, {_CV})
  union all select s.i_step, s.variable, 'n_stations', c.n from (select distinct i_step, variable from v_split) s
  join (select i_step, count(distinct stationid) as n from v_pred group by i_step) c on c.i_step = s.i_step""",
    "variable stat", "i_step", "value", more=_STEPS))
def union_stats(spark, sf):
    long = va.keep_stats(va.split_stats(long_stats(spark, sf))).select("i_step", "variable", "stat", "value")
    r2 = va.cv_stats(predictions(spark, sf), ["i_step"]).select(
        "i_step", F.lit("MaxTemperature").alias("variable"), F.lit("r2").alias("stat"), F.col("r2").alias("value"))
    counts = va.station_count_rows(long, counted(spark, sf), ["i_step"])
    return long.unionByName(r2).unionByName(counts)


@query("write_cv", sql("v_placed", "select dates, variable, stat, value from v_split", "dates variable stat", "", "value", more=_STEPS))
def write_cv(spark, sf):
    path = folders.new_folder(spark, "cv")
    tables.write_cv(va.split_stats(long_stats(spark, sf)).select("dates", "variable", "stat", "value"), path)
    return spark.read.parquet(path)


_WIDTHS = {"n": 20.0, "alpha": 10.0, "mae": 0.25}
_HIST = " union all ".join(
    f"select '{s}_{k}' as name, floor({s}_{k} / {w}e0) as bin, count(*) as n from v_calib group by 2"
    for s in SHORT_NAMES.values() for k, w in _WIDTHS.items())


@query("histogram_1d", sql("v_calib", "select name, bin, n, n / cast(max(n) over (partition by name) as double) as ncount from v_hist",
    "name", "bin n", "ncount", more={"v_hist": _HIST}))
def histogram_1d(spark, sf):
    return cb.histograms(ad.calibrations(spark, sf), {f"{s}_{k}": w for s in SHORT_NAMES.values() for k, w in _WIDTHS.items()})


_HIST2 = " union all ".join(
    f"select '{s}' as name, floor({s}_n / 20e0) as bx, floor({s}_alpha / 10e0) as by_, year, month, count(*) as n from v_calib group by all"
    for s in SHORT_NAMES.values())


@query("histogram_2d", sql("v_calib", "select * from v_hist", "name", "bx by_ year month n", more={"v_hist": _HIST2}))
def histogram_2d(spark, sf):
    pairs = {s: (f"{s}_n", f"{s}_alpha") for s in SHORT_NAMES.values()}
    return cb.histograms_2d(ad.calibrations(spark, sf), pairs, 20.0, 10.0, ["year", "month"]).withColumnRenamed("by", "by_")


# Points that fall on a partition border are listed under both partitions.
_TWICE = """select x, y, elevation, partition from v_topo union all
  select x, y, elevation, partition + 1 from v_topo where cell_id % 5 = 0"""


def twice(spark, sf):
    topo = ad.topo(spark, sf).select("cell_id", "x", "y", "elevation", "partition")
    again = topo.filter("cell_id % 5 = 0").withColumn("partition", F.col("partition") + 1)
    return topo.unionByName(again).drop("cell_id")


@query("row_count_check", sql("v_topo", """
  select (select count(*) from v_topo) as before, (select count(*) from (select distinct x, y, elevation from v_twice)) as after,
    (select count(distinct partition) from v_topo) as partitions""", "", "before after partitions", more={"v_twice": _TWICE}))
def row_count_check(spark, sf):
    topo = ad.topo(spark, sf)
    after = grid.dedupe_lowest_partition(twice(spark, sf)).agg(F.count(F.lit(1))).scalar()
    return topo.agg(F.count(F.lit(1)).alias("before"), F.count_distinct("partition").alias("partitions")).select(
        "before", after.alias("after"), "partitions")


@query("dedupe_keep_first", sql("v_topo", """
  select x, y, elevation, min(partition) as partition from v_twice group by x, y, elevation""", "", "partition", "x y elevation",
    more={"v_twice": _TWICE}))
def dedupe_keep_first(spark, sf):
    return grid.dedupe_lowest_partition(twice(spark, sf))


@query("distinct_rows", sql("v_calib", "select distinct i_step, n_stations, tmin_n, tmin_alpha from v_calib", "", "i_step n_stations", "tmin_n tmin_alpha"))
def distinct_rows(spark, sf):
    return ad.calibrations(spark, sf).select("i_step", "n_stations", "tmin_n", "tmin_alpha").distinct()


_LONGCAL = " union all ".join(
    f"select i_step, '{v}' as variable, {s}_n as N, {s}_alpha as alpha, count(*) as cnt, sum({s}_mae) as sum_abs from v_calib group by i_step, {s}_n, {s}_alpha"
    for v, s in SHORT_NAMES.items())


@query("argmin_params", sql("v_calib", """
  select i_step, variable, n_ as "N", alpha, mae from (
    select i_step, variable, N as n_, alpha, sum_abs / cnt as mae,
      row_number() over (partition by i_step, variable order by round(sum_abs / cnt, 6), N, alpha) as k
    from (select i_step, variable, "Nx" as N, alpha, cnt, sum_abs from v_longcal)) where k = 1""",
    "variable", "i_step", "N alpha mae", more={"v_longcal": _LONGCAL.replace("_n as N", '_n as "Nx"')}))
def argmin_params(spark, sf):
    rows = F.inline(F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(f"{s}_n").alias("N"), F.col(f"{s}_alpha").alias("alpha"), F.col(f"{s}_mae").alias("mae"))
        for v, s in SHORT_NAMES.items()]))
    errors = ad.calibrations(spark, sf).select("i_step", rows).groupBy("i_step", "variable", "N", "alpha").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("mae").alias("sum_abs"))
    return cb.best_params(errors, ["i_step"], count="n_rows")


@query("order_by_partition", sql("v_topo", """
  select cell_id, partition, row_number() over (order by partition, cell_id) as k from v_topo""", "", "cell_id partition k"))
def order_by_partition(spark, sf):
    # The place in the order, counted from partition sizes: no task sees all rows.
    topo = ad.topo(spark, sf).select("cell_id", "partition")
    return grid.row_numbers(topo, ["partition"], ["cell_id"], "k")


@query("order_calibrations", sql("v_calib", """
  select date_fin, i_step, row_number() over (order by year, month, day, i_step) as k from v_calib""", "date_fin", "i_step k"))
def order_calibrations(spark, sf):
    table = ad.calibrations(spark, sf).select("date_fin", "year", "month", "day", "i_step")
    return grid.row_numbers(table, ["year", "month", "day"], ["i_step"], "k").select("date_fin", "i_step", "k")


@query("chunk_by_rows", sql("v_topo", """
  select cell_id, ceil(row_number() over (order by partition, y, x) / ceil(count(*) over () / 12e0)) as chunk from v_topo""", "", "cell_id chunk"))
def chunk_by_rows(spark, sf):
    topo = ad.topo(spark, sf).select("cell_id", "partition", "y", "x")
    return grid.row_chunks(topo, ["partition", "y"], ["x"], 12).select("cell_id", "chunk")


@query("latest_station_attrs", sql("v_placed", """
  select i_step, stationid as "stationID", count(*) as n, min(last_elevation) as lo, max(last_elevation) as hi from (
    select *, last_value(moved) over (partition by i_step, stationid order by dates rows between unbounded preceding and unbounded following) as last_elevation
    from (select *, elevation + year(dates) % 3 + month(dates) as moved from v_placed)) group by i_step, stationid""",
    "stationID", "i_step n", "lo hi"))
def latest_station_attrs(spark, sf):
    moved = masked(spark, sf).withColumn("elevation", F.col("elevation") + F.year("dates") % 3 + F.month("dates"))
    return st.latest_in_partitions(moved, boxes_table(spark, sf), ["stationID"]).groupBy("i_step", "stationID").agg(
        n_rows(), F.min("elevation").alias("lo"), F.max("elevation").alias("hi"))


@query("build_interpolator", sql("v_masked v_member v_boxes", """
  select w.date_fin, w.i_step, count(*) as n, count(distinct stationid) as n_stations, sum(precipitation) as precipitation,
    count(windspeed) as n_wind, sum(dewtemperature) as dewtemperature from (
    select f.date_fin, m.i_step, o.* from (select distinct date_trunc('month', dates)::date + 15 as date_fin from v_masked) f
    join v_masked o on o.dates between f.date_fin - 16 and f.date_fin join v_member m on m.stationid = o.stationid) w
  group by w.date_fin, w.i_step""", "date_fin", "i_step n n_stations n_wind", "Precipitation DewTemperature"))
def build_interpolator(spark, sf):
    obs = st.normalize(ad.obs(spark, sf))
    frames = st.station_frames(
        obs, st.black_hole_sums(obs), grid.partition_boxes(ad.topo(spark, sf)), cb.month_windows(obs))
    return frames.groupBy("date_fin", "i_step").agg(
        n_rows(), F.count_distinct("stationID").alias("n_stations"), F.sum("Precipitation").alias("Precipitation"),
        F.count("WindSpeed").alias("n_wind"), F.sum("DewTemperature").alias("DewTemperature"))
