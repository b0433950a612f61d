"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygrid.checks.layout import AS_OF, CELL_NUMS, OBS_NUMS, as_of
from skygrid.checks.registry import query, sql
from skygrid.functions import calendar as cal, columns, weather
from skygrid.operators import boxes, grid, rasters, regions as rg, stations as st
from skygrid.params import BITMAP_PALETTE_NAME
from skygrid.sources import adapters as ad, folders, tables

BY_PATTERN = ("MeanTemperature MinTemperature MaxTemperature MeanRelativeHumidity MinRelativeHumidity "
              "MaxRelativeHumidity Precipitation WindSpeed WindDirection Radiation")


@query("select_by_pattern", sql(
    "v_norm", "select stationid as \"stationID\", * exclude (stationid) from v_norm", "dates stationID", "",
    "elevation slope aspect x y DewTemperature " + BY_PATTERN))
def select_by_pattern(spark, sf):
    return st.select_variables(st.normalize(ad.obs(spark, sf)))


@query("sql_columns_pattern", sql("v_interp", "select dates, " + ", ".join(
    f"avg({c}) as {c}" for c in CELL_NUMS.split()) + " from v_interp group by dates", "dates", "", CELL_NUMS))
def sql_columns_pattern(spark, sf):
    days = ad.interpolated(spark, sf)
    names = columns.matching(days, "Temperature|Prec|Humidity|Radiation|Wind|PET|Thermal")
    return days.groupBy("dates").agg(*columns.means(names))


@query("project_out", sql("v_icells", "select * from v_icells", "", "cell_id", CELL_NUMS.replace("WindDirection ", "")))
def project_out(spark, sf):
    cells = ad.interpolated_cells(spark, sf)
    return cells.select(*[c for c in rasters.layers_of(cells) if c not in ("x", "y", "r", "c")])


@query("rename_columns", sql(
    "v_topo", "select elevation, aspect, slope, tpi as \"TPI\", cell_id as cell from v_topo", "", "cell", "elevation aspect slope TPI"))
def rename_columns(spark, sf):
    return ad.topo(spark, sf).select("elevation", "aspect", "slope", "TPI", "cell_id").toDF(
        "elevation", "aspect", "slope", "TPI", "cell")


@query("mask_dead_sensors", sql(
    "v_masked", "select * exclude (stationid), stationid as \"stationID\" from v_masked", "dates stationID", "",
    "Precipitation WindSpeed WindDirection"))
def mask_dead_sensors(spark, sf):
    obs = ad.obs(spark, sf)
    return st.mask_dead_sensors(obs, st.black_hole_sums(obs)).select(
        "dates", "stationID", "Precipitation", "WindSpeed", "WindDirection")


@query("calendar_parts", sql("", """
  select l_orderkey, l_linenumber, day(l_shipdate) as day, month(l_shipdate) as month, year(l_shipdate) as year,
    dayofyear(l_shipdate) as doy from lineitem""", "", "l_orderkey l_linenumber day month year doy"))
def calendar_parts(spark, sf):
    d = F.to_date("l_shipdate")
    return ad.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *cal.date_parts(d), F.dayofyear(d).alias("doy"))


@query("date_cast", sql("", """
  select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as dates, cast(strftime(o_orderdate, '%Y-%m-%d') as date) as back from orders""",
    "dates back", "o_orderkey"))
def date_cast(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return ad.table(spark, sf, "orders").select("o_orderkey", text.alias("dates"), F.to_date(text, "yyyy-MM-dd").alias("back"))


@query("compact_date", sql("", "select o_orderkey, strftime(o_orderdate, '%Y%m%d') as compact from orders", "compact", "o_orderkey"))
def compact_date(spark, sf):
    return ad.table(spark, sf, "orders").select("o_orderkey", cal.compact(F.col("o_orderdate")).alias("compact"))


@query("thermal_amplitude", sql(
    "v_interp", "select cell_id, dates, maxtemperature - mintemperature as thermalamplitude from v_interp",
    "dates", "cell_id", "ThermalAmplitude"))
def thermal_amplitude(spark, sf):
    return ad.interpolated(spark, sf).select("cell_id", "dates", weather.thermal_amplitude(
        F.col("MinTemperature"), F.col("MaxTemperature")).alias("ThermalAmplitude"))


@query("partition_path", sql("", """
  select o_orderkey, 'daily_raw/year=' || year(o_orderdate) || '/month=' || month(o_orderdate) || '/day=' || day(o_orderdate) as path,
    'daily_raw' as root, 'month=' || month(o_orderdate) as third from orders""", "path root third", "o_orderkey"))
def partition_path(spark, sf):
    paths = ad.table(spark, sf, "orders").select("o_orderkey", cal.partition_path("daily_raw", F.col("o_orderdate")).alias("path"))
    return paths.select("*", cal.path_part(F.col("path"), 1).alias("root"), cal.path_part(F.col("path"), 3).alias("third"))


NAME_SQL = ("'interpolators/interpolator_' || year(date_fin) || '_' || month(date_fin) || '_' || day(date_fin) "
            "|| '_' || i_step || '.nc'")


@query("interpolator_name", sql("v_calib", f"select {NAME_SQL} as path from v_calib", "path"))
def interpolator_name(spark, sf):
    return ad.calibrations(spark, sf).select(cal.interpolator_name(F.col("date_fin"), F.col("i_step")).alias("path"))


@query("interpolator_id", sql("v_calib", f"""
  select path, split_part(split_part(path, '_', 5), '.', 1) as id from (select {NAME_SQL} as path from v_calib)""", "path id"))
def interpolator_id(spark, sf):
    paths = ad.calibrations(spark, sf).select(cal.interpolator_name(F.col("date_fin"), F.col("i_step")).alias("path"))
    return paths.select("path", cal.interpolator_id(F.col("path")).alias("id"))


@query("in_list_filter", sql("", """
  select c_custkey, name, cpro from (
    select c_custkey, case when c_custkey % 7 <> 0 then n_name end as province_name,
      case when c_custkey % 11 <> 0 then c_mktsegment end as cpro, case when c_custkey % 13 <> 0 then c_name end as name
    from customer join nation on c_nationkey = n_nationkey)
  where coalesce(province_name not in ('FRANCE', 'CHINA', 'NATION_1', 'NATION_3'), true) and cpro is not null and name is not null""",
    "name cpro", "c_custkey"))
def in_list_filter(spark, sf):
    k = F.col("c_custkey")
    customers = ad.table(spark, sf, "customer").join(
        ad.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        k, F.when(k % 7 != 0, F.col("n_name")).alias("province_name"),
        F.when(k % 11 != 0, F.col("c_mktsegment")).alias("cpro"), F.when(k % 13 != 0, F.col("c_name")).alias("name"))
    return rg.keep_regions(customers, ("FRANCE", "CHINA", "NATION_1", "NATION_3")).select("c_custkey", "name", "cpro")


@query("in_partition_list", sql(
    "v_calib", "select date_fin, i_step, tmin_n from v_calib where i_step in (15, 17)", "date_fin", "i_step", "tmin_n"))
def in_partition_list(spark, sf):
    return ad.calibrations(spark, sf).filter(F.col("i_step").isin(15, 17)).select("date_fin", "i_step", "tmin_n")


@query("merge_small_partitions", sql(
    "v_topo", "select t.cell_id, r.raw_partition, t.partition from v_topo t join v_topo0 r on r.cell_id = t.cell_id",
    "", "cell_id raw_partition partition"))
def merge_small_partitions(spark, sf):
    extent = (ad.CELL_XMIN, ad.CELL_XMAX, ad.CELL_YMIN, ad.CELL_YMAX)
    raw = grid.partition_id(F.col("x"), F.col("y"), extent)
    cells = ad.cells(spark, sf).select("cell_id", raw.alias("raw_partition"), raw.alias("partition"))
    return grid.merge_partitions(cells)


@query("scale_round", sql("v_interp", """
  select cell_id, dates, round(meantemperature * 1000e0, 0) as scaled from v_interp""", "dates", "cell_id", "scaled"))
def scale_round(spark, sf):
    return ad.interpolated(spark, sf).select("cell_id", "dates", rasters.scale_round(F.col("MeanTemperature")).alias("scaled"))


@query("constants", sql("", """
  select n_nationkey, 'ag_GrnYl' as palette_selected, 'provincia' as admin_level, 'r2' as stat from nation""",
    "palette_selected admin_level stat", "n_nationkey"))
def constants(spark, sf):
    return ad.table(spark, sf, "nation").select(
        "n_nationkey", F.lit(BITMAP_PALETTE_NAME).alias("palette_selected"), F.lit("provincia").alias("admin_level"),
        F.lit("r2").alias("stat"))


@query("union_sources", sql("v_obs", """
  select stationid as "stationID", service, dates, mintemperature, case when service <> 'ria' then radiation end as radiation,
    case when service <> 'meteocat' then windspeed end as windspeed from v_obs""",
    "stationID service dates", "", "MinTemperature Radiation WindSpeed"))
def union_sources(spark, sf):
    obs = ad.obs(spark, sf).select("stationID", "service", "dates", "MinTemperature", "Radiation", "WindSpeed")
    lacking = {"ria": ["Radiation"], "meteocat": ["WindSpeed"]}
    return st.union_sources([
        obs.filter(F.col("service") == s).drop(*lacking.get(s, [])) for s in ("aemet", "meteocat", "meteogalicia", "ria")])


@query("concat_days", sql("v_interp", """
  select month(dates) as month, count(*) as n, max(precipitation) as precipitation from v_interp group by month(dates)""",
    "", "month n", "Precipitation"))
def concat_days(spark, sf):
    # A folder per day, written and read back as one frame from the list of folders.
    path = folders.new_folder(spark, "days")
    tables.write_days(ad.interpolated(spark, sf).select("dates", "Precipitation"), path, "dates")
    return spark.read.parquet(path).groupBy(F.month("dates").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.max("Precipitation").alias("Precipitation"))


@query("normalize_obs", sql(
    "v_norm", "select * exclude (stationid), stationid as \"stationID\" from v_norm", "dates stationID service", "",
    "DewTemperature " + BY_PATTERN))
def normalize_obs(spark, sf):
    feed = ad.obs(spark, sf).withColumnsRenamed({"MinTemperature": "temperature_min", "MaxTemperature": "temperature_max"})
    return st.normalize(feed, {"temperature_min": "MinTemperature", "temperature_max": "MaxTemperature"}).select(
        "dates", "stationID", "service", "DewTemperature", *BY_PATTERN.split())


@query("unnest_cells", sql("v_interp", "select cell_id, dates, mintemperature, pet from v_interp", "dates", "cell_id", "MinTemperature PET"))
def unnest_cells(spark, sf):
    days = ad.interpolated(spark, sf)
    # A nested table per cell-day, as a list of structs, and back to rows.
    nested = days.select("cell_id", F.array(F.struct("dates", "MinTemperature", "PET")).alias("interpolated_data"))
    return nested.select("cell_id", F.inline("interpolated_data"))


@query("sample_rows", sql("v_topo", "select cell_id, x, y from v_topo order by md5(cast(cell_id as varchar)) limit 100", "", "cell_id", "x y"))
def sample_rows(spark, sf):
    # A fixed number of rows in hashed order: the same rows on every run. Sampling is the feature here.
    return ad.topo(spark, sf).orderBy(F.md5(F.col("cell_id").cast("string"))).limit(100).select("cell_id", "x", "y")


@query("sample_fraction", sql("v_topo", """
  select cell_id, x, y from v_topo where cast('0x' || substr(md5(cast(cell_id as varchar)), 1, 8) as bigint) % 10 = 0""", "", "cell_id", "x y"))
def sample_fraction(spark, sf):
    # A tenth of the rows by a hash of the key: the same ones however the rows are dealt.
    place = F.conv(F.substring(F.md5(F.col("cell_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return ad.topo(spark, sf).filter(place % 10 == 0).select("cell_id", "x", "y")
