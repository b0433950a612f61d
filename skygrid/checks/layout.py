"""Sources, sinks, date rules and incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygrid.checks.registry import query, sql
from skygrid.functions import calendar as cal, columns, geo
from skygrid.operators import grid, interpolate as ip, runs, stations as st
from skygrid.params import EXCLUDED_PROVINCES
from skygrid.schema import CELL_VARIABLES
from skygrid.sources import adapters as ad, feeds, folders, tables

OBS_NUMS = ("MinTemperature MaxTemperature MinRelativeHumidity MaxRelativeHumidity Precipitation WindSpeed "
            "WindDirection Radiation")
CELL_NUMS = " ".join(CELL_VARIABLES)
AS_OF = "(select max(dates) + 5 as as_of from v_raw_obs)"


def as_of(spark, sf):
    """The day the run is for: five days after the last order line, as a one-row frame."""
    return ad.table(spark, sf, "lineitem").agg(F.date_add(F.max(F.to_date("l_shipdate")), 5).alias("as_of"))


def spine(spark, sf):
    return runs.date_spine(as_of(spark, sf))


_WRITTEN: dict[tuple, str] = {}


def stored(spark, sf, name, write):
    """A dataset written once per session and folder; several queries read it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN:
        path = folders.new_folder(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def _land(obs, path, fmt):
    writer = obs.write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


@query("read_feeds", sql(
    "v_obs", "select stationid as \"stationID\", service, dates, x, y, elevation, * exclude (stationid, service, dates, x, y, elevation) from v_obs",
    "stationID service dates", "", "x y elevation " + OBS_NUMS))
def read_feeds(spark, sf):
    lon, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    obs = ad.obs(spark, sf).withColumns({"timestamp": F.col("dates").cast("timestamp_ntz"), "lon": lon, "lat": lat})
    formats = {"aemet": "json", "meteocat": "csv", "meteogalicia": "parquet", "ria": "json"}
    landed = {}
    for service, fmt in formats.items():
        path = folders.new_folder(spark, f"feed-{service}")
        feed = obs.filter(F.col("service") == service).drop("service", "sid", "dates")
        if fmt == "csv":
            # CSV columns are read by position, so they are written in schema order.
            from skygrid.schema import FEED
            feed = st.normalize(feed).select(*FEED.names)
        _land(feed, path, fmt)
        landed[service] = (path, fmt)
    back = feeds.read_feeds(spark, landed).withColumn("dates", F.to_date("timestamp"))
    return back.select("stationID", "service", "dates", "x", "y", "elevation", *OBS_NUMS.split())


@query("half_month_window", sql("", """
  select d as dates, case when day(d) <= 15 then date_trunc('month', d)::date else date_trunc('month', d)::date + 15 end as first,
    case when day(d) <= 15 then date_trunc('month', d)::date + 14 else last_day(d) end as last, count(*) as n
  from (select cast(l_shipdate as date) as d from lineitem) group by d""", "dates first last", "n"))
def half_month_window(spark, sf):
    d = F.col("dates")
    days = ad.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("dates")).agg(F.count(F.lit(1)).alias("n"))
    return days.select("dates", cal.half_month_start(d).alias("first"), cal.half_month_end(d).alias("last"), "n")


@query("target_day_filter", sql(
    "v_raw_obs", f"""select l_orderkey, l_linenumber, cast(l_shipdate as date) as dates from lineitem
    where cast(l_shipdate as date) between (select as_of - 385 from {AS_OF}) and (select as_of - 5 from {AS_OF})""",
    "dates", "l_orderkey l_linenumber"))
def target_day_filter(spark, sf):
    items = ad.table(spark, sf, "lineitem").withColumnRenamed("l_shipdate", "timestamp")
    return feeds.target_days(items, spine(spark, sf)).select("dates", "l_orderkey", "l_linenumber")


@query("availability_guard", sql("v_obs", """
  select service, dates, count(*) as n from v_obs cross join (select max(dates) + 2 as as_of from v_obs)
  where case service when 'aemet' then dates < as_of - 4 when 'meteocat' then dates < as_of else true end
  group by service, dates""", "service dates", "n"))
def availability_guard(spark, sf):
    obs = ad.obs(spark, sf)
    today = obs.agg(F.date_add(F.max("dates"), 2)).scalar()
    return obs.filter(feeds.is_available(F.col("service"), F.col("dates"), today)).groupBy("service", "dates").agg(
        F.count(F.lit(1)).alias("n"))


@query("date_spine", sql("v_raw_obs", f"""
  select s.dates, count(o.sid) as n_stations
  from (select cast(unnest(generate_series(as_of - 385, as_of - 5, interval 1 day)) as date) as dates from {AS_OF}) s
  left join v_raw_obs o on o.dates = s.dates group by s.dates""", "dates", "n_stations"))
def date_spine(spark, sf):
    counts = ad.raw_obs(spark, sf).groupBy("dates").agg(F.count("sid").alias("n_stations"))
    return spine(spark, sf).join(counts, "dates", "left").select("dates", F.coalesce("n_stations", F.lit(0)).alias("n_stations"))


@query("month_spine", sql("v_raw_obs", f"""
  select m.dates, count(o.sid) as n_obs
  from (select cast(date_trunc('month', unnest(generate_series(as_of - 364, as_of - 5, interval 1 month))) as date) as dates from {AS_OF}) m
  left join v_raw_obs o on date_trunc('month', o.dates)::date = m.dates group by m.dates""", "dates", "n_obs"))
def month_spine(spark, sf):
    counts = ad.raw_obs(spark, sf).groupBy(F.trunc("dates", "MM").cast("date").alias("dates")).agg(F.count("sid").alias("n_obs"))
    return runs.month_spine(as_of(spark, sf)).join(counts, "dates", "left").select(
        "dates", F.coalesce("n_obs", F.lit(0)).alias("n_obs"))


def _stored_raw(spark, sf):
    return stored(spark, sf, "raw", lambda path: tables.write_raw(
        st.normalize(ad.obs(spark, sf)).drop("sid", "DewTemperature"), path))


@query("write_raw", sql("v_norm", "select *, stationid as \"stationID\", year(dates) as year, month(dates) as month, day(dates) as day from v_norm".replace("select *,", "select * exclude (stationid),"),
    "dates stationID service", "year month day", "x y elevation slope aspect MeanTemperature MeanRelativeHumidity " + OBS_NUMS))
def write_raw(spark, sf):
    return spark.read.parquet(_stored_raw(spark, sf))


@query("scan_raw", sql("v_norm", """
  select stationid as "stationID", count(*) as n, avg(mintemperature) as mintemperature, min(dates) as first from v_norm group by stationid""",
    "stationID first", "n", "MinTemperature"))
def scan_raw(spark, sf):
    raw = tables.scan_raw(spark, _stored_raw(spark, sf))
    return raw.groupBy("stationID").agg(
        F.count(F.lit(1)).alias("n"), F.avg("MinTemperature").alias("MinTemperature"), F.min("dates").alias("first"))


@query("scan_topo_partition", sql(
    "v_topo", "select * from v_topo where partition in (94, 101, 138, 163)", "", "cell_id partition", "x y elevation slope aspect TPI"))
def scan_topo_partition(spark, sf):
    path = stored(spark, sf, "topo", lambda path: tables.write_topo(ad.topo(spark, sf), path))
    return tables.scan_topo(spark, path, [94, 101, 138, 163]).select(
        "cell_id", "partition", "x", "y", "elevation", "slope", "aspect", "TPI")


def _stored_interpolator(spark, sf):
    boxes = boxes_table(spark, sf)
    return stored(spark, sf, "interpolator", lambda path: tables.store_interpolator(
        masked(spark, sf).withColumnRenamed("dates", "date_fin"), ad.calibrations(spark, sf), path,
        place=lambda days: st.stations_in_partitions(days, boxes)))


@query("store_interpolator", sql("v_placed", """
  select dates as date_fin, i_step, stationid as "stationID", x, y, elevation, mintemperature, precipitation, windspeed from v_placed""",
    "date_fin stationID", "i_step", "x y elevation MinTemperature Precipitation WindSpeed"))
def store_interpolator(spark, sf):
    obs, _ = tables.load_interpolator(spark, _stored_interpolator(spark, sf))
    return obs.select("date_fin", "i_step", "stationID", "x", "y", "elevation", "MinTemperature", "Precipitation", "WindSpeed")


@query("load_interpolator", sql(
    "v_calib", "select * from v_calib", "date_fin", "i_step n_stations", "tmin_n tmin_alpha tmin_mae prec_amount_n prec_amount_mae"))
def load_interpolator(spark, sf):
    _, params = tables.load_interpolator(spark, _stored_interpolator(spark, sf))
    return params.select(
        "date_fin", "i_step", "n_stations", "tmin_n", "tmin_alpha", "tmin_mae", "prec_amount_n", "prec_amount_mae")


def placed_table(spark, sf):
    """The same as a written table, as the pipeline stores it, for steps that read it many times."""
    return spark.read.parquet(stored(spark, sf, "placed", lambda path: tables.materialize(placed(spark, sf), path)))


def topo_table(spark, sf):
    return spark.read.parquet(stored(spark, sf, "topo_plain", lambda path: tables.materialize(ad.topo(spark, sf), path)))


def boxes_table(spark, sf):
    """Boxes of the partitions as a table whose size Spark knows, so that station-days are not shuffled to meet them."""
    return spark.read.parquet(stored(spark, sf, "boxes", lambda path: tables.materialize(grid.partition_boxes(ad.topo(spark, sf)), path)))


def masked(spark, sf):
    obs = st.normalize(ad.obs(spark, sf))
    return st.mask_dead_sensors(obs, st.black_hole_sums(obs))


def placed(spark, sf):
    """Masked station-days under every partition whose buffered box holds the station."""
    return st.stations_in_partitions(masked(spark, sf), boxes_table(spark, sf))


def _stored_cells(spark, sf):
    return stored(spark, sf, "interpolated", lambda path: tables.write_interpolated(ad.interpolated_cells(spark, sf), path))


@query("write_interpolated", sql(
    "v_icells", "select *, year(dates) as year, month(dates) as month, day(dates) as day from v_icells",
    "dates", "cell_id partition year month day", "x y " + CELL_NUMS))
def write_interpolated(spark, sf):
    return spark.read.parquet(_stored_cells(spark, sf)).select(
        "dates", "cell_id", "partition", "year", "month", "day", "x", "y", *CELL_VARIABLES)


@query("scan_interpolated", sql("v_icells", """
  select dates, count(*) as n, avg(mintemperature) as mintemperature from v_icells
  where dates >= date '2000-01-01' group by dates""", "dates", "n", "MinTemperature"))
def scan_interpolated(spark, sf):
    cells = spark.read.parquet(_stored_cells(spark, sf))
    return cells.filter(tables.day_range("2000-01-01", "9999-12-31")).groupBy("dates").agg(
        F.count(F.lit(1)).alias("n"), F.avg("MinTemperature").alias("MinTemperature"))


@query("write_region_series", sql("v_icells v_regions v_inside", f"""
  select 'provincia' as admin_level, i.rid, c.dates, count(*) as n, avg(mintemperature) as mintemperature
  from v_inside i join v_interp c on c.cell_id = i.cell_id group by i.rid, c.dates""",
    "admin_level dates", "rid n", "MinTemperature"))
def write_region_series(spark, sf):
    from skygrid.checks.geometry import members
    path = folders.new_folder(spark, "series")
    series = ad.interpolated(spark, sf).join(members(spark, sf), "cell_id").groupBy("rid", "dates").agg(
        F.count(F.lit(1)).alias("n"), F.avg("MinTemperature").alias("MinTemperature"))
    tables.write_region_series(series.withColumn("admin_level", F.lit("provincia")), path, 25)
    return spark.read.parquet(path)


@query("file_bbox_stats", sql("v_topo", """
  select partition, min(x) as xmin, max(x) as xmax, min(y) as ymin, max(y) as ymax from v_topo group by partition""",
    "", "partition", "xmin xmax ymin ymax"))
def file_bbox_stats(spark, sf):
    return tables.file_boxes(ad.topo(spark, sf), "partition")


@query("file_bbox_stats_files")
def file_bbox_stats_files(spark, sf):
    path = stored(spark, sf, "topo", lambda path: tables.write_topo(ad.topo(spark, sf), path))
    files = spark.read.parquet(path).withColumn("file", F.element_at(F.split("_metadata.file_path", "/"), -2))
    return tables.file_boxes(files, "file")


@query("scan_date_list", sql("v_icells", """
  select c.dates, count(*) as n, sum(precipitation) as precipitation from v_icells c
  where c.dates in (select cast(o_orderdate as date) from orders where o_orderpriority = '1-URGENT') group by c.dates""",
    "dates", "n", "Precipitation"))
def scan_date_list(spark, sf):
    wanted = ad.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("dates"))
    return tables.date_list(spark, _stored_cells(spark, sf), wanted).groupBy("dates").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Precipitation").alias("Precipitation"))


@query("relayout", sql("v_icells", "select dates, count(*) as n, avg(pet) as pet from v_icells group by dates", "dates", "n", "PET"))
def relayout(spark, sf):
    source = _stored_cells(spark, sf)
    target = folders.new_folder(spark, "relaid")
    tables.relayout(spark, source, target, 50000)
    return spark.read.parquet(target).groupBy("dates").agg(F.count(F.lit(1)).alias("n"), F.avg("PET").alias("PET"))


@query("pending_dates", sql("v_raw_obs v_interp", f"""
  select s.dates from (select cast(unnest(generate_series(as_of - 385, as_of - 5, interval 1 day)) as date) as dates from {AS_OF}) s
  where s.dates not in (select dates from v_interp where precipitation > 9e0)""", "dates"))
def pending_dates(spark, sf):
    return runs.pending(spine(spark, sf), ad.interpolated(spark, sf).filter("Precipitation > 9"))


@query("retention_filter", sql("v_raw_obs v_interp", f"""
  select cell_id, dates, mintemperature from v_interp
  where dates between (select as_of - 385 from {AS_OF}) and (select as_of - 5 from {AS_OF})""", "dates", "cell_id", "MinTemperature"))
def retention_filter(spark, sf):
    return runs.retained(ad.interpolated(spark, sf), spine(spark, sf)).select("cell_id", "dates", "MinTemperature")


@query("run_summary", sql("", """
  select o_custkey % 50 as run_id, count(*) filter (o_orderstatus = 'F') as skipped,
    count(*) filter (o_orderstatus = 'O') as completed, count(*) filter (o_orderstatus = 'P') as errored
  from orders group by o_custkey % 50""", "", "run_id skipped completed errored"))
def run_summary(spark, sf):
    o = F.col("o_orderstatus")
    status = F.when(o == "F", "skipped").when(o == "O", "completed").otherwise("errored")
    return runs.summary(ad.table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("run_id"), status.alias("status")))


@query("recency_filter", sql("v_raw_obs", f"""
  select dates, count(*) as n from v_raw_obs where dates >= (select as_of - 370 from {AS_OF}) group by dates""", "dates", "n"))
def recency_filter(spark, sf):
    today = as_of(spark, sf).scalar()
    return ad.raw_obs(spark, sf).filter(runs.is_recent(F.col("dates"), today)).groupBy("dates").agg(F.count(F.lit(1)).alias("n"))


@query("date_series_filter", sql("v_raw_obs", """
  select dates, count(*) as n, sum(precipitation) as precipitation from v_raw_obs
  where dates between date '1998-03-01' and date '1999-02-27' group by dates""", "dates", "n", "Precipitation"))
def date_series_filter(spark, sf):
    obs = tables.with_day_keys(ad.raw_obs(spark, sf))
    first, last = "1998-03-01", "1999-02-27"
    return obs.filter(F.col("dates").between(first, last) & tables.day_range(first, last)).groupBy("dates").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Precipitation").alias("Precipitation"))


@query("required_source_gate", sql("v_obs", """
  select service, dates, count(*) as n from v_obs
  where dates in (select dates from v_obs where service = 'aemet') group by service, dates""", "service dates", "n"))
def required_source_gate(spark, sf):
    return st.require_source(ad.obs(spark, sf)).groupBy("service", "dates").agg(F.count(F.lit(1)).alias("n"))


@query("zip_by_date", sql("v_raw_obs v_interp", """
  select a.dates, a.n_stations, b.n_cells from (select dates, count(*) as n_stations from v_raw_obs group by dates) a
  join (select dates, count(*) as n_cells from v_interp group by dates) b on a.dates = b.dates""", "dates", "n_stations n_cells"))
def zip_by_date(spark, sf):
    a = ad.raw_obs(spark, sf).groupBy("dates").agg(F.count(F.lit(1)).alias("n_stations"))
    b = ad.interpolated(spark, sf).groupBy("dates").agg(F.count(F.lit(1)).alias("n_cells"))
    return a.join(b, "dates")


@query("cross_dates_topo", sql("v_raw_obs v_topo", f"""
  select s.dates, p.partition, p.n from (select cast(unnest(generate_series(as_of - 385, as_of - 5, interval 1 day)) as date) as dates from {AS_OF}) s
  cross join (select partition, count(*) as n from v_topo group by partition) p""", "dates", "partition n"))
def cross_dates_topo(spark, sf):
    today = as_of(spark, sf).scalar()
    partitions = ad.topo(spark, sf).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    # Every date under every partition is a sequence on the partition row; nothing is joined.
    return partitions.select(F.explode(F.sequence(F.date_sub(today, 385), F.date_sub(today, 5))).alias("dates"), "partition", "n")


@query("full_join_stats", sql("v_interp", """
  select coalesce(a.cell_id, b.cell_id) as cell_id, a.rain_days, b.wind_days
  from (select cell_id, count(*) as rain_days from v_interp where precipitation > 5e0 group by cell_id) a
  full join (select cell_id, count(*) as wind_days from v_interp where windspeed > 5e0 group by cell_id) b on a.cell_id = b.cell_id""",
    "", "cell_id rain_days wind_days"))
def full_join_stats(spark, sf):
    days = ad.interpolated(spark, sf)
    a = days.filter("Precipitation > 5").groupBy("cell_id").agg(F.count(F.lit(1)).alias("rain_days"))
    b = days.filter("WindSpeed > 5").groupBy("cell_id").agg(F.count(F.lit(1)).alias("wind_days"))
    return a.join(b, "cell_id", "full_outer")
