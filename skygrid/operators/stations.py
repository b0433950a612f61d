"""Cleaning of station observations and selection of stations per partition and window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrid.functions import columns, geo, weather
from skygrid.params import MANDATORY_SERVICE, PENINSULA_BOX, STATION_BUFFER_M, WINDOW_DAYS
from skygrid.schema import OBS_VARIABLES

STATION_ATTRS = ("elevation", "slope", "aspect", "x", "y")


def union_sources(feeds: list[DataFrame]) -> DataFrame:
    """Feeds by column name; a column a feed lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def normalize(obs: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Shared vocabulary, NaN scrubbed, and means and dew point filled from what was observed."""
    for old, new in (renames or {}).items():
        obs = obs.withColumnRenamed(old, new)
    present = [v for v in OBS_VARIABLES if v in obs.columns]
    obs = obs.withColumns({
        v: F.when(~F.isnan(v), F.col(v).cast("double")) if v in present else F.lit(None).cast("double")
        for v in OBS_VARIABLES
    })
    lo, hi = F.col("MinTemperature"), F.col("MaxTemperature")
    obs = obs.withColumns({
        "MeanTemperature": F.coalesce("MeanTemperature", weather.mean_temperature(lo, hi)),
        "MeanRelativeHumidity": F.coalesce(
            "MeanRelativeHumidity", (F.col("MinRelativeHumidity") + F.col("MaxRelativeHumidity")) / 2.0),
    })
    return obs.withColumn(
        "DewTemperature", weather.dew_point(F.col("MeanTemperature"), F.col("MeanRelativeHumidity")))


def keep_peninsula(obs: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    return obs.filter(geo.in_box(F.col(lon), F.col(lat), PENINSULA_BOX))


def require_source(obs: DataFrame, service: str = MANDATORY_SERVICE) -> DataFrame:
    """Only dates on which the mandatory service reported."""
    days = obs.filter(F.col("service") == service).select("dates").distinct()
    return obs.join(days, "dates", "left_semi")


def black_hole_sums(obs: DataFrame) -> DataFrame:
    """Rain and wind totals per station over the whole dataset; all missing counts as zero."""
    return obs.groupBy("stationID").agg(
        F.coalesce(F.sum("Precipitation"), F.lit(0.0)).alias("Precipitation_sum"),
        F.coalesce(F.sum("WindSpeed"), F.lit(0.0)).alias("WindSpeed_sum"),
    )


def mask_dead_sensors(obs: DataFrame, sums: DataFrame) -> DataFrame:
    """Rain of stations that never saw rain becomes NULL; wind and direction likewise."""
    flags = sums.select(
        "stationID", (F.col("Precipitation_sum") <= 0).alias("dead_rain"), (F.col("WindSpeed_sum") <= 0).alias("dead_wind"))

    def unless(flag, c):
        return F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col(c).cast("double"))

    return obs.join(flags, "stationID", "left").withColumns({
        "Precipitation": unless("dead_rain", "Precipitation"),
        "WindSpeed": unless("dead_wind", "WindSpeed"),
        "WindDirection": unless("dead_wind", "WindDirection"),
    }).drop("dead_rain", "dead_wind")


def select_variables(obs: DataFrame) -> DataFrame:
    """Identity, terrain, position and every weather column, picked by name pattern."""
    fixed = ["dates", "stationID", "elevation", "slope", "aspect", "x", "y"]
    return obs.select(*fixed, *columns.matching(obs, *columns.OBS_PATTERNS))


def stations_in_partitions(stations: DataFrame, boxes: DataFrame, distance: float = STATION_BUFFER_M) -> DataFrame:
    """Pairs of station and partition where the station is within the buffered box.

    Both sides are cut into square tiles as wide as the buffer, so that this is an equi-join on the
    tile whatever the number of partitions and stations: a box is listed under every tile its buffer
    touches, a station under its own.
    """
    def tile(c):
        return F.floor(c / distance).cast("bigint")

    spread = boxes.withColumn(
        "tx", F.explode(F.sequence(tile(F.col("xmin") - distance), tile(F.col("xmax") + distance)))
    ).withColumn(
        "ty", F.explode(F.sequence(tile(F.col("ymin") - distance), tile(F.col("ymax") + distance)))
    )
    placed = stations.withColumns({"tx": tile(F.col("x")), "ty": tile(F.col("y"))})
    near = geo.within_buffered_box(*[F.col(c) for c in ("x", "y", "xmin", "xmax", "ymin", "ymax")], distance)
    return placed.join(spread, ["tx", "ty"]).filter(near).drop("tx", "ty", "xmin", "xmax", "ymin", "ymax", "topo_ncells")


def window_dates(obs: DataFrame, wanted: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Each observation under every wanted ``date_fin`` whose window of ``days`` days holds it.

    The wanted dates are listed under each day of their windows, ``days`` rows a date, and meet the observations by an equi-join on
    the day: an observation becomes as many rows as wanted windows hold it, and none when none does.
    """
    window = F.explode(F.sequence(F.date_sub("date_fin", days - 1), "date_fin")).alias("dates")
    spread = wanted.select("date_fin").distinct().select("date_fin", window)
    return obs.join(spread, "dates").select(*obs.columns, "date_fin")


def latest_attributes(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Terrain and position of the most recent day written on all rows of the station."""
    latest = F.max_by(F.struct(*STATION_ATTRS), "dates").over(Window.partitionBy(*keys))
    return obs.withColumn("_last", latest).withColumns({c: F.col(f"_last.{c}") for c in STATION_ATTRS}).drop("_last")


def with_last_seen(obs: DataFrame) -> DataFrame:
    """Each observation with ``seen``, the day of the one before it of its station; of several on one day, the others have that day."""
    return obs.withColumn("seen", F.lag("dates").over(Window.partitionBy("stationID").orderBy("dates")))


def first_in_window(days: int = WINDOW_DAYS) -> Column:
    """Whether an observation under a ``date_fin`` is its station's first in that window; counted, it gives the distinct stations."""
    return F.col("stationID").isNotNull() & (F.col("seen").isNull() | (F.datediff("date_fin", "seen") >= days))


def latest_in_partitions(obs: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Station-days under their partitions with ``latest_attributes`` of ``i_step`` and ``keys``.

    Stations that keep their place among rows of equal ``keys`` are in the same partitions on all of them: their latest attributes are found
    before the rows are listed under partitions, so that what moves is a row per station-day. The others are listed first.
    """
    rows = Window.partitionBy(*keys)
    stays = (F.min("x").over(rows) == F.max("x").over(rows)) & (F.min("y").over(rows) == F.max("y").over(rows))
    # Rows without a place are in no partition.
    known = obs.where("x is not null and y is not null").withColumns({
        "_stays": stays, "_last": F.max_by(F.struct(*STATION_ATTRS), "dates").over(rows)})
    fixed = stations_in_partitions(known.where("_stays"), boxes).withColumns({c: F.col(f"_last.{c}") for c in STATION_ATTRS})
    moved = latest_attributes(stations_in_partitions(known.where("not _stays").drop("_last"), boxes), ["i_step", *keys])
    return fixed.drop("_last").unionByName(moved).drop("_stays")


def station_frames(obs: DataFrame, sums: DataFrame, boxes: DataFrame, wanted: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Station-days of each calibration window and partition: masked, in the buffer, latest attributes."""
    windows = window_dates(mask_dead_sensors(obs, sums), wanted, days)
    return latest_in_partitions(windows, boxes, ["date_fin", "stationID"])
