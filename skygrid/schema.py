"""Column vocabulary and explicit schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column and layer names of the stored tables.
OBS_VARIABLES = (
    "MeanTemperature", "MinTemperature", "MaxTemperature",
    "MeanRelativeHumidity", "MinRelativeHumidity", "MaxRelativeHumidity",
    "Precipitation", "WindSpeed", "WindDirection", "Radiation",
)
CELL_VARIABLES = (
    "MeanTemperature", "MinTemperature", "MaxTemperature",
    "MeanRelativeHumidity", "MinRelativeHumidity", "MaxRelativeHumidity",
    "Precipitation", "Radiation", "WindSpeed", "WindDirection", "PET", "ThermalAmplitude",
)
MAP_VARIABLES = tuple(v for v in CELL_VARIABLES if v != "WindDirection")
NOT_LAYERS = (
    "geom", "geom_hex", "geom_text", "dates", "elevation", "slope", "aspect", "DOY",
    "WindDirection", "TPI", "partition", "day", "month", "year",
)


def _doubles(names):
    return [T.StructField(n, T.DoubleType()) for n in names]


FEED = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType()), T.StructField("stationID", T.StringType())]
    + _doubles(("lon", "lat", "x", "y", "elevation", "slope", "aspect"))
    + _doubles(OBS_VARIABLES)
)
RAW_OBS = T.StructType(
    [
        T.StructField("dates", T.StringType()),
        T.StructField("stationID", T.StringType()),
        T.StructField("service", T.StringType()),
    ]
    + _doubles(("x", "y", "elevation", "slope", "aspect"))
    + _doubles(OBS_VARIABLES)
    + [T.StructField(n, T.IntegerType()) for n in ("year", "month", "day")]
)
