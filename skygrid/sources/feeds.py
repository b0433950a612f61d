"""Station feeds landed as files, one folder per service."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygrid import schema
from skygrid.params import SERVICE_LAG_DAYS


def read_feed(spark: SparkSession, path: str, fmt: str, service: str) -> DataFrame:
    """Landed files of one service, read with the fixed feed schema (no inference)."""
    reader = spark.read.schema(schema.FEED).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path).withColumn("service", F.lit(service))


def read_feeds(spark: SparkSession, folders: dict[str, tuple[str, str]]) -> DataFrame:
    """All services, given as ``{service: (path, format)}``."""
    frames = [read_feed(spark, path, fmt, service) for service, (path, fmt) in folders.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def target_days(obs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose timestamp falls on a wanted date; adds ``dates``."""
    return obs.withColumn("dates", F.to_date("timestamp")).join(wanted.select("dates"), "dates", "left_semi")


def is_available(service: Column, d: Column, as_of: Column) -> Column:
    """A service's lag has passed; services without a lag are always available."""
    checks = F.lit(True)
    for name, lag in SERVICE_LAG_DAYS.items():
        checks = F.when(service == name, d < F.date_sub(as_of, lag)).otherwise(checks)
    return checks
