"""The shared test tables in the shapes of stations, observations, grid cells and regions.

The test tables carry no coordinates; positions are integer arithmetic on keys. Everything is derived
in Spark from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygrid.operators import grid
from skygrid.params import SHORT_NAMES

WIDTH = 500000.0
CELL_XMIN, CELL_YMIN = 300137.0, 4100137.0
CELL_XMAX, CELL_YMAX = CELL_XMIN + WIDTH, CELL_YMIN + WIDTH


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _double(c):
    return c.cast("double")


def stations(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    service = (
        F.when(k % 4 == 0, "aemet").when(k % 4 == 1, "meteocat").when(k % 4 == 2, "meteogalicia").otherwise("ria")
    )
    return table(spark, sf, "supplier").select(
        k.alias("sid"), F.concat(F.lit("ST"), k.cast("string")).alias("stationID"), service.alias("service"),
        (300000.0 + (k * 940) % 997 * 500.0).alias("x"), (4100000.0 + (k * 44) % 997 * 500.0).alias("y"),
        _double(k * 37 % 2000).alias("elevation"), _double(k * 13 % 45).alias("slope"),
        _double(k * 31 % 360).alias("aspect"),
    )


def _weather(table_key: str, other_key: str):
    low_line = F.min("l_linenumber") <= 3
    # The flag is one letter; its code keeps the aggregate on the hash path, which text would leave.
    return {
        "MinTemperature": F.min("l_quantity") / 2.0 - 5.0,
        "MaxTemperature": F.min("l_quantity") / 2.0 - 3.0 + F.max("l_discount") * 100.0,
        "Precipitation": F.when(low_line, 0.0).otherwise(F.max("l_quantity") / 5.0),
        "WindSpeed": F.when(F.max(F.ascii("l_returnflag")) == ord("N"), F.lit(None)).otherwise(F.min("l_tax") * 100.0),
        "WindDirection": _double(F.min(other_key) % 360),
        "MinRelativeHumidity": 20.0 + F.min("l_discount") * 200.0,
        "MaxRelativeHumidity": 60.0 + F.max("l_discount") * 300.0,
        "Radiation": 5.0 + F.max("l_tax") * 200.0,
    }


def raw_obs(spark: SparkSession, sf: str) -> DataFrame:
    """Station-days with dead rain sensors (every 17th), dead wind sensors (every 19th) and missing wind."""
    exprs = _weather("l_suppkey", "l_partkey")
    k = F.col("l_suppkey")
    items = table(spark, sf, "lineitem").withColumn("dates", F.to_date("l_shipdate"))
    obs = items.groupBy("l_suppkey", "dates").agg(*[e.alias(n) for n, e in exprs.items()])
    return obs.select(
        k.alias("sid"), "dates",
        *[n for n in exprs if n not in ("Precipitation", "WindSpeed")],
        F.when(k % 17 == 0, 0.0).otherwise(F.col("Precipitation")).alias("Precipitation"),
        F.when(k % 19 == 0, 0.0).otherwise(F.col("WindSpeed")).alias("WindSpeed"),
    )


def obs(spark: SparkSession, sf: str) -> DataFrame:
    """Observations with their station's attributes, before any filling."""
    return raw_obs(spark, sf).join(stations(spark, sf), "sid")


def cells(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    ncol = part.agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("bigint").alias("ncol")).scalar()
    k = F.col("p_partkey")
    r = F.floor(k / F.col("ncol")).cast("bigint")
    return part.select("p_partkey", ncol.alias("ncol")).select(
        k.alias("cell_id"), r.alias("r"), (k % F.col("ncol")).alias("c"),
        (CELL_XMIN + (k % F.col("ncol") + 0.5) * (WIDTH / F.col("ncol"))).alias("x"),
        (CELL_YMIN + (r + 0.5) * (WIDTH / F.col("ncol"))).alias("y"),
        _double(k * 53 % 1500).alias("elevation"),
    )


def topo(spark: SparkSession, sf: str) -> DataFrame:
    """Grid cells with terrain and their spatial partition, small partitions merged."""
    base = cells(spark, sf).withColumns({
        "slope": _double(F.col("cell_id") * 7 % 30), "aspect": _double(F.col("cell_id") * 29 % 360),
        "TPI": _double(F.col("cell_id") * 11 % 21) - 10.0,
    })
    extent = (CELL_XMIN, CELL_XMAX, CELL_YMIN, CELL_YMAX)
    return grid.merge_partitions(base.withColumn("partition", grid.partition_id(F.col("x"), F.col("y"), extent)))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """Octagons about 100 km wide; every fifth has a square hole."""
    k = F.col("n_nationkey")
    cx, cy = F.col("cx"), F.col("cy")

    def ring(points):
        return F.concat(*[
            part for i, (dx, dy) in enumerate(points)
            for part in ([F.lit(", ")] if i else [])
            + [(cx + dx).cast("string"), F.lit(" "), (cy + dy).cast("string")]
        ])

    a, b, h = 50000, 30000, 10000
    outer = [(-a, -b), (-b, -a), (b, -a), (a, -b), (a, b), (b, a), (-b, a), (-a, b), (-a, -b)]
    hole = [(-h, -h), (h, -h), (h, h), (-h, h), (-h, -h)]
    base = table(spark, sf, "nation").select(
        k.alias("rid"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("province"),
        (350000 + k % 5 * 100000).alias("cx"),
        (4150000 + F.floor(k / 5) * 100000).cast("bigint").alias("cy"),
    )
    return base.select("*", F.concat(
        F.lit("POLYGON (("), ring(outer), F.lit(")"),
        F.when(F.col("rid") % 5 == 0, F.concat(F.lit(", ("), ring(hole), F.lit(")"))).otherwise(""),
        F.lit(")"),
    ).alias("wkt"))


def interpolated(spark: SparkSession, sf: str) -> DataFrame:
    """Cell-days in the published shape, values taken from order lines of the cell's part."""
    exprs = _weather("l_partkey", "l_suppkey")
    # Order lines go to the task of their part, where they become cell-days and meet their cell: those are not shuffled.
    base = table(spark, sf, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("dates"), "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    ).repartition("l_partkey")
    days = base.groupBy("l_partkey", "dates").agg(
        *[e.alias(n) for n, e in exprs.items()], (F.max("l_discount") * 40.0).alias("PET"),
    ).withColumnRenamed("l_partkey", "cell_id")
    lo, hi = F.col("MinTemperature"), F.col("MaxTemperature")
    return days.withColumns({
        "MeanTemperature": 0.606 * hi + 0.394 * lo,
        "MeanRelativeHumidity": (F.col("MinRelativeHumidity") + F.col("MaxRelativeHumidity")) / 2.0,
        "ThermalAmplitude": hi - lo,
    })


def interpolated_cells(spark: SparkSession, sf: str) -> DataFrame:
    return interpolated(spark, sf).join(topo(spark, sf), "cell_id")


def calibrations(spark: SparkSession, sf: str) -> DataFrame:
    """A calibration table: one row per day and partition, parameters on the daily grid's range."""
    days = table(spark, sf, "lineitem").withColumn("dates", F.to_date("l_shipdate"))
    days = days.groupBy("dates", (F.col("l_suppkey") % 29).cast("int").alias("i_step"))
    lines, parts = F.min("l_linenumber"), F.max("l_partkey")
    aggs = [F.count_distinct("l_suppkey").alias("n_stations"), F.count(F.lit(1)).alias("topo_ncells")]
    for k, short in enumerate(SHORT_NAMES.values()):
        aggs += [
            (20 * ((lines + k) % 8) + 20).cast("double").alias(f"{short}_n"),
            (10 * ((parts + k) % 5) + 10).cast("double").alias(f"{short}_alpha"),
            (F.max("l_discount") * (10.0 + k) + F.min("l_tax")).alias(f"{short}_mae"),
        ]
    d = F.col("dates")
    return days.agg(*aggs).select(
        d.alias("date_fin"), F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year"), "*"
    ).drop("dates")
