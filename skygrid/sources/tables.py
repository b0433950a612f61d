"""Stored tables: partitioned Parquet, scanned with explicit pruning predicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from skygrid import schema
from skygrid.functions import calendar as cal
from skygrid.params import (
    BITMAP_ROWS_PER_GROUP, CV_ROWS_PER_GROUP, INTERPOLATED_ROWS_PER_FILE, INTERPOLATED_ROWS_PER_GROUP,
)

DAY_KEYS = ("year", "month", "day")


def _day_writer(df: DataFrame) -> DataFrameWriter:
    # Only the days present in the frame are replaced.
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*DAY_KEYS)


def with_day_keys(df: DataFrame) -> DataFrame:
    day, month, year = cal.date_parts(F.col("dates"))
    return df.withColumns({"day": day, "month": month, "year": year})


def spread_for_files(df: DataFrame, keys: list[str], row_id: str, rows_per_file: int = INTERPOLATED_ROWS_PER_FILE) -> DataFrame:
    """One shuffle that puts each key's rows into as few tasks as its row count asks for.

    A key of up to ``rows_per_file`` rows goes to one task, a larger one to several, so a hot day is
    written in parallel. The number of tasks is the session's, so small days are not all left to one.
    """
    counts = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    spread = df.join(counts, keys).withColumn("_file", F.pmod(F.xxhash64(row_id), F.col("_files")))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(tasks, *keys, "_file").drop("_files", "_file")


def write_raw(obs: DataFrame, path: str) -> None:
    """Observations by day, dates stored as text."""
    out = with_day_keys(obs).withColumn("dates", F.date_format("dates", "yyyy-MM-dd"))
    # Spark sizes the tasks from what the days' shuffle holds, so station-days are made once and not counted before.
    _day_writer(out.hint("rebalance", *DAY_KEYS)).parquet(path)


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.RAW_OBS).parquet(path)


def day_range(first, last) -> Column:
    """Predicate on the partition columns that covers an inclusive range of dates."""
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    lo, hi = (int(str(d).replace("-", "")) for d in (first, last))
    return key.between(lo, hi)


def date_list(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Exactly the day folders of a date frame; the semi join prunes folders at run time."""
    keys = with_day_keys(wanted.select("dates").distinct()).select(*DAY_KEYS)
    return spark.read.parquet(path).join(keys, list(DAY_KEYS), "left_semi")


def write_topo(topo: DataFrame, path: str) -> None:
    """Grid cells by partition, ordered inside the files so that row groups cover small boxes."""
    (
        spread_for_files(topo, ["partition"], "cell_id").sortWithinPartitions("partition", "y", "x")
        .write.mode("overwrite").partitionBy("partition").parquet(path)
    )


def scan_topo(spark: SparkSession, path: str, partitions: list[int] | None = None) -> DataFrame:
    topo = spark.read.parquet(path)
    return topo if partitions is None else topo.filter(F.col("partition").isin(list(partitions)))


def write_interpolated(
    cells: DataFrame, path: str, rows_per_group: int = INTERPOLATED_ROWS_PER_GROUP,
    rows_per_file: int = INTERPOLATED_ROWS_PER_FILE,
) -> None:
    """Cells by day. Rows are ordered by place, so small row groups can be skipped by their x and y range.

    Spark sizes the tasks from what the days' shuffle holds (a hot day goes to several), so cell-days are made once and not counted before.
    """
    out = with_day_keys(cells).hint("rebalance", *DAY_KEYS)
    out = out.sortWithinPartitions(*DAY_KEYS, "partition", "y", "x")
    (
        _day_writer(out).option("maxRecordsPerFile", rows_per_file)
        .option("parquet.block.row.count.limit", rows_per_group).parquet(path)
    )


def relayout(spark: SparkSession, source: str, target: str, rows_per_group: int) -> None:
    """The same dataset at another row-group size."""
    write_interpolated(spark.read.parquet(source).drop(*DAY_KEYS), target, rows_per_group)


def write_by_date(df: DataFrame, path: str, date_column: str, rows_per_group: int) -> None:
    """One table of all days in date order."""
    (
        df.repartitionByRange(F.col(date_column)).sortWithinPartitions(date_column)
        .write.mode("overwrite").option("parquet.block.row.count.limit", rows_per_group).parquet(path)
    )


def write_bitmaps(bitmaps: DataFrame, path: str) -> None:
    write_by_date(bitmaps, path, "date", BITMAP_ROWS_PER_GROUP)


def scan_bitmaps(spark: SparkSession, path: str, compact_date: str | None = None) -> DataFrame:
    bitmaps = spark.read.parquet(path)
    return bitmaps if compact_date is None else bitmaps.filter(F.col("date") == compact_date)


def write_cv(cv_long: DataFrame, path: str) -> None:
    write_by_date(cv_long, path, "dates", CV_ROWS_PER_GROUP)


def write_region_series(series: DataFrame, path: str, regions_per_day: int) -> None:
    """Region series, one folder per administrative level."""
    (
        series.repartitionByRange("admin_level", "dates").sortWithinPartitions("admin_level", "dates")
        .write.mode("overwrite").option("parquet.block.row.count.limit", regions_per_day)
        .partitionBy("admin_level").parquet(path)
    )


def store_interpolator(obs: DataFrame, params: DataFrame, path: str, place: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Station frames and smoothing parameters of calibrated days.

    With ``place``, ``obs`` are station-days that are not under their partitions yet. They go to the files' tasks as they are, and ``place`` lists
    them under partitions there: what moves is a row per station-day, and the copies of a row lie side by side in the file.
    """
    per_file = INTERPOLATED_ROWS_PER_FILE // 10 if place else INTERPOLATED_ROWS_PER_FILE
    spread = spread_for_files(obs, ["date_fin"], "stationID", per_file).sortWithinPartitions("date_fin")
    frames = {"obs": place(spread) if place else spread, "params": spread_for_files(params, ["date_fin"], "i_step")}
    for name, frame in frames.items():
        (
            frame.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("date_fin").parquet(f"{path}/{name}")
        )


def load_interpolator(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/obs"), spark.read.parquet(f"{path}/params")


def materialize(df: DataFrame, path: str, *keys: str) -> DataFrame:
    """The frame as a written table, so that steps that read it many times do not repeat its work.

    A written table survives lost executors, and its readers prune columns and know its size.
    """
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_days(df: DataFrame, path: str, *keys: str, rows_per_group: int | None = None) -> None:
    """Rows into the folders of their days (``keys``); only the days in the frame are replaced."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(tasks, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    (writer.option("parquet.block.row.count.limit", rows_per_group) if rows_per_group else writer).parquet(path)


def drop_days(spark: SparkSession, path: str, keys: tuple[str, ...], day: Column, spine: DataFrame) -> int:
    """Removes the folders of days that are not in ``spine`` (``dates``); returns how many. ``day`` is the date that the folder keys name.

    Whole folders go, through the file system the table lies on; tables not written yet, and rows without a day, are left alone.
    """
    stored = stored_or_none(spark, path)
    if stored is None:
        return 0
    # A row per folder: days of a calendar.
    old = stored.select(*keys).distinct().withColumn("dates", day).where("dates is not null").join(spine.select("dates"), "dates", "left_anti").select(*keys).collect()
    hadoop = spark._jvm.org.apache.hadoop.fs
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for row in old:
        folder = root
        for key in keys:
            folder = hadoop.Path(folder, f"{key}={escaped(str(row[key]))}")
        files.delete(folder, True)
    spark.catalog.refreshByPath(path)
    return len(old)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or nothing when it has not been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def file_boxes(df: DataFrame, file_key: str, x: str = "x", y: str = "y") -> DataFrame:
    """Ranges of x and of y per file, taken apart and joined in full."""
    xs = df.filter(F.col(x).isNotNull()).groupBy(file_key).agg(F.min(x).alias("xmin"), F.max(x).alias("xmax"))
    ys = df.filter(F.col(y).isNotNull()).groupBy(file_key).agg(F.min(y).alias("ymin"), F.max(y).alias("ymax"))
    return xs.join(ys, file_key, "full_outer")
