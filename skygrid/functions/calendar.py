"""Date rules of the pipeline as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_month_start(d: Column) -> Column:
    """First day of the half month that holds ``d``: the 1st or the 16th."""
    first = F.trunc(d, "MM").cast("date")
    return F.when(F.dayofmonth(d) <= 15, first).otherwise(F.date_add(first, 15))


def half_month_end(d: Column) -> Column:
    return F.when(F.dayofmonth(d) <= 15, F.date_add(F.trunc(d, "MM"), 14)).otherwise(F.last_day(d))


def compact(d: Column) -> Column:
    """``2025-05-01`` as ``20250501``."""
    return F.date_format(d, "yyyyMMdd")


def date_parts(d: Column) -> list[Column]:
    return [F.dayofmonth(d).alias("day"), F.month(d).alias("month"), F.year(d).alias("year")]


def partition_path(root: str, d: Column) -> Column:
    """Folder of one day in a dataset laid out by year, month and day."""
    return F.format_string(f"{root}/year=%d/month=%d/day=%d", F.year(d), F.month(d), F.dayofmonth(d))


def path_part(path: Column, n: int) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(n))


def interpolator_name(d: Column, i_step: Column) -> Column:
    """Key of a stored interpolator; date parts are not padded."""
    return F.format_string(
        "interpolators/interpolator_%d_%d_%d_%d.nc", F.year(d), F.month(d), F.dayofmonth(d), i_step.cast("int")
    )


def interpolator_id(path: Column) -> Column:
    """The digits between the last underscore and the extension."""
    return F.regexp_extract(path, r"_(\d+)\.", 1)
