"""Incremental runs as table operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygrid.params import INTERPOLATION_DAYS_BACK, LAST_DAYS_BACK, RAW_DAYS_BACK


def date_spine(as_of: DataFrame) -> DataFrame:
    """Every date of the run from a one-row frame with ``as_of``."""
    return as_of.select(F.explode(F.sequence(
        F.date_sub("as_of", RAW_DAYS_BACK), F.date_sub("as_of", LAST_DAYS_BACK))).alias("dates"))


def month_spine(as_of: DataFrame, back: int = 364) -> DataFrame:
    """One date per month from ``back`` days ago, each taken to the month's first day."""
    months = F.sequence(F.date_sub("as_of", back), F.date_sub("as_of", LAST_DAYS_BACK), F.expr("interval 1 month"))
    return as_of.select(F.explode(months).alias("d")).select(F.trunc("d", "MM").cast("date").alias("dates"))


def is_recent(d: Column, as_of: Column) -> Column:
    return d >= F.date_sub(as_of, INTERPOLATION_DAYS_BACK)


def pending(spine: DataFrame, done: DataFrame) -> DataFrame:
    """Dates of the spine that have no output yet."""
    return spine.join(done.select("dates").distinct(), "dates", "left_anti")


def retained(table: DataFrame, spine: DataFrame) -> DataFrame:
    """Rows of a concatenated table whose date is still in the spine."""
    return table.join(spine, "dates", "left_semi")


def summary(status: DataFrame) -> DataFrame:
    """Counts of skipped, completed and errored branches per run."""
    return status.groupBy("run_id").agg(*[
        F.count_if(F.col("status") == s).alias(s) for s in ("skipped", "completed", "errored")])
