"""What several operators need: session settings, tables in the shared folder, words of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygrid.session import tune
from skygrid.sources.folders import new_folder

# The blanks of every contract: space and the bytes 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Rows per Arrow batch: texts of up to some 100,000 letters must fit a worker many at a time.
ARROW_ROWS = 400


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings of the operators here; sizes and cores stay the cluster's."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, survives lost executors, has a known size."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def whole_text(column: str | Column = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
