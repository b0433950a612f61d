"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Settings that may change at run time; sizes and cores stay the cluster's."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM never compiles methods above 8,000 bytes of bytecode. The weather formulas make such
    # methods when fused into one stage; with this limit Spark splits them into small ones instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark
