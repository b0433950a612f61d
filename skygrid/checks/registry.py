"""Registry of queries over the shared test tables and their plain SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygrid.session import tune
from skygrid.sources.oracle import with_views

# Means of few decimal values often lie halfway between two roundings, where the last bit of a sum
# decides. Both engines round a little to the side of it.
OFF_TIES = 3.7e-8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under ``name``, with its SQL when there is one."""
    def register(fn):
        QUERIES[name] = lambda spark, sf: plain(fn(tune(spark), sf))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types and digits both engines agree on: text dates, long integers, four decimals, no negative zero."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind in ("tinyint", "smallint", "int"):
            c = c.cast("bigint")
        elif kind in ("double", "float"):
            c = F.round(c.cast("double") + OFF_TIES, 4) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def sql(views: str, body: str, text: str = "", ints: str = "", nums: str = "", flags: str = "", more=None) -> str:
    """Wrap a body over views so that its columns come out in the same types and digits."""
    picks = (
        [f'cast("{c}" as varchar) as "{c}"' for c in text.split()]
        + [f'cast("{c}" as bigint) as "{c}"' for c in ints.split()]
        + [f'round(cast("{c}" as double) + {OFF_TIES}, 4) + 0e0 as "{c}"' for c in nums.split()]
        + [f'"{c}" as "{c}"' for c in flags.split()]
    )
    head = with_views(*views.split(), more=more) if views or more else ""
    return f"{head}select {', '.join(picks)} from ({body}) as result"
