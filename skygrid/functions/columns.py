"""Helpers that return column lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

OBS_PATTERNS = ("Temperature", "RelativeHumidity", "Precipitation", "Wind", "Radiation")


def matching(df: DataFrame, *patterns: str) -> list[str]:
    """Columns matching any pattern, case-sensitive, each once, in pattern order."""
    out: list[str] = []
    for pattern in patterns:
        out += [c for c in df.columns if re.search(pattern, c) and c not in out]
    return out


def rounded(df: DataFrame, decimals: int = 4) -> DataFrame:
    """Every double rounded, with negative zero removed."""
    return df.select(*[
        (F.round(F.col(f"`{c}`"), decimals) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`")
        for c, t in df.dtypes
    ])


def means(columns: list[str]) -> list[Column]:
    return [F.avg(c).alias(c) for c in columns]


def clean_means(columns: list[str]) -> list[Column]:
    """Means that skip NaN as well as NULL."""
    return [F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in columns]
