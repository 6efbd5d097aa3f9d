"""Row filters whose NULL handling is spelled out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_city(df: DataFrame, city: str) -> DataFrame:
    return df.where(F.col("locality") == city)


def outside_city(df: DataFrame, city: str) -> DataFrame:
    """The exact complement of :func:`in_city`: an unknown city is outside."""
    return df.where(~F.col("locality").eqNullSafe(city))


def of_hotel(df: DataFrame, name: str, city: str | None = None) -> DataFrame:
    """Rows of one hotel; names repeat across cities unless ``city`` is given."""
    rows = df.where(F.col("name") == name)
    return in_city(rows, city) if city else rows


def with_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in each column, as conditions the optimizer knows."""
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def any_null(c: Column) -> Column:
    """Aggregate: does the column hold a NULL?"""
    return F.bool_or(c.isNull())
