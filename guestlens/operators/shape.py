"""Projections: flatten, rename, drop, cast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, struct: str, prefix: str = "", rename: dict[str, str] | None = None) -> DataFrame:
    """Lift the fields of a struct column to the top level, in one projection.

    ``prefix`` keeps clashing names apart; ``rename`` wins over it.
    """
    rename = rename or {}
    fields = df.schema[struct].dataType.fieldNames()
    lifted = [F.col(f"`{struct}`.`{f}`").alias(rename.get(f, prefix + f)) for f in fields]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != struct], *lifted)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(f"`{name}`").cast(kind) for name, kind in types.items()})
