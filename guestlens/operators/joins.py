"""Equi-joins.

No join here is hinted to broadcast a table whose size is unknown: Catalyst and
AQE broadcast under ``spark.sql.autoBroadcastJoinThreshold`` from measured
sizes, and otherwise sort-merge with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.operators import filters

# A group of so many rows or more is hot, but no more than so many groups ever
# are: a group also has at least that part of all rows. Smaller groups fit a
# task each, whatever their number.
HOT_ROWS = 1_000_000
MOST_HOT = 100_000
# Rows of hot groups are spread over so many keys that no total has.
SALTS = 1 << 16


def merge_reviews_offerings(reviews: DataFrame, offerings: DataFrame, key: str = "offering_id") -> DataFrame:
    """Many reviews to one offering, inner."""
    return reviews.join(offerings, key)


def keep_listed(df: DataFrame, ids: DataFrame, key: str = "comment_id") -> DataFrame:
    """Rows whose id is listed. Repeated ids in the list multiply nothing and
    are folded before the shuffle."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def join_totals(
    rows: DataFrame, totals: DataFrame, keys: list[str], names: list[str], size: str, how: str = "inner"
) -> DataFrame:
    """Join a table of one row per key back to its rows, safe for hot keys.

    A window would pull a whole group into one task, and AQE cannot split a
    skewed join against an aggregate. So rows first meet the totals of hot groups,
    those of ``HOT_ROWS`` or more by ``size``, by broadcast: ``MOST_HOT`` rows at
    most. Then all rows are joined by key and salt. Rows that have their total
    already get salts of their own, which no total has, so they spread evenly; all
    others have salt 0. The salt also gives the totals a shuffle of their own,
    whose join AQE may split or turn into a broadcast.

    Only a plan is built. It reads ``rows`` once; hot groups, the bound on them and
    the totals come from the same shuffle of ``totals``.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    totals = filters.with_values(totals, keys).where(F.col(size) > 0).select(*keys, size, *[n for n in names if n != size])
    # Always true. It names every column, so that all uses plan the same shuffle and Spark runs it once.
    totals = totals.where(F.xxhash64(*totals.columns) >= F.lit(-(1 << 63)))
    least = totals.select(F.sum(size) / F.lit(MOST_HOT)).scalar()
    hot = totals.where((F.col(size) >= HOT_ROWS) & (F.col(size) >= least))
    hot = hot.select(*keys, F.struct(*[F.col(n) for n in names]).alias("_hot"))
    spread = F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int") + 1
    met = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(spread))
    salted = totals.select(*keys, F.lit(0).alias("_salt"), F.struct(*[F.col(n) for n in names]).alias("_total"))
    joined = met.join(salted, [*keys, "_salt"], "left").withColumn("_total", F.coalesce("_hot", "_total"))
    if how == "inner":
        joined = joined.where(F.col("_total").isNotNull())
    return joined.select(*columns, *[F.col("_total").getField(n).alias(n) for n in names])


def join_predictions(reviews: DataFrame, predictions: DataFrame, key: str = "comment_id") -> DataFrame:
    """Attach one prediction per review id, whatever repeats on either side.

    Columns that both sides have are kept from ``reviews``.
    """
    names = [c for c in predictions.columns if c not in (key, *reviews.columns)]
    best = (
        predictions.groupBy(key, *names).agg(F.count("*").alias("_n"))
        .groupBy(key)
        .agg(F.min(F.struct(*names)).alias("_p"), F.sum("_n").alias("_rows"))
        .select(key, "_rows", "_p.*")
    )
    return join_totals(reviews, best, [key], names, "_rows")


def with_group_totals(df: DataFrame, key: str, totals: dict[str, Column]) -> DataFrame:
    """Each row with aggregates of its group: the map or merge of a group-by.

    Rows without a key are dropped.
    """
    rows = df.where(F.col(key).isNotNull())
    grouped = rows.groupBy(key).agg(F.count("*").alias("_rows"), *[c.alias(n) for n, c in totals.items()])
    return join_totals(rows, grouped, [key], list(totals), "_rows")
