"""Hotel totals, rankings and category scores.

Each ranking is one map-side-combined aggregate per hotel and a top-k; no sort,
window or de-duplication ever sees single reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from guestlens.functions import labels
from guestlens.operators.joins import with_group_totals

# Weight of the global mean in a category score, report sizes.
SMOOTHING = 10
TOP_HOTELS, TOP_CATEGORY = 5, 10

PREDICTED = "predicted_review_label"


def positives(label: str = PREDICTED) -> Column:
    return F.count_if(F.col(label) == labels.POSITIVE)


def with_hotel_counts(reviews: DataFrame, key: str = "name", label: str = PREDICTED) -> DataFrame:
    """Every review with ``review_count`` and ``positive_counts`` of its hotel."""
    return with_group_totals(reviews, key, {"review_count": F.count("*"), "positive_counts": positives(label)})


def hotel_totals(reviews: DataFrame, key: str = "name", label: str = PREDICTED) -> DataFrame:
    """One row per hotel: reviews and positive reviews."""
    return (
        reviews.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("review_count"), positives(label).alias("positive_counts"))
    )


def ranked(top: DataFrame, *order: Column) -> DataFrame:
    """Number the rows of a top-k; only ever called on its few rows."""
    return top.withColumn("rank", F.row_number().over(W.orderBy(*order)).cast("bigint"))


def top_hotels(reviews: DataFrame, k: int = TOP_HOTELS, key: str = "name", label: str = PREDICTED) -> DataFrame:
    order = F.desc("positive_counts"), F.asc(key)
    return ranked(hotel_totals(reviews, key, label).orderBy(*order).limit(k), *order)


def impute_category(reviews: DataFrame, category: str, label: str = PREDICTED) -> DataFrame:
    """Fill gaps of a category score from the predicted sentiment."""
    return reviews.withColumn(category, labels.score_or_imputed(F.col(category), F.col(label)))


def category_scores(
    reviews: DataFrame, category: str, mode: str = "max", key: str = "name", label: str = PREDICTED
) -> DataFrame:
    """Smoothed score per hotel: ``(n * score + 10 * mean) / (n + 10)``.

    ``mode='max'`` scores a hotel by its best review, as published;
    ``mode='mean'`` by its average. The global mean comes from the per-hotel
    sums as a scalar subquery over the same aggregate.
    """
    hotels = (
        impute_category(reviews, category, label)
        .groupBy(key)
        .agg(
            F.count("*").alias("review_count"),
            positives(label).alias("positive_counts"),
            F.max(category).alias("_best"),
            F.sum(category).alias("_sum"),
            F.count(category).alias("_n"),
        )
    )
    return smoothed(hotels, mode, key)


def smoothed(hotels: DataFrame, mode: str, key: str = "name") -> DataFrame:
    """Category scores from one row per hotel: review_count, positive_counts, _best, _sum and _n of the category."""
    if mode not in ("max", "mean"):
        raise ValueError(f"unknown mode {mode!r}")
    # Always true. It names every column, so that the scalar subquery plans the
    # same shuffle as the ranking and Spark runs it, and the scoring below it, once.
    whole = (F.col("review_count") >= F.col("positive_counts")) & (F.col("_best").isNull() | (F.col("_n") > 0))
    hotels = hotels.where(F.col(key).isNotNull() & whole)
    mean = hotels.select(F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).scalar()
    score = F.col("_best") if mode == "max" else F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))
    weighted = (F.col("review_count") * score + SMOOTHING * mean) / (F.col("review_count") + SMOOTHING)
    return hotels.select(key, weighted.alias("weighted_avg"), "review_count", "positive_counts")


def top_by_category(
    reviews: DataFrame,
    category: str,
    k: int = TOP_CATEGORY,
    mode: str = "max",
    key: str = "name",
    label: str = PREDICTED,
) -> DataFrame:
    return top_scores(category_scores(reviews, category, mode, key, label), k, key)


def top_scores(scores: DataFrame, k: int = TOP_CATEGORY, key: str = "name") -> DataFrame:
    order = F.desc_nulls_last("weighted_avg"), F.desc("positive_counts"), F.asc(key)
    return ranked(scores.orderBy(*order).limit(k), *order)
