"""Rankings kept up to date: mergeable partial aggregates per hotel and part of the reviews.

A partial row says what the reviews of one hotel in one part (a month, a load)
add to every ranking. Counts and sums add up and maxima merge, so rankings read
partials instead of reviews, and new reviews cost one pass over themselves:
their partials are appended to the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.operators import ranking
from guestlens.schemas import CATEGORIES


def partial_scores(
    reviews: DataFrame,
    part: str,
    by: tuple[str, ...] = ("name", "locality"),
    categories: list[str] = CATEGORIES,
    label: str = ranking.PREDICTED,
) -> DataFrame:
    """One row per hotel and part: counts, and best, sum and number of every category's scores."""
    for category in categories:
        reviews = ranking.impute_category(reviews, category, label)
    scores = [a for c in categories for a in (F.max(c).alias(f"{c}_best"), F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]
    return reviews.groupBy(*by, part).agg(F.count("*").alias("review_count"), ranking.positives(label).alias("positive_counts"), *scores)


def merged(partials: DataFrame, *by: str) -> DataFrame:
    """Partials with the same ``by`` as one row; with the part among them, a compacted table."""
    merge = {True: F.max, False: F.sum}
    columns = [c for c in partials.columns if c.endswith(("_best", "_sum", "_n", "_count", "_counts"))]
    return partials.groupBy(*by).agg(*[merge[c.endswith("_best")](c).alias(c) for c in columns])


def top_hotels(partials: DataFrame, k: int = ranking.TOP_HOTELS, key: str = "name") -> DataFrame:
    """``ranking.top_hotels`` of the reviews that the partials stand for."""
    order = F.desc("positive_counts"), F.asc(key)
    totals = merged(partials.where(F.col(key).isNotNull()), key).select(key, "review_count", "positive_counts")
    return ranking.ranked(totals.orderBy(*order).limit(k), *order)


def top_by_category(
    partials: DataFrame, category: str, k: int = ranking.TOP_CATEGORY, mode: str = "max", key: str = "name"
) -> DataFrame:
    """``ranking.top_by_category`` of the reviews that the partials stand for."""
    hotels = merged(partials, key)
    own = [F.col(f"{category}{c}").alias(c) for c in ("_best", "_sum", "_n")]
    return ranking.top_scores(ranking.smoothed(hotels.select(key, "review_count", "positive_counts", *own), mode, key), k, key)
