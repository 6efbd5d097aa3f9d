"""Sentiment labels, rating scores and the numbered choices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE, NEGATIVE = "positive", "negative"

# Rating cut of the label, score standing in for a missing
# rating, numbered cities and numbered categories.
POSITIVE_FROM = 3
LABEL_SCORES = {POSITIVE: 4.0, NEGATIVE: 2.0}
CITIES = {
    1: "New York City", 2: "Chicago", 3: "San Francisco", 4: "San Diego", 5: "Los Angeles",
    6: "Philadelphia", 7: "Dallas", 8: "Indianapolis", 9: "Boston", 10: "Washington DC",
}
CATEGORY_CHOICES = {1: "service", 2: "cleanliness", 3: "location", 4: "value", 5: "rooms"}


def nan_to_null(c: Column) -> Column:
    """Spark sorts NaN above every number and lets it poison averages."""
    return F.when(~F.isnan(c), c)


def label_from_rating(overall: Column) -> Column:
    """``positive`` from the cut up; missing ratings count as ``negative``."""
    return F.when(nan_to_null(overall) >= POSITIVE_FROM, POSITIVE).otherwise(NEGATIVE)


def lookup(c: Column, table: dict) -> Column:
    """A small fixed enumeration; unknown keys give NULL."""
    return F.coalesce(*[F.when(c == key, F.lit(value)) for key, value in table.items()])


def city_name(choice: Column) -> Column:
    return lookup(choice.try_cast("int"), CITIES)


def category_name(choice: Column) -> Column:
    return lookup(choice.try_cast("int"), CATEGORY_CHOICES)


def is_choice(choice: Column, table: dict) -> Column:
    """Is it a number in the table; what is no number is no choice."""
    return F.coalesce(choice.try_cast("int").isin(*table), F.lit(False))


def score_or_imputed(score: Column, label: Column) -> Column:
    """The given score, else the one its predicted label stands for."""
    return F.coalesce(nan_to_null(score), lookup(label, LABEL_SCORES))
