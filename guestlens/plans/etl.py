"""From landed JSON records to one clean review table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.functions import labels, text
from guestlens.operators.joins import merge_reviews_offerings
from guestlens.operators.language import keep_language, with_language
from guestlens.operators.shape import flatten

# Columns that the clean table does without.
UNUSED_COLUMNS = [
    "num_helpful_votes", "date", "via_mobile", "username", "num_cities", "num_reviews",
    "num_type_reviews", "author_id", "region_id", "phone", "details", "type",
    "author_num_helpful_votes", "author_location",
]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in every float column, once, at ingest."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: labels.nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


def flat_reviews(reviews_raw: DataFrame) -> DataFrame:
    """Ratings as columns; author fields that clash get an ``author_`` prefix."""
    flat = flatten(reviews_raw, "ratings")
    clashing = {f: f"author_{f}" for f in ("id", "num_helpful_votes", "location")}
    return flatten(flat, "author", rename=clashing).withColumnRenamed("id", "comment_id")


def flat_offerings(offerings_raw: DataFrame) -> DataFrame:
    renamed = offerings_raw.withColumnRenamed("id", "offering_id")
    return flatten(renamed, "address", rename={"street-address": "street_address", "postal-code": "postal_code"})


def merged_reviews(reviews_raw: DataFrame, offerings_raw: DataFrame) -> DataFrame:
    """Flat reviews with the columns of the hotel they are about."""
    return nan_to_null(merge_reviews_offerings(flat_reviews(reviews_raw), flat_offerings(offerings_raw)))


def english_reviews(
    merged: DataFrame, detect_on: str = "title", keep_unknown: bool = False, profiles: dict | None = None
) -> DataFrame:
    detected = with_language(merged, detect_on, profiles=profiles)
    return keep_language(detected, "en", keep_unknown).drop("language")


def cleaned_reviews(english: DataFrame, line_join: str = "") -> DataFrame:
    """Needed columns, month of stay, sentiment label, clean title and text."""
    return (
        english.drop(*UNUSED_COLUMNS)
        .withColumns({
            "month_stayed": text.first_word(F.col("date_stayed")),
            "review": labels.label_from_rating(F.col("overall")),
            "title": text.clean_text(F.col("title"), line_join),
            "text": text.clean_text(F.col("text"), line_join),
        })
        .drop("date_stayed")
    )


def build_reviews(reviews_raw: DataFrame, offerings_raw: DataFrame, **language_options) -> DataFrame:
    """The whole way in one plan: one join, no intermediate files."""
    return cleaned_reviews(english_reviews(merged_reviews(reviews_raw, offerings_raw), **language_options))
