"""Predict the sentiment of a city's reviews and rank its hotels by it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.operators import filters, ranking, sampling, sentiment
from guestlens.session import materialize


def training_rows(reviews: DataFrame, city: str, seed: int = sampling.SPLIT_SEED) -> DataFrame:
    """Complete, balanced rows of every other city."""
    train, _ = sampling.split_by_city(reviews, city)
    return sampling.balance(train.na.drop(), seed)


def train_for_city(reviews: DataFrame, city: str, kind: str = "nb", seed: int = sampling.SPLIT_SEED, **options) -> PipelineModel:
    """A model for a held-out city; save it and reuse it for every question."""
    return sentiment.fit(materialize(training_rows(reviews, city, seed), "training"), kind, **options)


def score_city(reviews: DataFrame, city: str, model: PipelineModel) -> DataFrame:
    """The city's reviews with id and text, labelled or not, with predicted labels.

    Columns ride through the model, so predictions need no join back.
    """
    text = sampling.review_text(F.col("title"), F.col("text"))
    rows = filters.in_city(reviews, city).withColumn("review_text", text)
    rows = rows.na.drop(subset=["comment_id", "review_text"])
    return sentiment.score(model, rows).drop("review_text", "rawPrediction", "probability")


def predict_city(reviews: DataFrame, city: str, kind: str = "nb", **options) -> DataFrame:
    return score_city(reviews, city, train_for_city(reviews, city, kind, **options))


def top_hotels_of_city(reviews: DataFrame, city: str, model: PipelineModel, k: int = ranking.TOP_HOTELS) -> DataFrame:
    """The hotels with the most reviews predicted positive."""
    return ranking.top_hotels(score_city(reviews, city, model), k)


def top_category_of_city(
    reviews: DataFrame, city: str, category: str, model: PipelineModel, k: int = ranking.TOP_CATEGORY, mode: str = "max"
) -> DataFrame:
    """The best hotels by a category, gaps filled from the predicted label."""
    return ranking.top_by_category(score_city(reviews, city, model), category, k, mode)
