"""Compare the classifiers on the same three sets of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.operators import metrics, sampling, sentiment
from guestlens.session import materialize

# The names of the three sets in the published table.
TRAINING, VALIDATION, PREDICTION = "training", "validation", "prediction"


def evaluation_sets(reviews: DataFrame, city: str, seed: int = sampling.SPLIT_SEED) -> dict[str, DataFrame]:
    """Train and test split of the balanced other cities, and the held-out city."""
    others, held_out = sampling.split_by_city(reviews, city)
    balanced = materialize(sampling.balance(others.na.drop(), seed), "balanced")
    train, test = sampling.random_split(balanced, seed=seed)
    return {TRAINING: train, VALIDATION: test, PREDICTION: materialize(held_out.na.drop(), "held-out")}


def compare_models(reviews: DataFrame, city: str, kinds=("nb", "rf", "svc"), options: dict | None = None) -> DataFrame:
    """Metrics of each model on each dataset, one confusion matrix per model."""
    sets = evaluation_sets(reviews, city)
    rows = reduce(DataFrame.unionByName, [df.withColumn("Prediction Data", F.lit(name)) for name, df in sets.items()])
    matrices = []
    for kind in kinds:
        model = sentiment.fit(sets[TRAINING], kind, **(options or {}).get(kind, {}))
        matrix = metrics.confusion_matrix(sentiment.score(model, rows), ["Prediction Data"])
        matrices.append(matrix.withColumn("Model", F.lit(sentiment.MODEL_NAMES[kind])))
    return metrics.class_metrics(reduce(DataFrame.unionByName, matrices), ["Model", "Prediction Data"])
