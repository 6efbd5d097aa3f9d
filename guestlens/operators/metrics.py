"""Classifier metrics by label name, from one confusion matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions import labels

# Output names of the metrics, in the order of the published table.
METRICS = ["Accuracy", "Precision", "Recall", "F1Score", "False Positive Rate", "True Positive Rate"]


def confusion_matrix(
    scored: DataFrame, by: list[str] | None = None, label: str = "review", prediction: str = "predicted_review_label"
) -> DataFrame:
    """Counts per (label, prediction): the only pass over the scored rows."""
    by = by or []
    return scored.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_metrics(matrix: DataFrame, by: list[str] | None = None, positive: str = labels.POSITIVE) -> DataFrame:
    """Accuracy, and precision, recall, F1, FPR and TPR of one class by name."""

    def cells(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))

    is_label, is_predicted = F.col("label") == positive, F.col("prediction") == positive
    sums = matrix.groupBy(*(by or [])).agg(
        F.sum("n").alias("_all"),
        cells(F.col("label") == F.col("prediction")).alias("_right"),
        cells(is_label & is_predicted).alias("_tp"),
        cells(is_predicted).alias("_predicted"),
        cells(is_label).alias("_actual"),
    )
    tp = F.col("_tp")
    recall = ratio(tp, F.col("_actual"))
    return sums.select(
        *(by or []),
        ratio(F.col("_right"), F.col("_all")).alias("Accuracy"),
        ratio(tp, F.col("_predicted")).alias("Precision"),
        recall.alias("Recall"),
        ratio(2 * tp, F.col("_predicted") + F.col("_actual")).alias("F1Score"),
        ratio(F.col("_predicted") - tp, F.col("_all") - F.col("_actual")).alias("False Positive Rate"),
        recall.alias("True Positive Rate"),
    )


def summarize(metrics: DataFrame, metric: str = "Accuracy", by: list[str] | None = None) -> DataFrame:
    """Mean and standard deviation of a metric: the bars and their whiskers."""
    by = by or ["Model", "Prediction Data"]
    return metrics.groupBy(*by).agg(F.avg(metric).alias("mean"), F.stddev(metric).alias("sd"))


def side_by_side(metrics: DataFrame, datasets: list[str], metric: str = "Accuracy") -> DataFrame:
    """One row per model, one column per dataset."""
    return metrics.groupBy("Model").pivot("Prediction Data", datasets).agg(F.avg(metric))
