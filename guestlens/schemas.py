"""Fixed schemas of every stage; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

CATEGORIES = ["service", "cleanliness", "location", "value", "rooms"]

RATINGS = T.StructType([T.StructField(c, T.DoubleType()) for c in ["overall", *CATEGORIES]])

AUTHOR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("num_cities", T.LongType()),
    T.StructField("num_helpful_votes", T.LongType()),
    T.StructField("num_reviews", T.LongType()),
    T.StructField("num_type_reviews", T.LongType()),
    T.StructField("location", T.StringType()),
])

ADDRESS = T.StructType([
    T.StructField("street-address", T.StringType()),
    T.StructField("locality", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("postal-code", T.StringType()),
])

REVIEWS_RAW = T.StructType([
    T.StructField("ratings", RATINGS),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("author", AUTHOR),
    T.StructField("date_stayed", T.StringType()),
    T.StructField("offering_id", T.LongType()),
    T.StructField("num_helpful_votes", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("via_mobile", T.BooleanType()),
])

OFFERINGS_RAW = T.StructType([
    T.StructField("hotel_class", T.DoubleType()),
    T.StructField("region_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("address", ADDRESS),
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])

MODEL_INPUT = T.StructType([
    T.StructField("comment_id", T.LongType()),
    T.StructField("review", T.StringType()),
    T.StructField("review_text", T.StringType()),
])

# Column names of the published metrics file.
MODEL_METRICS = T.StructType([
    T.StructField("Model", T.StringType()),
    T.StructField("Prediction Data", T.StringType()),
    T.StructField("Accuracy", T.DoubleType()),
    T.StructField("Precision", T.DoubleType()),
    T.StructField("Recall", T.DoubleType()),
    T.StructField("F1Score", T.DoubleType()),
    T.StructField("False Positive Rate", T.DoubleType()),
    T.StructField("True Positive Rate", T.DoubleType()),
])
