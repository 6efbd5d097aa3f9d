"""Splits and samples that depend on the row alone.

Membership comes from a hash of the id, not from the row's place in a
partition, so a task that is run again after a lost executor picks the same
rows and every split is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from guestlens.functions import labels
from guestlens.functions.text import review_text
from guestlens.operators import filters

# What the sampling fraction of positives adds to the share of
# negatives, and the train/test split with its seed.
EXTRA_POSITIVES = 0.1
TRAIN_SHARE, SPLIT_SEED = 0.8, 13

HASH_RANGE = 1 << 32
BUCKETS = 1 << 16


def id_hash(key: str, seed: int, purpose: str = "sample") -> Column:
    """32 bits of a seeded MD5 of the id, as a long.

    Hashes for different purposes are independent, so a split of a sample is a
    split like any other.
    """
    digest = F.md5(F.concat_ws(":", F.lit(purpose), F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def in_sample(key: str, fraction: Column | float, seed: int, purpose: str = "sample") -> Column:
    return id_hash(key, seed, purpose) < F.least(F.lit(1.0), F.lit(fraction)) * HASH_RANGE


def random_split(df: DataFrame, key: str = "comment_id", share: float = TRAIN_SHARE, seed: int = SPLIT_SEED):
    """Two disjoint parts that cover ``df``; rows without an id go to the second."""
    chosen = F.coalesce(in_sample(key, share, seed, "split"), F.lit(False))
    return df.where(chosen), df.where(~chosen)


def model_rows(reviews: DataFrame) -> DataFrame:
    """What the classifiers see of a review."""
    return reviews.select(
        "comment_id", "review", review_text(F.col("title"), F.col("text")).alias("review_text"), "locality"
    )


def split_by_city(reviews: DataFrame, city: str) -> tuple[DataFrame, DataFrame]:
    """(training rows of all other cities, rows of the city)."""
    rows = model_rows(reviews)
    return filters.outside_city(rows, city).drop("locality"), filters.in_city(rows, city).drop("locality")


def positive_fraction(train: DataFrame) -> Column:
    """Share of negatives plus a constant, one aggregate as a scalar subquery."""
    negatives = F.count_if(F.col("review") == labels.NEGATIVE)
    return train.select(negatives / F.nullif(F.count("*"), F.lit(0)) + EXTRA_POSITIVES).scalar()


def balance(train: DataFrame, seed: int = SPLIT_SEED, key: str = "comment_id") -> DataFrame:
    """All negatives and a Bernoulli sample of the positives.

    The union of the two classes is one filter, so the data is read once, plus
    once for the fraction.
    """
    is_negative = F.col("review") == labels.NEGATIVE
    is_positive = F.col("review") == labels.POSITIVE
    return train.where(is_negative | (is_positive & in_sample(key, positive_fraction(train), seed)))


def balance_exact(train: DataFrame, seed: int = SPLIT_SEED, key: str = "comment_id") -> DataFrame:
    """As many positives as negatives: per class, the rows of lowest id hash.

    Ranking a class would sort it in one task. Instead the hash range is cut
    into ``BUCKETS`` buckets whose counts, at most one per bucket and class,
    are summed up in order. Only the one bucket per class in which the sum
    reaches the smaller class is ranked, 1/65536 of the class, to find the last
    row to keep. Both look at ids and labels only; whole rows are read once, by
    a filter against those two last rows.
    """
    position = F.struct(id_hash(key, seed).alias("hash"), F.col(key).alias("id"))
    bucket = F.shiftright(F.col("_at.hash"), 16).cast("int")
    placed = train.where(F.col("review").isin(labels.POSITIVE, labels.NEGATIVE)).withColumn("_at", position)
    buckets = placed.select("review", "_at", bucket.alias("_bucket"))

    counts = buckets.groupBy("review", "_bucket").agg(F.count("*").alias("_n"))
    classes = counts.groupBy("review").agg(F.sum("_n").alias("_class"))
    target = classes.select(F.when(F.count("*") == 2, F.min("_class")).otherwise(0)).scalar()
    upto = W.partitionBy("review").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    cuts = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .where((F.col("_upto") >= target) & (F.col("_upto") - F.col("_n") < target))
        .select("review", "_bucket", (target - F.col("_upto") + F.col("_n")).alias("_wanted"))
    )
    order = W.partitionBy("review", "_bucket").orderBy("_at")
    last = (
        buckets.join(F.broadcast(cuts), ["review", "_bucket"])
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_wanted"))
        .select("review", F.col("_at").alias("_last"))
    )
    return placed.join(F.broadcast(last), "review").where(F.col("_at") <= F.col("_last")).select(train.columns)
