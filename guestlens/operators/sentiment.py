"""Sentiment classifiers: the same text features under three estimators."""

from __future__ import annotations

from math import isqrt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import (
    CountVectorizer,
    CountVectorizerModel,
    IndexToString,
    StopWordsRemover,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from guestlens.functions import labels

# Settings of the published models, and the class order, which
# makes ``positive`` index 0 whatever the class sizes are.
SETTINGS = {
    "nb": {"modelType": "multinomial"},
    "rf": {"numTrees": 100, "maxDepth": 30},
    "svc": {"maxIter": 20, "regParam": 0.01},
}
MODEL_NAMES = {"nb": "Naive Bayes", "rf": "Random Forest Classifier", "svc": "Linear SVC"}
LABEL_ORDER = [labels.POSITIVE, labels.NEGATIVE]
VOCAB_SIZE = 1 << 18
# The forest keeps 4 bytes per training row and term, in memory or on disk, so it
# looks at the terms that tell the classes apart best.
FOREST_TERMS = 1 << 11
# Spark looks at so many rows whatever ``maxBins`` is.
SPLIT_ROWS = 10_000
TERMS = "words_without_stopwords"

ESTIMATORS = {"nb": NaiveBayes, "rf": RandomForestClassifier, "svc": LinearSVC}


def word_stages(stop_words: list[str] | None = None) -> list:
    """Words, and words without stop words."""
    remover = StopWordsRemover(inputCol="words", outputCol=TERMS)
    if stop_words is not None:
        remover.setStopWords(stop_words)
    return [Tokenizer(inputCol="review_text", outputCol="words"), remover]


def _terms(rows: DataFrame, stop_words: list[str] | None) -> DataFrame:
    tokenizer, remover = word_stages(stop_words)
    return remover.transform(tokenizer.transform(rows)).withColumn("term", F.explode(TERMS))


def frequent_terms(train: DataFrame, size: int = VOCAB_SIZE, stop_words: list[str] | None = None) -> DataFrame:
    """The ``size`` most frequent terms, ties by term.

    A plain top-k of this size would send that many rows of every partition to
    one place. So the count at which the vocabulary is full is looked up first,
    on one row per distinct count, and only terms from there up are sorted.
    """
    counts = _terms(train, stop_words).groupBy("term").agg(F.count("*").alias("n"))
    order = F.desc("n"), F.asc("term")
    reached = F.sum("terms").over(W.orderBy(F.desc("n")))
    steps = counts.groupBy("n").agg(F.count("*").alias("terms")).withColumn("reached", reached)
    full_at = steps.where(F.col("reached") >= size).select(F.coalesce(F.max("n"), F.lit(0))).scalar()
    return counts.where(F.col("n") >= full_at).orderBy(*order).limit(size)


def telling_terms(train: DataFrame, size: int = FOREST_TERMS, stop_words: list[str] | None = None) -> DataFrame:
    """The ``size`` terms whose presence depends most on the class, by the chi-square statistic; ties by term.

    One map-side-combined count of rows per term and class and a top-k of bounded size.
    """
    tokenizer, remover = word_stages(stop_words)
    rows = remover.transform(tokenizer.transform(train.where(F.col("review").isin(LABEL_ORDER))))
    is_positive = F.col("review") == labels.POSITIVE
    sizes = rows.select(F.count_if(is_positive).alias("p"), F.count("*").alias("n"))
    p, n = (sizes.select(F.col(c).cast("double")).scalar() for c in ("p", "n"))
    terms = rows.select(is_positive.alias("_p"), F.explode(F.array_distinct(TERMS)).alias("term"))
    counts = terms.groupBy("term").agg(F.count_if("_p").alias("a"), F.count("*").alias("t"))
    off = F.col("a") * n - F.col("t") * p
    whole = F.nullif(F.col("t") * (n - F.col("t")) * p * (n - p), F.lit(0.0))
    scored = counts.select("term", F.coalesce(n * off * off / whole, F.lit(0.0)).alias("score"))
    return scored.orderBy(F.desc("score"), F.asc("term")).limit(size)


def fit_vocabulary(
    train: DataFrame, size: int = VOCAB_SIZE, stop_words: list[str] | None = None
) -> CountVectorizerModel:
    """Count vectors over the frequent terms; only those reach the driver."""
    return _vectorizer(frequent_terms(train, size, stop_words), size)


def _vectorizer(terms: DataFrame, size: int) -> CountVectorizerModel:
    return CountVectorizer(inputCol=TERMS, outputCol="features", vocabSize=size).fit(terms.select(F.array("term").alias(TERMS)))


def fit(
    train: DataFrame,
    kind: str = "nb",
    vocab_size: int = VOCAB_SIZE,
    stop_words: list[str] | None = None,
    seed: int = 13,
    **settings,
) -> PipelineModel:
    """A pipeline from ``review_text`` and ``review`` to a predicted label.

    Expects complete rows; ``train`` is read several times, so materialize it.
    All rows are learned from. The forest, which bins every feature of every row
    into a dense array, has its ``FOREST_TERMS`` most telling terms.
    """
    estimator = ESTIMATORS[kind](
        featuresCol="features", labelCol="reviewIndexed", predictionCol="prediction", **SETTINGS[kind] | settings
    )
    if kind == "rf":
        width = min(vocab_size, FOREST_TERMS)
        vectorizer = _vectorizer(telling_terms(train, width, stop_words), width)
        # deep trees: keep each row's place in the tree instead of walking it again
        estimator.setSeed(seed).setCacheNodeIds(True)
        # Spark looks for a term's thresholds in a sample of 10,000 rows, or as many as the square of maxBins: all of them
        if (n := train.count()) > SPLIT_ROWS:
            estimator.setMaxBins(max(estimator.getMaxBins(), isqrt(n) + 1))
    else:
        vectorizer = fit_vocabulary(train, vocab_size, stop_words)
    stages = [
        *word_stages(stop_words),
        vectorizer,
        StringIndexerModel.from_labels(LABEL_ORDER, inputCol="review", outputCol="reviewIndexed"),
        estimator,
        IndexToString(inputCol="prediction", outputCol="predicted_review_label", labels=LABEL_ORDER),
    ]
    return Pipeline(stages=stages).fit(train)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Label ``review_text``; all other columns ride along.

    The given label is only looked up, so rows without one, or with one never
    seen in training, are scored too.
    """
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            continue
        rows = stage.transform(rows)
    rows = rows.drop("words", TERMS, "features")
    if "review" in rows.columns:
        index = {label: float(i) for i, label in enumerate(LABEL_ORDER)}
        rows = rows.withColumn("reviewIndexed", labels.lookup(F.col("review"), index))
    return rows


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def class_term_counts(train: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Occurrences of every term per class: what naive Bayes learns from."""
    return _terms(train, stop_words).groupBy("term", "review").agg(F.count("*").alias("n"))


def term_weights(counts: DataFrame) -> DataFrame:
    """Log probability of every term per class: naive Bayes from ``class_term_counts``.

    One row per term; totals and vocabulary size are scalar subqueries.
    """
    by_term = counts.groupBy("term").agg(
        *[F.sum(F.when(F.col("review") == label, F.col("n")).otherwise(0)).alias(label) for label in LABEL_ORDER]
    )
    size = by_term.select(F.count("*")).scalar()
    return by_term.select(
        "term",
        *[(F.log(F.col(c) + 1) - F.log(by_term.select(F.sum(c)).scalar() + size)).alias(c) for c in LABEL_ORDER],
    )


def linear_terms(model: PipelineModel) -> DataFrame:
    """(term, weight): a fitted linear SVC as a table; the row without a term has the intercept.

    The vocabulary has ``vocab_size`` terms at most, so the table has a bounded size.
    """
    vectorizer = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    svc = next(s for s in model.stages if isinstance(s, LinearSVCModel))
    spark = SparkSession.active()
    weights = [(t, float(w)) for t, w in zip(vectorizer.vocabulary, svc.coefficients.toArray()) if w]
    return spark.createDataFrame([(None, float(svc.intercept)), *weights], "term string, weight double")


def score_linear(rows: DataFrame, weights: DataFrame, key: str = "comment_id", stop_words: list[str] | None = None) -> DataFrame:
    """Score ``review_text`` by a table of weights: a join by term and a sum per review.

    No model object travels: the weights may be of any size, are stored and
    joined like any table, and only the reviews' terms, counted before the
    shuffle, meet them. ``margin`` is above 0 for the second class of
    ``LABEL_ORDER``, as the estimator has it. ``key`` is unique; all columns
    ride along.
    """
    intercept = weights.where("term IS NULL").select(F.coalesce(F.sum("weight"), F.lit(0.0))).scalar()
    counts = _terms(rows.select(key, "review_text"), stop_words).groupBy(key, "term").agg(F.count("*").alias("n"))
    sums = counts.join(weights.where("term IS NOT NULL"), "term").groupBy(key).agg(F.sum(F.col("n") * F.col("weight")).alias("_sum"))
    margin = F.coalesce("_sum", F.lit(0.0)) + intercept
    label = F.when(F.col("margin") > 0, LABEL_ORDER[1]).otherwise(LABEL_ORDER[0])
    return rows.join(sums, key, "left").withColumn("margin", margin).drop("_sum").withColumn("predicted_review_label", label)
