"""Every registered query: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens import schemas
from guestlens.catalog import views
from guestlens.catalog.views import CITY, CITY_HOTEL, HOTEL, TEXT_CITY, documents, table
from guestlens.functions import labels, text
from guestlens.operators import (
    browse,
    filters,
    joins,
    language,
    metrics,
    partials,
    ranking,
    reports,
    sampling,
    sentiment,
    shape,
    words,
)
from guestlens.plans import compare, etl, inspect, recommend
from guestlens.session import materialize, new_path
from guestlens.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUCKETS = 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def six(c) -> F.Column:
    return F.round(c, 6)


# Ingest, projections and joins


@query
def merge_reviews_offerings(spark, sf):
    merged = etl.merged_reviews(views.order_reviews_raw(spark, sf), views.hotels_raw(spark, sf))
    return merged.select(
        "comment_id", "offering_id", "author_id", "name", "locality", "region", "street_address",
        "hotel_class", "url", "title", "date_stayed", "overall", "service", "via_mobile",
    )


@query
def flatten_struct(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", F.from_json("props", "k int").alias("props"))
    return shape.flatten(events, "props", prefix="prop_")


@query
def cast_columns(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    as_text = shape.cast_columns(orders, {"o_orderkey": "string"})
    typed = shape.cast_columns(as_text, {"o_orderkey": "bigint", "o_custkey": "double"})
    return typed.withColumnsRenamed({"o_orderkey": "comment_id", "o_custkey": "offering_id"}).drop("o_totalprice")


@query
def keep_listed_ids(spark, sf):
    listed = table(spark, sf, "labels").where(F.col("quality") == 1).select(F.col("doc_id").alias("comment_id"))
    docs = table(spark, sf, "documents").withColumnRenamed("doc_id", "comment_id")
    return joins.keep_listed(docs, listed.union(listed)).select("comment_id", "lang", "source")


@query
def join_predictions(spark, sf):
    predictions = table(spark, sf, "labels").select(
        F.col("doc_id").alias("comment_id"),
        F.when(F.col("quality") == 1, labels.POSITIVE).otherwise(labels.NEGATIVE).alias("predicted_review_label"),
    )
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("comment_id"), "source")
    return joins.join_predictions(docs, predictions.union(predictions))


@query
def city_lookup(spark, sf):
    choice = F.col("n_nationkey").cast("string")
    raw = F.concat(F.lit("  "), choice, F.lit(" "))
    tidy = text.tidy_choice(raw)
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        tidy.alias("choice"),
        text.is_digits(tidy).alias("is_number"),
        labels.is_choice(tidy, labels.CITIES).alias("is_city"),
        labels.city_name(tidy).alias("city"),
        labels.category_name(tidy).alias("category"),
        text.tidy_choice(F.col("r_name")).alias("region_choice"),
    )


# Cleaning and labelling


@query
def label_review(spark, sf):
    rated = views.rating_reviews(spark, sf)
    return rated.groupBy("overall", "review").agg(F.count("*").alias("n"))


@query
def null_checks(spark, sf):
    rated = views.rating_reviews(spark, sf)
    return rated.agg(*[
        filters.any_null(F.col(c)).alias(f"{c}_has_null") for c in ["overall", *schemas.CATEGORIES]
    ])


@query
def month_stayed(spark, sf):
    month = text.first_word(F.date_format("l_shipdate", "MMMM yyyy")).alias("month_stayed")
    return table(spark, sf, "lineitem").groupBy(month).agg(F.count("*").alias("n"))


@query
def clean_text(spark, sf):
    clean = text.clean_text(F.col("text"))
    return documents(spark, sf).select(
        F.col("doc_id").alias("comment_id"),
        F.length(clean).cast("bigint").alias("clean_chars"),
        F.md5(clean).alias("clean_md5"),
        F.md5(text.letters_and_digits_only(F.col("text"))).alias("alnum_md5"),
        F.md5(text.clean_text(F.col("text"), " ")).alias("spaced_md5"),
    )


@query
def review_text(spark, sf):
    rows = sampling.model_rows(views.text_reviews(spark, sf)).na.drop()
    return rows.select(
        "comment_id", "review", "locality", F.length("review_text").cast("bigint").alias("chars"),
        F.md5("review_text").alias("text_md5"),
    )


@query
def language_detect(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    return language.with_language(docs, "text").select("doc_id", "lang", "language")


@query
def english_only(spark, sf):
    docs = language.with_language(documents(spark, sf), "text")
    return language.keep_language(docs).select("doc_id", "source", "lang")


@query
def english_or_unknown(spark, sf):
    docs = language.with_language(documents(spark, sf), "text")
    return language.keep_language(docs, keep_unknown=True).select("doc_id", "source", "lang")


@query
def title_language(spark, sf):
    """Languages of first lines, by letter n-grams of four fifths of the documents."""
    docs = documents(spark, sf).withColumnRenamed("doc_id", "comment_id")
    train, _ = sampling.random_split(docs)
    profiles = materialize(language.gram_profiles(train), "gram-profiles")
    titles = docs.select("comment_id", "lang", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    return language.with_gram_language(titles, profiles, "comment_id").select("comment_id", "lang", "language")


@query
def clean_reviews(spark, sf):
    reviews = etl.build_reviews(
        views.document_reviews_raw(spark, sf), views.sources_raw(spark, sf), detect_on="text"
    )
    return reviews.select(
        "comment_id", "name", "locality", "region", "hotel_class", "month_stayed", "overall", "review",
        F.md5("title").alias("title_md5"), F.md5("text").alias("text_md5"),
    )


# Splits and samples


@query
def split_by_city(spark, sf):
    rated = views.rating_reviews(spark, sf).select("name", "locality", "review")
    sides = {"training": filters.outside_city(rated, CITY), "city": filters.in_city(rated, CITY)}
    parts = [df.groupBy("review").agg(F.count("*").alias("n")).withColumn("side", F.lit(s)) for s, df in sides.items()]
    return parts[0].unionByName(parts[1])


@query
def complement_null_city(spark, sf):
    hotels = etl.flat_offerings(views.hotels_raw(spark, sf))
    gaps = hotels.withColumn("locality", F.when(F.col("hotel_class").isNotNull(), F.col("locality")))
    return filters.outside_city(gaps, CITY).select("offering_id", "locality")


@query
def sample_fraction(spark, sf):
    rows = views.text_reviews(spark, sf).select("comment_id", "review").na.drop()
    return rows.select(six(sampling.positive_fraction(rows)).alias("fraction"), "review").groupBy(
        "fraction", "review"
    ).agg(F.count("*").alias("n"))


@query
def balance_sampled(spark, sf):
    rows = views.text_reviews(spark, sf).select("comment_id", "review").na.drop()
    return sampling.balance(rows)


@query
def balance_exact(spark, sf):
    rows = views.text_reviews(spark, sf).select("comment_id", "review").na.drop()
    return sampling.balance_exact(rows)


@query
def random_split(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("comment_id"))
    train, test = sampling.random_split(docs)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# Counts, rankings and category scores


@query
def review_counts(spark, sf):
    rated = views.rating_reviews(spark, sf).select("name", "l_orderkey", "l_linenumber", "predicted_review_label")
    return ranking.with_hotel_counts(rated).drop("positive_counts")


@query
def positive_counts(spark, sf):
    return ranking.hotel_totals(views.rating_reviews(spark, sf))


@query
def top5_hotels(spark, sf):
    return ranking.top_hotels(filters.in_city(views.rating_reviews(spark, sf), CITY))


@query
def impute_category(spark, sf):
    rated = views.rating_reviews(spark, sf)
    given = rated.select("predicted_review_label", "service", F.col("service").isNull().alias("was_missing"))
    return (
        ranking.impute_category(given, "service")
        .groupBy("predicted_review_label", "was_missing")
        .agg(F.count("*").alias("n"), six(F.avg("service")).alias("avg_service"))
    )


def _top_category(category: str, mode: str) -> Query:
    def run(spark, sf):
        rated = filters.in_city(views.rating_reviews(spark, sf), CITY)
        top = ranking.top_by_category(rated, category, mode=mode)
        return top.withColumn("weighted_avg", six("weighted_avg"))

    return run


QUERIES["top10_category_max"] = _top_category("service", "max")
QUERIES["top10_category_mean"] = _top_category("service", "mean")
for _category in schemas.CATEGORIES[1:]:
    QUERIES[f"top10_{_category}"] = _top_category(_category, "max")


@query
def category_scores_all(spark, sf):
    scores = ranking.category_scores(views.rating_reviews(spark, sf), "cleanliness", "mean", key="offering_id")
    return scores.withColumn("weighted_avg", six("weighted_avg"))


def _partials(spark, sf):
    """Partials of the reviews until 1995, landed, and those of later ones appended."""
    path = new_path(spark, "partials")
    rated = views.rating_reviews(spark, sf).withColumn("month", F.trunc("l_shipdate", "month"))
    is_new = F.col("l_shipdate") >= "1996-01-01"
    writers.write_table(partials.partial_scores(rated.where(~is_new), "month"), path)
    writers.write_table(partials.partial_scores(rated.where(is_new), "month"), path, mode="append")
    return filters.in_city(readers.read_table(spark, path), CITY)


@query
def top5_from_partials(spark, sf):
    return partials.top_hotels(_partials(spark, sf))


@query
def top10_from_partials(spark, sf):
    top = partials.top_by_category(_partials(spark, sf), "service", mode="mean")
    return top.withColumn("weighted_avg", six("weighted_avg"))


# Browsing


@query
def hotel_page(spark, sf):
    return browse.hotel_page(views.rating_reviews(spark, sf), CITY, page=1)


@query
def hotel_at(spark, sf):
    return browse.hotel_at(views.rating_reviews(spark, sf), CITY, 3)


@query
def hotel_numbers(spark, sf):
    """All hotels of the city with their numbers, by ranges."""
    return browse.numbered(browse.hotel_names(views.rating_reviews(spark, sf), CITY))


@query
def hotel_page_indexed(spark, sf):
    """A page from a written index of the numbers."""
    return browse.page_of(materialize(hotel_numbers(spark, sf), "hotel-index"), 1)


@query
def hotel_card_clustered(spark, sf):
    """One hotel from a table that is sorted by name inside each city."""
    path = new_path(spark, "clustered")
    writers.write_table(views.rating_reviews(spark, sf), path, cluster_by="name")
    return browse.hotel_card(readers.read_table(spark, path), CITY_HOTEL, CITY, first_by="l_orderkey")


@query
def hotel_card(spark, sf):
    return browse.hotel_card(views.rating_reviews(spark, sf), HOTEL, first_by="l_orderkey")


@query
def hotel_cards(spark, sf):
    return browse.hotel_cards(views.rating_reviews(spark, sf), first_by="l_orderkey")


# Words


@query
def word_freq(spark, sf):
    counts = words.word_counts(documents(spark, sf), "text")
    return words.top_words(counts)


@query
def word_freq_by_source(spark, sf):
    counts = words.word_counts(documents(spark, sf), "text", ["source"])
    slug = text.file_slug(F.concat(F.lit("(wordcloud) "), "source")).alias("file")
    return words.top_words(counts, ["source"]).select(slug, "word", "n")


@query
def word_plurals(spark, sf):
    return words.folded_counts(documents(spark, sf), "text", ["lang"])


@query
def word_pairs(spark, sf):
    pairs = words.collocations(documents(spark, sf), "text")
    return pairs.withColumn("score", F.round("score", 4))


@query
def title_clouds(spark, sf):
    """Word-cloud terms of the titles, per hotel."""
    titles = views.text_reviews(spark, sf).select(F.col("name").alias("source"), "title")
    return words.cloud_terms(titles, "title", ["source"])


@query
def cloud_terms(spark, sf):
    return words.cloud_terms(documents(spark, sf), "text", ["lang"])


@query
def hotel_clouds(spark, sf):
    rated = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("source").alias("name"),
        F.when(F.col("quality") == 1, labels.POSITIVE).alias("predicted_review_label"),
    )
    reviews = documents(spark, sf).select(F.col("source").alias("name"), "text")
    return inspect.hotel_clouds(reviews, ranking.top_hotels(rated), "text")


# Reports


@query
def report_lines(spark, sf):
    return reports.top_report(top5_hotels(spark, sf))


@query
def category_report_lines(spark, sf):
    rated = filters.in_city(views.rating_reviews(spark, sf), CITY)
    return reports.category_report(ranking.top_by_category(rated, "service"), "service")


@query
def card_lines(spark, sf):
    return reports.card_report(hotel_cards(spark, sf))


@query
def report_file(spark, sf):
    path = new_path(spark, "report")
    writers.write_report(report_lines(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# File round trips


@query
def csv_round_trip(spark, sf):
    path = new_path(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    writers.write_csv(docs, path)
    back = readers.read_csv(spark, path, docs.schema)
    return back.select("doc_id", "source", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


@query
def csv_line_round_trip(spark, sf):
    """The same with a line per record, so that several tasks read a file."""
    path = new_path(spark, "csv-lines")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    writers.write_csv(docs, path, one_line=True, compression="none")
    back = readers.read_csv(spark, path, docs.schema, one_line=True)
    return back.select("doc_id", "source", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


@query
def bucketed_join(spark, sf):
    """Reviews and hotels landed in buckets by hotel: joined without a shuffle."""
    sides = {"reviews": etl.flat_reviews(views.order_reviews_raw(spark, sf)), "hotels": etl.flat_offerings(views.hotels_raw(spark, sf))}
    landed = {}
    for label, df in sides.items():
        path = new_path(spark, label)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        writers.write_bucketed(df, name, path, "offering_id", BUCKETS)
        landed[label] = spark.table(name)
    merged = etl.nan_to_null(joins.merge_reviews_offerings(landed["reviews"], landed["hotels"]))
    return merged.select("comment_id", "offering_id", "name", "locality", "title", "overall", "service")


@query
def json_round_trip(spark, sf):
    path = new_path(spark, "json")
    writers.write_json(views.order_reviews_raw(spark, sf), path)
    flat = etl.nan_to_null(etl.flat_reviews(readers.read_reviews(spark, path)))
    return flat.select("comment_id", "offering_id", "author_id", "title", "date_stayed", "overall", "service")


@query
def city_table(spark, sf):
    path = new_path(spark, "hotels")
    hotels = etl.flat_offerings(views.hotels_raw(spark, sf)).select("offering_id", "name", "locality", "hotel_class")
    writers.write_table(hotels, path)
    return filters.in_city(readers.read_table(spark, path), CITY).select("offering_id", "name", "hotel_class")


# Classifiers

# Bytes of texts in a row group: models take seconds for a MB, so a city is read by many tasks.
TEXT_ROW_GROUP = 4 << 20


def _text_rows(spark, sf, hotel=None):
    """The clean review table, landed by city, for training and scoring."""
    path = new_path(spark, "reviews")
    writers.write_table(views.text_reviews(spark, sf, hotel), path, row_group_bytes=TEXT_ROW_GROUP)
    return readers.read_table(spark, path)


@query
def nb_terms(spark, sf):
    train = recommend.training_rows(_text_rows(spark, sf), TEXT_CITY)
    return sentiment.class_term_counts(train)


@query
def nb_train(spark, sf):
    weights = sentiment.term_weights(nb_terms(spark, sf))
    return weights.select("term", *[six(c).alias(c) for c in sentiment.LABEL_ORDER])


def _model_input(reviews):
    """The city's reviews with id and text, labelled or not."""
    return sampling.split_by_city(reviews, TEXT_CITY)[1].na.drop(subset=["comment_id", "review_text"])


@query
def nb_predict(spark, sf):
    reviews = _text_rows(spark, sf)
    scored = sentiment.score(recommend.train_for_city(reviews, TEXT_CITY), _model_input(reviews))
    raw = vector_to_array("rawPrediction")
    return scored.select(
        "comment_id", "review", "reviewIndexed", "prediction", "predicted_review_label",
        F.round(raw[0], 4).alias("log_positive"), F.round(raw[1], 4).alias("log_negative"),
    )


def _predict(kind: str, **options) -> Query:
    def run(spark, sf):
        reviews = _text_rows(spark, sf)
        model = recommend.train_for_city(reviews, TEXT_CITY, kind, **options)
        return sentiment.score(model, _model_input(reviews)).select(
            "comment_id", "review", "reviewIndexed", "prediction", "predicted_review_label"
        )

    return run


@query
def nb_saved(spark, sf):
    """Scored by a model that went through the shared folder."""
    reviews = _text_rows(spark, sf)
    path = new_path(spark, "model")
    sentiment.save(recommend.train_for_city(reviews, TEXT_CITY), path)
    return sentiment.score(sentiment.load(path), _model_input(reviews)).select("comment_id", "predicted_review_label")


QUERIES["rf_predict"] = _predict("rf")
QUERIES["svc_predict"] = _predict("svc")


@query
def svc_scored(spark, sf):
    """The linear model as a table of weights that went through the shared folder."""
    reviews = _text_rows(spark, sf)
    weights = materialize(sentiment.linear_terms(recommend.train_for_city(reviews, TEXT_CITY, "svc")), "svc-weights")
    scored = sentiment.score_linear(_model_input(reviews), weights)
    return scored.select("comment_id", "review", F.round("margin", 6).alias("margin"), "predicted_review_label")


@query
def top5_predicted(spark, sf):
    reviews = _text_rows(spark, sf)
    return recommend.top_hotels_of_city(reviews, TEXT_CITY, recommend.train_for_city(reviews, TEXT_CITY))


@query
def top10_predicted_service(spark, sf):
    reviews = _text_rows(spark, sf)
    model = recommend.train_for_city(reviews, TEXT_CITY)
    top = recommend.top_category_of_city(reviews, TEXT_CITY, "service", model)
    return top.withColumn("weighted_avg", six("weighted_avg"))


def _many_hotels(spark, sf):
    """As many hotels as sources and languages, so that rankings have more than they show; and a model."""
    reviews = _text_rows(spark, sf, F.concat_ws("-", "source", "lang"))
    return reviews, recommend.train_for_city(reviews, TEXT_CITY)


@query
def top5_of_many(spark, sf):
    reviews, model = _many_hotels(spark, sf)
    return recommend.top_hotels_of_city(reviews, TEXT_CITY, model)


@query
def top10_of_many(spark, sf):
    reviews, model = _many_hotels(spark, sf)
    top = recommend.top_category_of_city(reviews, TEXT_CITY, "service", model, mode="mean")
    return top.withColumn("weighted_avg", six("weighted_avg"))


# Metrics


def _rule_scored(spark, sf):
    """Documents scored by a fixed rule: positive unless labelled toxic."""
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang"), "doc_id").select(
        "source", "lang",
        F.when(F.col("quality") == 1, labels.POSITIVE).otherwise(labels.NEGATIVE).alias("review"),
        F.when(F.col("toxic") == 0, labels.POSITIVE).otherwise(labels.NEGATIVE).alias("predicted_review_label"),
    )


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_rule_scored(spark, sf))


@query
def class_metrics(spark, sf):
    found = metrics.class_metrics(metrics.confusion_matrix(_rule_scored(spark, sf), ["lang"]), ["lang"])
    return found.select("lang", *[six(F.col(f"`{m}`")).alias(m) for m in metrics.METRICS])


def _rule_metrics(spark, sf):
    by = ["source", "lang"]
    found = metrics.class_metrics(metrics.confusion_matrix(_rule_scored(spark, sf), by), by)
    return found.withColumnsRenamed({"source": "Model", "lang": "Prediction Data"})


@query
def accuracy_bars(spark, sf):
    bars = metrics.summarize(_rule_metrics(spark, sf), by=["Model"])
    return bars.select("Model", six("mean").alias("mean"), six("sd").alias("sd"))


@query
def accuracy_side_by_side(spark, sf):
    found = _rule_metrics(spark, sf)
    # One column per language found.
    langs = sorted(row[0] for row in found.select("Prediction Data").distinct().collect() if row[0] is not None)
    sides = metrics.side_by_side(found, langs)
    return sides.select("Model", *[six(c).alias(c) for c in langs])


@query
def model_compare(spark, sf):
    return compare.compare_models(_text_rows(spark, sf), TEXT_CITY)


@query
def nb_compare(spark, sf):
    """Naive Bayes on its training rows, the other fifth of them, and the held-out city."""
    found = compare.compare_models(_text_rows(spark, sf), TEXT_CITY, ["nb"])
    return found.select("Model", F.col("Prediction Data").alias("data"), *[six(F.col(f"`{m}`")).alias(m) for m in metrics.METRICS])


# A JSON array has about so many records.
ARRAY_ROWS = 10_000


def _arrays(rated, record):
    """(value): JSON arrays of the records, of one source each; a source has as many as its rows need."""
    parts = rated.count() // ARRAY_ROWS + 1
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("_part")
    return rated.groupBy("source", part).agg(F.to_json(F.sort_array(F.collect_list(record))).alias("value")).select("value")


@query
def model_input_array(spark, sf):
    """Labels and texts as JSON arrays, one per line, read with the fixed schema."""
    path = new_path(spark, "model-input")
    rated = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "lang"), "doc_id")
    review = F.when(F.col("quality") == 1, labels.POSITIVE).otherwise(labels.NEGATIVE)
    record = F.struct(F.col("doc_id").alias("comment_id"), review.alias("review"), F.concat_ws(" ", "source", "lang").alias("review_text"))
    _arrays(rated, record).write.text(path)
    return readers.read_model_input(spark, path)


@query
def metrics_file(spark, sf):
    """The metrics of the rule, per source and language, through their CSV file."""
    path = new_path(spark, "metrics")
    writers.write_csv(_rule_metrics(spark, sf), path)
    back = readers.read_metrics(spark, path)
    return back.select("Model", F.col("Prediction Data").alias("data"), six("Accuracy").alias("Accuracy"), six("F1Score").alias("F1Score"))
