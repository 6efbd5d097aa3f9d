"""The given tables read as reviews and hotels.

Hotels are customers and reviews are order lines (ratings), orders (unique
ids) or documents (texts, labelled by ``labels``). All views are lazy plans
over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.functions import labels, text
from guestlens.plans.etl import flat_offerings, nan_to_null
from guestlens.schemas import ADDRESS, AUTHOR, RATINGS
from guestlens.sources.readers import read_table

CITY, HOTEL, TEXT_CITY = "NATION_7", "Customer#000000007", "city0"
# A hotel of that city.
CITY_HOTEL = "Customer#000000087"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _month_year(ts):
    return F.date_format(ts, "MMMM yyyy")


def hotels_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as nested offerings records."""
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    address = F.struct(
        F.col("c_mktsegment").alias("street-address"),
        F.col("n_name").alias("locality"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("string").alias("postal-code"),
    ).cast(ADDRESS)
    return (
        table(spark, sf, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 2000).cast("double")).alias("hotel_class"),
            F.col("n_nationkey").cast("bigint").alias("region_id"),
            F.concat(F.lit("/hotel/"), F.col("c_custkey").cast("string")).alias("url"),
            F.lit(None).cast("string").alias("phone"),
            F.lit(None).cast("string").alias("details"),
            address.alias("address"),
            F.lit("hotel").alias("type"),
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
        )
    )


def order_reviews_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as nested review records with unique ids; gaps are NaN."""
    overall = F.least(F.floor(F.col("o_totalprice") / 100000) + 1, F.lit(5)).cast("double")
    gap = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(overall)
    ratings = F.struct(overall.alias("overall"), *[gap.alias(c) for c in RATINGS.fieldNames()[1:]])
    author = F.struct(
        F.col("o_custkey").cast("string").alias("id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in AUTHOR.fields[1:]],
    )
    return table(spark, sf, "orders").select(
        ratings.alias("ratings"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("text"),
        author.alias("author"),
        _month_year("o_orderdate").alias("date_stayed"),
        F.col("o_custkey").alias("offering_id"),
        F.lit(0).cast("bigint").alias("num_helpful_votes"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").alias("id"),
        F.lit(False).alias("via_mobile"),
    )


def rating_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as flat, labelled reviews; the label stands in for the prediction.

    Orders meet their hotels before the large table is joined, so a city filter
    thins out orders first and order lines by a runtime filter.
    """
    hotels = flat_offerings(hotels_raw(spark, sf))
    stays = table(spark, sf, "orders").join(hotels, F.col("o_custkey") == F.col("offering_id"))
    lines = table(spark, sf, "lineitem").withColumn("overall", F.ceil(F.col("l_quantity") / 10).cast("double"))
    scores = {
        "service": F.when(F.col("l_returnflag") != "N", F.col("overall")),
        "cleanliness": F.when(F.col("l_linestatus") == "F", F.floor(F.col("l_tax") * 50) + 1)
        .otherwise(F.lit(float("nan"))),
        "location": F.least(F.col("l_linenumber"), F.lit(5)),
        "value": F.floor(F.col("l_discount") * 40) + 1,
        "rooms": 6 - F.col("overall"),
    }
    reviews = stays.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "offering_id", "name", "locality", "region", "street_address", "hotel_class", "url", "overall",
        *[c.cast("double").alias(n) for n, c in scores.items()],
        "l_orderkey", "l_linenumber", "l_shipdate",
        _month_year("l_shipdate").alias("date_stayed"),
    )
    reviews = nan_to_null(reviews).withColumn("review", labels.label_from_rating(F.col("overall")))
    return reviews.withColumn("predicted_review_label", F.col("review"))


def _source_number():
    return F.regexp_extract("source", "([0-9]+)", 1).cast("bigint")


def text_city():
    return F.concat(F.lit("city"), F.pmod(_source_number(), F.lit(5)).cast("string"))


def document_reviews_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as nested review records; the title is the first line."""
    overall = F.when(F.col("quality") == 1, 4.0).when(F.col("quality") == 0, 2.0)
    ratings = F.struct(overall.alias("overall"), *[F.lit(None).cast("double").alias(c) for c in RATINGS.fieldNames()[1:]])
    author = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in AUTHOR.fields])
    rated = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    return rated.select(
        ratings.alias("ratings"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        "text",
        author.alias("author"),
        _month_year(F.make_date(F.lit(2012), (F.col("doc_id") % 12 + 1).cast("int"), F.lit(1))).alias("date_stayed"),
        _source_number().alias("offering_id"),
        F.lit(0).cast("bigint").alias("num_helpful_votes"),
        F.lit(None).cast("string").alias("date"),
        F.col("doc_id").alias("id"),
        F.lit(False).alias("via_mobile"),
    )


def sources_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Document sources as nested offerings records."""
    address = F.struct(
        F.lit("1 Main Street").alias("street-address"), text_city().alias("locality"),
        F.concat(F.lit("region"), _source_number() % 3).alias("region"), F.lit(None).cast("string").alias("postal-code"),
    )
    return table(spark, sf, "documents").select("source").distinct().select(
        (_source_number() % 6).cast("double").alias("hotel_class"), (_source_number() % 3).alias("region_id"),
        F.concat(F.lit("/hotel/"), "source").alias("url"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("details"),
        address.alias("address"), F.lit("hotel").alias("type"),
        _source_number().alias("id"), F.col("source").alias("name"),
    )


def text_reviews(spark: SparkSession, sf: str, hotel=None) -> DataFrame:
    """Documents as clean reviews; the label is NULL where none is given.

    A hotel is a source, or what ``hotel`` says.
    """
    rated = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    overall = F.when(F.col("quality") == 1, 4.0).when(F.col("quality") == 0, 2.0)
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return rated.select(
        F.col("doc_id").alias("comment_id"),
        (F.col("source") if hotel is None else hotel).alias("name"),
        text_city().alias("locality"),
        text.clean_text(title).alias("title"),
        text.clean_text(F.col("text")).alias("text"),
        F.when(overall.isNotNull(), labels.label_from_rating(overall)).alias("review"),
        F.when(F.col("toxic") == 0, 4.0).alias("service"),
    )
