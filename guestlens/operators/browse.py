"""Listing the hotels of a city and describing one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from guestlens.functions.text import address_line, class_or_default
from guestlens.operators import filters
from guestlens.session import materialize

# Fixed value: hotels per page.
PAGE_SIZE = 20


def hotel_names(reviews: DataFrame, city: str) -> DataFrame:
    return filters.in_city(reviews, city).where(F.col("name").isNotNull()).select("name").distinct()


def hotel_page(reviews: DataFrame, city: str, page: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """One page of a city's hotels by name, numbered from 1 over all pages."""
    rows = hotel_names(reviews, city).orderBy("name").offset(page * size).limit(size)
    number = F.row_number().over(W.orderBy("name")) + page * size
    return rows.select(number.cast("bigint").alias("number"), "name")


def hotel_at(reviews: DataFrame, city: str, number: int) -> DataFrame:
    """The hotel with a number from :func:`hotel_page`; no row if out of range."""
    if number < 1:
        return hotel_names(reviews, city).limit(0)
    return hotel_names(reviews, city).orderBy("name").offset(number - 1).limit(1)


def numbered(names: DataFrame, key: str = "name") -> DataFrame:
    """(number, key): every row's place by ``key``, from 1, without one task that sees all rows.

    The rows are range-partitioned and sorted, which is written once with the
    range and the place in it. The numbers of rows in the ranges, one per
    range, add up to where each range begins.
    """
    ranges = names.select(key).repartitionByRange(key).sortWithinPartitions(key)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialize(ranges.select(key, F.spark_partition_id().alias("_range"), place.alias("_place")), "ranges")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_range")) - F.col("_n")
    starts = sizes.select("_range", before.alias("_before"))
    numbers = placed.join(F.broadcast(starts), "_range")
    return numbers.select((F.col("_before") + F.col("_place") + 1).alias("number"), key)


def page_of(index: DataFrame, page: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """A page of a ``numbered`` index. Of a written one only the files and row groups of its numbers are read."""
    return index.where(F.col("number").between(page * size + 1, (page + 1) * size))


def hotel_cards(reviews: DataFrame, first_by: str = "comment_id") -> DataFrame:
    """Details of every hotel, taken from its first review by ``first_by``."""
    columns = ["hotel_class", "street_address", "locality", "region", "url"]
    # Reviews are hashed to the few different details first; only those are compared.
    hotels = (
        reviews.where(F.col("name").isNotNull())
        .groupBy("name", *columns)
        .agg(F.min(first_by).alias("_first"), F.count("*").alias("_n"))
        .groupBy("name")
        .agg(F.min(F.struct(F.col("_first"), F.struct(*columns).alias("_d"))).alias("_m"),
             F.sum("_n").alias("review_count"))
        .select("name", "review_count", "_m._d.*")
    )
    return hotels.select(
        "name",
        class_or_default(F.col("hotel_class")).alias("hotel_class"),
        address_line(F.col("street_address"), F.col("locality"), F.col("region")).alias("address"),
        "url",
        "review_count",
    )


def hotel_card(reviews: DataFrame, name: str, city: str | None = None, first_by: str = "comment_id") -> DataFrame:
    return hotel_cards(filters.of_hotel(reviews, name, city), first_by)
