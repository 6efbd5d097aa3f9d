"""Look at single hotels: lists, cards and the words of their reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.functions.text import file_slug
from guestlens.operators import browse, reports, words


def hotel_list(reviews: DataFrame, city: str, page: int = 0) -> DataFrame:
    return browse.hotel_page(reviews, city, page)


def hotel_report(reviews: DataFrame, name: str, city: str | None = None) -> DataFrame:
    """The printed card of one hotel, line by line."""
    return reports.card_report(browse.hotel_card(reviews, name, city)).drop("name")


def hotel_clouds(reviews: DataFrame, hotels: DataFrame, text: str = "title", k: int = words.MAX_WORDS) -> DataFrame:
    """Word-cloud terms of each listed hotel, by cloud file name.

    ``hotels`` is a top-k or a single choice; reviews of a name count whatever
    city they are from.
    """
    chosen = reviews.join(hotels.select("name"), "name", "left_semi")
    terms = words.cloud_terms(chosen, text, ["name"], k=k)
    slug = F.concat(F.lit("wordcloud-"), file_slug(F.col("name")))
    return terms.select("name", slug.alias("file"), "word", "n")
