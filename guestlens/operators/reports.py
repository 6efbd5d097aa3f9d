"""Fixed-width reports as tables of numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions.text import (
    BOX_WIDTH,
    COUNT_WIDTH,
    POSITIVE_WIDTH,
    RANK_WIDTH,
    RULE_EXTRA,
    SCORE_WIDTH,
    centre,
    pad_right,
    title_case,
    two_decimals,
)


def _line(cells: list[tuple[Column, Column | int]]) -> Column:
    return F.concat_ws(" ", *[pad_right(value, width) for value, width in cells])


# A ranked report is folded into one row.
MOST_RANKED = 10_000


def _numbered(lines: DataFrame, *keep: str) -> DataFrame:
    return lines.select(*keep, F.posexplode("_lines").alias("line_no", "line"))


def ranked_lines(top: DataFrame, score_title: Column | None = None) -> DataFrame:
    """Header, rule and one line per hotel of a ranked top-k.

    The name column is as wide as the longest name. ``top`` is folded into one
    row; a report of more than ``MOST_RANKED`` hotels is refused.
    """
    fits = F.assert_true(F.count("*") <= MOST_RANKED, F.lit("too many hotels for one report"))
    columns = ["rank", "name", "review_count", "positive_counts"] + (["weighted_avg"] if score_title is not None else [])
    folded = top.agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("_rows"),
        F.max(F.length("name")).alias("_width"),
        fits.alias("_fits"),
    ).where(F.col("_width").isNotNull() & F.col("_fits").isNull())
    width = F.col("_width")

    def cells(rank, name, score, count, positive):
        middle = [] if score is None else [(score, SCORE_WIDTH)]
        return [(rank, RANK_WIDTH), (name, width), *middle, (count, COUNT_WIDTH), (positive, POSITIVE_WIDTH)]

    def body(row: Column) -> Column:
        score = None if score_title is None else F.coalesce(two_decimals(row["weighted_avg"]), F.lit("nan"))
        return _line(cells(row["rank"].cast("string"), row["name"], score,
                           row["review_count"].cast("string"), row["positive_counts"].cast("string")))

    total = F.lit("Total Reviews" if score_title is None else "Total Count")
    header = _line(cells(F.lit("Rank"), F.lit("Hotel Name"), score_title, total, F.lit("Positive Reviews")))
    rule = F.repeat(F.lit("-"), width + RULE_EXTRA)
    return _numbered(folded.withColumn("_lines", F.concat(F.array(header, rule), F.transform("_rows", body))))


def top_report(top: DataFrame) -> DataFrame:
    return ranked_lines(top)


def category_report(top: DataFrame, category: str) -> DataFrame:
    title = F.concat(F.lit("Avg "), title_case(F.lit(category)), F.lit(" Score"))
    return ranked_lines(top, title)


def card_report(cards: DataFrame, link_title: str = "Link") -> DataFrame:
    """The boxed detail card of each hotel, keyed by name."""
    rule = F.lit("-" * BOX_WIDTH)
    title = F.concat(F.lit("- "), centre(F.col("name"), BOX_WIDTH - 4), F.lit(" -"))
    lines = F.array(
        F.lit(""),
        rule,
        title,
        rule,
        F.lit(""),
        F.concat(F.lit("Hotel Class: "), "hotel_class", F.lit(" stars")),
        F.concat(F.lit("Hotel Address: "), "address"),
        F.concat(F.lit(f"{link_title}: "), F.coalesce("url", F.lit(""))),
        F.concat(F.lit("Number of Reviews: "), F.col("review_count").cast("string")),
    )
    return _numbered(cards.withColumn("_lines", lines), "name")
