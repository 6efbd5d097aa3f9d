"""Cleaning, formatting and parsing of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.splitlines breaks on, then the
# whitespace that its regex class \s matches (Unicode, which is why Java's
# White_Space needs U+001F added).
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
NOT_LETTER_OR_SPACE = r"(?U)[^a-zA-Z\s\x1F]+"
NOT_ALNUM_OR_SPACE = r"(?U)[^0-9a-zA-Z\s\x1F]+"

# The layout widths of the printed reports.
RANK_WIDTH, COUNT_WIDTH, POSITIVE_WIDTH, SCORE_WIDTH = 5, 12, 16, 22
RULE_EXTRA, BOX_WIDTH = 50, 50


def drop_line_breaks(c: Column, joiner: str = "") -> Column:
    """Delete line breaks. The default glues the words at a break together,
    as the published results were made; ``joiner=' '`` keeps them apart."""
    if joiner:
        return F.regexp_replace(c, f"\r\n|[{LINE_BREAKS}]", joiner)
    return F.translate(c, LINE_BREAKS, "")


def letters_only(c: Column) -> Column:
    return F.regexp_replace(c, NOT_LETTER_OR_SPACE, "")


def letters_and_digits_only(c: Column) -> Column:
    return F.regexp_replace(c, NOT_ALNUM_OR_SPACE, "")


def clean_text(c: Column, joiner: str = "") -> Column:
    """Lower-case ASCII letters and whitespace; NULL stays NULL."""
    return F.lower(letters_only(drop_line_breaks(c, joiner)))


def review_text(title: Column, text: Column) -> Column:
    """NULL if either part is, so that ``na.drop`` removes the row."""
    return F.concat(title, F.lit(" "), text)


def first_word(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def title_case(c: Column) -> Column:
    return F.initcap(c)


def file_slug(c: Column) -> Column:
    """Runs of non-word characters become ``_``, none at either end."""
    return F.btrim(F.regexp_replace(c, r"[^\p{L}\p{N}_]+", "_"), F.lit("_"))


def pad_right(c: Column, width: Column | int) -> Column:
    """Left-justify; a value longer than ``width`` is kept whole."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.rpad(c, F.greatest(F.length(c), width), F.lit(" "))


def centre(c: Column, width: int) -> Column:
    """Centre as Python does: an odd spare space goes right for even widths."""
    spare = F.greatest(F.lit(width) - F.length(c), F.lit(0))
    left = F.floor(spare / 2).cast("int") + spare.bitwiseAND(F.lit(width & 1))
    return pad_right(F.concat(F.repeat(F.lit(" "), left), c), width)


def two_decimals(c: Column) -> Column:
    return F.format_string("%.2f", c)


def address_line(street: Column, locality: Column, region: Column) -> Column:
    return F.concat_ws(", ", street, locality, region)


def class_or_default(hotel_class: Column, default: str = "Not Given") -> Column:
    """Missing, NaN and zero classes all read as not given."""
    missing = hotel_class.isNull() | F.isnan(hotel_class) | (hotel_class == 0)
    return F.when(missing, F.lit(default)).otherwise(hotel_class.cast("string"))


def tidy_choice(c: Column) -> Column:
    return F.lower(F.trim(c))


def is_digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")
