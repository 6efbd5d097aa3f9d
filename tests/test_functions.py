"""Scalar functions on the cases where engines and languages differ."""

import pytest
from pyspark.sql import functions as F

from guestlens.functions import labels, language, text, vocabulary
from guestlens.catalog.stop_words import ENGLISH_STOP_WORDS


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


DIRTY = [
    "Great\nstay at 5-star château! It's",
    "a  b",
    "tabs\tand nbsp　wide",
    "one\r\ntwo\x0bthree\x0cfour\x1cfive\x85six seven eight",
    "unit\x1fseparator",
    "",
    "ÀÉÎ ß İ 12",
]


@pytest.mark.parametrize("value", DIRTY)
def test_clean_text_is_what_python_does(spark, value):
    import re

    expected = re.sub(r"[^a-zA-Z\s]+", "", "".join(value.splitlines())).lower()
    assert one(spark, text.clean_text, value) == expected


def test_clean_text_samples(spark):
    assert one(spark, text.clean_text, DIRTY[0]) == "greatstay at star chteau its"
    assert one(spark, lambda c: text.clean_text(c, " "), "Great\r\nstay") == "great stay"
    assert one(spark, text.clean_text, None) is None


def test_letters_and_digits(spark):
    assert one(spark, text.letters_and_digits_only, "Room 12-b!") == "Room 12b"


@pytest.mark.parametrize(
    "value, label",
    [(5.0, "positive"), (3.0, "positive"), (2.9, "negative"), (None, "negative"), (float("nan"), "negative")],
)
def test_label_edges(spark, value, label):
    assert one(spark, labels.label_from_rating, value, "double") == label


@pytest.mark.parametrize("title, body, found", [(None, "x", None), ("x", None, None), ("x", "y", "x y")])
def test_review_text_needs_both(spark, title, body, found):
    df = spark.createDataFrame([(title, body)], "a string, b string")
    assert df.select(text.review_text(F.col("a"), F.col("b")).alias("r")).first()["r"] == found


@pytest.mark.parametrize("value", ["ab", "abc", "", "a name that is longer than the box"])
@pytest.mark.parametrize("width", [6, 7])
def test_padding_is_what_python_does(spark, value, width):
    assert one(spark, lambda c: text.centre(c, width), value) == value.center(width)
    assert one(spark, lambda c: text.pad_right(c, width), value) == f"{value:<{width}}"


@pytest.mark.parametrize("value, shown", [(4.0, "4.0"), (0.0, "Not Given"), (None, "Not Given"), (float("nan"), "Not Given")])
def test_hotel_class(spark, value, shown):
    assert one(spark, text.class_or_default, value, "double") == shown


def test_slug_and_title(spark):
    assert one(spark, text.file_slug, "  Hôtel & Spa - (Nice) ") == "Hôtel_Spa_Nice"
    assert one(spark, text.title_case, "service") == "Service"
    assert one(spark, text.first_word, "July 2012") == "July"


def test_choices(spark):
    assert one(spark, labels.city_name, " 6 ") == "Philadelphia"
    assert one(spark, labels.city_name, "11") is None
    assert one(spark, labels.category_name, "2") == "cleanliness"
    assert one(spark, lambda c: labels.is_choice(c, labels.CATEGORY_CHOICES), "6") is False
    assert one(spark, labels.city_name, "q") is None
    assert one(spark, lambda c: labels.is_choice(c, labels.CITIES), "q") is False
    assert one(spark, text.is_digits, "1a") is False
    assert one(spark, text.tidy_choice, "  Q ") == "q"


@pytest.mark.parametrize(
    "value, lang",
    [
        ("the room was very clean and the staff are great", "en"),
        ("la chambre est très propre et nous avons aimé le petit déjeuner", "fr"),
        ("das Zimmer war sehr sauber und wir sind zufrieden", "de"),
        ("la habitación era muy buena pero el hotel es caro", "es"),
        ("xyzzy 123", None),
        ("", None),
        (None, None),
    ],
)
def test_language(spark, value, lang):
    assert one(spark, language.detect_language, value) == lang


def test_language_profiles_are_a_parameter(spark):
    profiles = vocabulary.spark_profiles("en", "it")
    found = one(spark, lambda c: language.detect_language(c, profiles), "il servizio non era buono ma la camera sì")
    assert found == "it"


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert StopWordsRemover.loadDefaultStopWords("english") == ENGLISH_STOP_WORDS
