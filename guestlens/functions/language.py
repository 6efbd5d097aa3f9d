"""Language detection from function words, as one expression per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from guestlens.functions.vocabulary import default_profiles


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    A lambda variable stays one when the optimizer copies the expression into
    a pushed-down filter; a column of a previous step would be copied as often
    as it is named.
    """
    return F.transform(F.array(value), body)[0]


def _hits(words: Column, profile: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(profile)))


def detect_language(
    text: Column, profiles: dict[str, list[str]] | None = None, min_confidence: float = 0.5
) -> Column:
    """The language code, or NULL if unsure.

    Words that stand in any profile are known; the confidence of a language is
    the share of them that its profile has. Related languages share words, so
    the shares may add up to more than one: the largest wins if it is above
    ``min_confidence`` and no other language has as large a one.
    """
    if not 0 <= min_confidence < 1:
        raise ValueError("min_confidence must be in [0, 1)")
    profiles = profiles or default_profiles()
    known = sorted(set().union(*profiles.values()))

    def winner(hits: Column) -> Column:
        return bind(F.array_max(hits), lambda best: F.when(F.size(F.filter(hits, lambda h: h["n"] == best["n"])) == 1, best))

    def score(words: Column) -> Column:
        hits = F.array(*[F.struct(_hits(words, ws).alias("n"), F.lit(lang).alias("lang")) for lang, ws in profiles.items()])
        found = bind(hits, winner)
        return F.when(found["n"] > min_confidence * F.size(words), found["lang"])

    words = F.split(F.lower(text), r"[^\p{L}]+")
    return bind(F.filter(words, lambda w: w.isin(known)), score)
