"""Word lists: language profiles and stop words."""

from __future__ import annotations

import os
import zipfile
from functools import cache
from pathlib import Path

import pyspark

# The word cloud's default stop words.
CLOUD_STOP_WORDS = (
    "a about above after again against all also am an and any are aren't as at be because been "
    "before being below between both but by can can't cannot com could couldn't did didn't do "
    "does doesn't doing don't down during each else ever few for from further get had hadn't has "
    "hasn't have haven't having he he'd he'll he's hence her here here's hers herself him himself "
    "his how how's however http i i'd i'll i'm i've if in into is isn't it it's its itself just k "
    "let's like me more most mustn't my myself no nor not of off on once only or other otherwise "
    "ought our ours ourselves out over own r same shall shan't she she'd she'll she's should "
    "shouldn't since so some such than that that's the their theirs them themselves then there "
    "there's therefore these they they'd they'll they're they've this those through to too under "
    "until up very was wasn't we we'd we'll we're we've were weren't what what's when when's "
    "where where's which while who who's whom why why's with won't would wouldn't www you you'd "
    "you'll you're you've your yours yourself yourselves"
).split()

# Languages whose stop words ship with Spark, by ISO code.
SPARK_LANGUAGES = {
    "da": "danish", "nl": "dutch", "en": "english", "fi": "finnish", "fr": "french",
    "de": "german", "hu": "hungarian", "it": "italian", "no": "norwegian", "pt": "portuguese",
    "ru": "russian", "es": "spanish", "sv": "swedish", "tr": "turkish",
}


@cache
def _shipped(language: str) -> tuple[str, ...]:
    """Spark's own list of a language, from the library file that has it; no session is needed."""
    home = Path(os.environ.get("SPARK_HOME") or Path(pyspark.__file__).parent)
    (library,) = (home / "jars").glob("spark-mllib_*.jar")
    with zipfile.ZipFile(library) as files:
        lines = files.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt").decode().splitlines()
    return tuple(dict.fromkeys(line.strip() for line in lines if line.strip()))


def spark_profiles(*codes: str) -> dict[str, list[str]]:
    """Profiles of languages from Spark's stop words: frequent function words. All languages by default."""
    return {code: list(_shipped(SPARK_LANGUAGES[code])) for code in codes or SPARK_LANGUAGES}


def default_profiles() -> dict[str, list[str]]:
    """The words of all languages that can occur: tokens have letters only."""
    return {code: [w for w in words if w.isalpha()] for code, words in spark_profiles().items()}
