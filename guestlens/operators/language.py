"""Language column and filter; rows are scored where they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions.language import detect_language
from guestlens.operators.joins import join_totals

# Letters of a gram; a word begins and ends with a space.
GRAM = 3
NOT_LETTERS = r"[^\p{L}]+"


def with_language(
    df: DataFrame,
    text: str = "title",
    output: str = "language",
    profiles: dict[str, list[str]] | None = None,
    min_confidence: float = 0.5,
) -> DataFrame:
    """Add the language of a text column; nothing is exploded, joined or shuffled."""
    return df.withColumn(output, detect_language(F.col(text), profiles, min_confidence))


def keep_language(
    df: DataFrame, language: str = "en", keep_unknown: bool = False, column: str = "language"
) -> DataFrame:
    """Rows in one language. Unsure rows go, unless ``keep_unknown``."""
    found = F.col(column)
    if keep_unknown:
        found = F.coalesce(found, F.lit(language))
    return df.where(found == language)


def _word_counts(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    words = F.split(F.lower(F.col(text)), NOT_LETTERS)
    found = df.select(*by, F.explode(words).alias("word")).where(F.col("word") != "")
    return found.groupBy(*by, "word").agg(F.count("*").alias("n"))


def _grams(word: Column) -> Column:
    """The letter n-grams of a word with a space at each end."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - GRAM + 1, F.lit(1))), lambda i: F.substr(padded, i, F.lit(GRAM)))


def gram_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(gram, lang, weight): what labelled texts say about the languages of letter n-grams.

    Words are counted before they are cut, so the shuffles see distinct words and
    grams. ``weight`` is the log probability of a gram in a language, with one
    added to every count; the row without a gram has that of all unseen ones. It
    takes any number of languages and no library: the labels are the parameter.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), text)
    counts = _word_counts(rows, text, ["lang"]).select("lang", F.explode(_grams(F.col("word"))).alias("gram"), "n")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    size = counts.select(F.count_distinct("gram")).scalar()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    seen = join_totals(counts, totals, ["lang"], ["total"], "total")
    seen = seen.select("gram", "lang", (F.log(F.col("n") + 1) - F.log(F.col("total") + size)).alias("weight"))
    unseen = totals.select(F.lit(None).cast("string").alias("gram"), "lang", (-F.log(F.col("total") + size)).alias("weight"))
    return seen.unionByName(unseen)


def with_gram_language(
    df: DataFrame, profiles: DataFrame, key: str, text: str = "title", output: str = "language", min_confidence: float = 0.5
) -> DataFrame:
    """Add the language of short texts by their letter n-grams, NULL below ``min_confidence``.

    ``key`` is unique. The confidence is the probability of the likeliest
    language given the grams. Profiles are a landed table with one column per
    language after the pivot, whose names are the only thing that is collected. Texts
    and profiles meet by gram: each gram of each text is joined with one row per gram.
    """
    langs = sorted(r[0] for r in profiles.where("gram IS NULL").select("lang").collect())
    if not langs:
        return df.withColumn(output, F.lit(None).cast("string"))
    names = [f"w{i}" for i in range(len(langs))]
    wide = profiles.where("gram IS NOT NULL").groupBy("gram").pivot("lang", langs).agg(F.first("weight")).toDF("gram", *names)
    unseen = profiles.where("gram IS NULL").groupBy().pivot("lang", langs).agg(F.first("weight")).toDF(*[f"u{i}" for i in range(len(langs))])
    unseen = unseen.select(F.array(*unseen.columns)).scalar()
    # Sums are over occurrences, so nothing is counted per text before: such counts of a task would outgrow its memory.
    words = F.filter(F.split(F.lower(F.col(text)), NOT_LETTERS), lambda w: w != "")
    grams = df.select(key, F.explode(F.flatten(F.transform(words, _grams))).alias("gram")).join(wide, "gram", "left")
    sums = grams.groupBy(key).agg(*[F.sum(F.coalesce(c, F.get(unseen, F.lit(i)))).alias(c) for i, c in enumerate(names)])
    scores = F.array(*[F.struct(F.col(c).alias("score"), F.lit(lang).alias("lang")) for c, lang in zip(names, langs)])
    best = sums.select(key, scores.alias("_s"), F.array_max(scores).alias("_best"))
    odds = F.aggregate("_s", F.lit(0.0), lambda acc, s: acc + F.exp(s["score"] - F.col("_best.score")))
    found = best.select(key, F.when(1 / odds > min_confidence, F.col("_best.lang")).alias(output))
    return df.join(found, key, "left")
