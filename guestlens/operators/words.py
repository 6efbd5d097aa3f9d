"""Word-cloud terms: the words that matter in the texts of a group.

Texts are cut into words and counted before anything is shuffled; later steps
work on one row per distinct word or pair of neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from guestlens.functions.language import bind
from guestlens.functions.vocabulary import CLOUD_STOP_WORDS
from guestlens.operators import filters
from guestlens.operators.joins import join_totals

# Fixed values of the word cloud: what a word is, how many are kept, and the
# likelihood ratio from which two neighbours count as one term.
WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
MAX_WORDS = 1000
COLLOCATION_SCORE = 30.0


def _raw_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _without_possessive(word: Column) -> Column:
    return F.when(word.endswith("'s"), F.left(word, F.length(word) - 2)).otherwise(word)


def _is_word(word: Column) -> Column:
    """Not a number; the first letter mostly settles it without the pattern."""
    return F.left(word, F.lit(1)).between("a", "z") | ~word.rlike(r"^\p{N}+$")


def _is_plural(word: Column) -> Column:
    return word.endswith("s") & ~word.endswith("ss")


def _stem(word: Column) -> Column:
    return F.when(_is_plural(word), F.left(word, F.length(word) - 1)).otherwise(word)


def _form(stem: Column, has_singular: Column) -> Column:
    """The word a stem counts under: its singular wherever that occurs."""
    return F.when(has_singular, stem).otherwise(F.concat(stem, F.lit("s")))


def words(df: DataFrame, text: str, by: list[str] | None = None, stop_words=CLOUD_STOP_WORDS) -> DataFrame:
    """One row per word: lower case, no possessive ending, number or stop word."""
    by = by or []
    word = F.col("word")
    raw = df.select(*by, F.explode(_raw_words(F.col(text))).alias("word"))
    found = raw.select(*by, _without_possessive(word).alias("word"))
    return found.where(~word.isin(list(stop_words)) & _is_word(word))


def neighbours(df: DataFrame, text: str, by: list[str] | None = None, stop_words=CLOUD_STOP_WORDS) -> DataFrame:
    """One row per two words next to each other in a text, numbers aside,
    neither of them a stop word."""
    by = by or []
    listed = F.filter(F.transform(_raw_words(F.col(text)), _without_possessive), _is_word)

    def zipped(w: Column) -> Column:
        count = F.greatest(F.size(w) - 1, F.lit(0))
        return F.arrays_zip(F.slice(w, F.lit(1), count).alias("word1"), F.slice(w, F.lit(2), count).alias("word2"))

    pairs = df.select(*by, F.explode(bind(listed, zipped)).alias("_p"))
    pairs = pairs.select(*by, "_p.word1", "_p.word2")
    return pairs.where(~F.col("word1").isin(list(stop_words)) & ~F.col("word2").isin(list(stop_words)))


def word_counts(df: DataFrame, text: str, by: list[str] | None = None, stop_words=CLOUD_STOP_WORDS) -> DataFrame:
    """How often each word occurs per group, stop words left out."""
    by = by or []
    return words(df, text, by, stop_words).groupBy(*by, "word").agg(F.count("*").alias("n"))


def _stem_counts(df: DataFrame, text: str, by: list[str], stop_words) -> DataFrame:
    """Count per stem, which covers at most a word and that word with an ``s``,
    and which of the two occur."""
    word = F.col("word")
    stems = words(df, text, by, stop_words).groupBy(*by, _stem(word).alias("stem")).agg(
        F.count("*").alias("n"),
        F.bool_or(~_is_plural(word)).alias("has_singular"),
        F.bool_or(_is_plural(word)).alias("has_plural"),
    )
    # Always true. It keeps every use of the stems on the same shuffle, so that
    # the texts are cut into words once.
    return stems.where(F.col("has_singular") | F.col("has_plural"))


def folded_counts(df: DataFrame, text: str, by: list[str] | None = None, stop_words=CLOUD_STOP_WORDS) -> DataFrame:
    """Word counts with a plural's count added to its singular where both occur."""
    by = by or []
    stems = _stem_counts(df, text, by, stop_words)
    return stems.select(*by, _form(F.col("stem"), F.col("has_singular")).alias("word"), "n")


def _forms(stems: DataFrame, by: list[str], suffix: str) -> DataFrame:
    """Every word with the form it counts under and that form's count."""
    present = F.array_compact(F.array(
        F.when(F.col("has_singular"), F.col("stem")), F.when(F.col("has_plural"), F.concat("stem", F.lit("s")))
    ))
    form = _form(F.col("stem"), F.col("has_singular"))
    return stems.select(
        *by, F.explode(present).alias(f"word{suffix}"), form.alias(f"form{suffix}"), F.col("n").alias(f"n{suffix}")
    )


def likelihood_ratio(c12: Column, c1: Column, c2: Column, n: Column) -> Column:
    """Dunning's ratio for two words being neighbours more often than by chance.

    A plain expression, without a lambda function, so Spark compiles it.
    """

    def log_l(k: Column, m: Column, x: Column) -> Column:
        tiny = F.lit(1e-10)
        return F.ln(F.greatest(x, tiny)) * k + F.ln(F.greatest(1 - x, tiny)) * (m - k)

    apart = F.nullif(n - c1, F.lit(0))
    p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / apart
    chance = log_l(c12, c1, p) + log_l(c2 - c12, apart, p)
    found = log_l(c12, c1, p1) + log_l(c2 - c12, apart, p2)
    return F.when((n <= c1) | (n <= c2), 0.0).otherwise(-2 * (chance - found))


def _scored_pairs(df: DataFrame, text: str, by: list[str], stop_words) -> DataFrame:
    """Distinct pairs with count and score, and the forms their words count under."""
    stems = _stem_counts(df, text, by, stop_words)
    second = F.col("word2")
    pairs = (
        neighbours(df, text, by, stop_words)
        .groupBy(*by, "word1", _stem(second).alias("stem2"))
        .agg(F.count("*").alias("n"), F.bool_or(~_is_plural(second)).alias("has_singular"))
        .select(*by, "word1", _form(F.col("stem2"), F.col("has_singular")).alias("word2"), "n")
    )
    for i in "12":
        pairs = join_totals(pairs, _forms(stems, by, i), [*by, f"word{i}"], [f"form{i}", f"n{i}"], f"n{i}")
    if by:
        pairs = join_totals(pairs, stems.groupBy(*by).agg(F.sum("n").alias("_all")), by, ["_all"], "_all")
    else:
        pairs = pairs.withColumn("_all", stems.select(F.sum("n")).scalar())
    score = likelihood_ratio(F.col("n"), F.col("n1"), F.col("n2"), F.col("_all"))
    return pairs.select(*by, F.concat_ws(" ", "word1", "word2").alias("word"), "n", "form1", "form2", score.alias("score"))


def collocations(
    df: DataFrame,
    text: str,
    by: list[str] | None = None,
    stop_words=CLOUD_STOP_WORDS,
    min_score: float = COLLOCATION_SCORE,
) -> DataFrame:
    """Neighbouring words that belong together, with count and score."""
    by = by or []
    pairs = _scored_pairs(filters.with_values(df, by), text, by, stop_words)
    return pairs.where(F.col("score") > min_score).drop("form1", "form2")


def top_words(counts: DataFrame, by: list[str] | None = None, k: int = MAX_WORDS) -> DataFrame:
    """The most frequent words, ties by word; per group if ``by`` is given.

    The rank filter lets Spark cut each group to ``k`` rows before the shuffle.
    """
    order = F.desc("n"), F.asc("word")
    if not by:
        return counts.orderBy(*order).limit(k)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return counts.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def cloud_terms(
    df: DataFrame,
    text: str = "title",
    by: list[str] | None = None,
    stop_words=CLOUD_STOP_WORDS,
    k: int = MAX_WORDS,
    min_score: float = COLLOCATION_SCORE,
) -> DataFrame:
    """What the cloud draws: words and two-word terms with their counts.

    Plurals count under their singular, and the occurrences inside a two-word
    term no longer count for its words: every term adds itself and takes its
    count off both.
    """
    by = by or []
    df = filters.with_values(df, by)
    n = F.col("n")
    changes = F.array(*[
        F.struct(F.col(word).alias("word"), change.alias("n")) for word, change in
        [("word", n), ("form1", -n), ("form2", -n)]
    ])
    terms = _scored_pairs(df, text, by, stop_words).where(F.col("score") > min_score).select(*by, F.inline(changes))
    counts = folded_counts(df, text, by, stop_words).unionByName(terms).groupBy(*by, "word").agg(F.sum("n").alias("n"))
    return top_words(counts.where(n > 0), by, k)
