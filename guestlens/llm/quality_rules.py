"""Quality rules: word counts, repetition, symbols, and bands of n-gram perplexity."""

from __future__ import annotations

from collections.abc import Iterator, Sized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import hashing, kneser_ney, word_model
from guestlens.llm.common import join_small, materialize, slices

LEAST_WORDS, MOST_REPEATED = 20, 30
WINDOW = 8
# A band reaches so many spreads (quartile to quartile) beyond the quartiles, and
# perplexities of words so many above the upper one.
REACH, WORD_REACH = 6.0, 6.0
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
# The model of characters learns from prose: texts of enough words, at most so many percent of
# whose bytes are symbols, and capitals. The model of words learns from every text.
MOST_SYMBOLS, MOST_CAPITALS = 2, 15


def is_prose(text: bytes, words: Sized) -> bool:
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return len(words) >= LEAST_WORDS and 100 * symbols <= MOST_SYMBOLS * len(text) and 100 * capitals <= MOST_CAPITALS * len(text)


def _repeated(w: hashing.Words) -> np.ndarray:
    """Per text, the words in windows that are found twice or more in it."""
    text = w.text_of()
    at = np.flatnonzero(w.left() >= WINDOW)
    counts = np.zeros(len(w.first) - 1, np.int64)
    if not len(at):
        return counts
    own = hashing.windows(hashing.word_hashes(w), WINDOW)[at] ^ hashing.mix(text[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    change = np.bincount(at[twice], minlength=len(text) + WINDOW + 1)
    change -= np.bincount(at[twice] + WINDOW, minlength=len(change))
    inside = np.cumsum(change)[: len(text)] > 0
    return np.bincount(text[inside], minlength=len(counts))


def _measure(model: kneser_ney.HashArrays):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kneser_ney.Scorer(model)
        for batch in slices(batches, "text"):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            w = hashing.words(batch.column("text"))
            rows = []
            for text, own, log in zip(texts, w.counts.tolist(), scorer.texts(w).tolist()):
                chars = len(text.translate(None, _SPACE).decode())
                lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
                symbols = len(text) - len(text.translate(None, _SYMBOLS))
                score = -log / (chars + own) if own else None
                rows.append((own, chars, symbols, len(lines) - len(set(lines)), score))
            n, chars, symbols, lines, score = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "text_hash": batch.column("text_hash"),
                "doc_id": batch.column("doc_id"),
                "lang": batch.column("lang"),
                "n_words": pa.array(n, pa.int64()),
                "word_chars": pa.array(chars, pa.int64()),
                "n_symbols": pa.array(symbols, pa.int64()),
                "n_dup_lines": pa.array(lines, pa.int64()),
                "n_repeat_words": pa.array(_repeated(w)),
                "log_perplexity": pa.array(score, pa.float64()),
            })

    return run


def judge(docs: DataFrame, reach: float = REACH, word_reach: float = WORD_REACH) -> DataFrame:
    """Word counts and the verdict on every document.

    Returns text_hash, doc_id, lang, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, log_perplexity, low,
    high, word_log_perplexity, word_high, kept. One model counts the words of all texts in order (``word_model``),
    each text being judged by what others hold; one the characters in words of every text that reads as prose
    (``is_prose``), so junk does not teach it junk. Each language has its own band of log perplexities of the first and
    its own upper fence of those of the second, from the quartiles of its documents that pass the
    base rules. Kept: passes the base rules, stands in the band and is not above the fence.

    Null and empty texts have zero counts and fail the base rules. A null
    language is a language of its own. Repeated rows and ids are judged alike. An
    empty table gives an empty result. Other columns are not looked at.
    """
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("text_hash"))
    counts = kneser_ney.count_grams(rows, "rule-grams", is_prose)
    model = kneser_ney.HashArrays(kneser_ney.train(counts, "rule-model"))
    schema = (
        "text_hash long, doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, log_perplexity double"
    )
    words = word_model.perplexities(rows, F.lit(True), "rule-words")
    measured = materialize(rows.mapInArrow(_measure(model), schema), "rule-measures")
    measured = materialize(join_small(measured, words, ["text_hash"], "left", F.xxhash64("doc_id")), "rule-perplexities")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed).withColumn("_lang", F.struct("lang"))
    passed = measured.where("NOT base_failed")
    bands = kneser_ney.fences(passed, "_lang", "log_perplexity", reach)
    word_bands = kneser_ney.fences(passed, "_lang", "word_log_perplexity", word_reach)
    bands = bands.join(word_bands.select("_lang", F.col("high").alias("word_high")), "_lang")
    joined = join_small(measured, materialize(bands, "rule-bands"), ["_lang"], "left", F.xxhash64("doc_id", "text_hash")).drop("_lang")
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high")) & (F.col("word_log_perplexity") <= F.col("word_high"))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def rate_documents(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "log_perplexity", "low", "high", "word_log_perplexity", "word_high",
    )
