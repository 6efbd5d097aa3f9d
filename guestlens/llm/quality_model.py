"""Quality classifier: perplexities under Kneser-Ney models of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import hashing, kneser_ney, word_model
from guestlens.llm.common import BROADCAST_ROWS, join_small, materialize, slices

REACH, WORD_REACH = 6.0, 3.0


def _score(model: kneser_ney.Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kneser_ney.Scorer(model)
        for batch in slices(batches, "text"):
            w = hashing.words(batch.column("text"))
            # The characters of words and an end of each.
            chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
            chars = np.concatenate([[0], np.cumsum(chars[w.ends] - chars[w.starts] + 1)])
            symbols = (chars[w.first[1:]] - chars[w.first[:-1]]).tolist()
            logs = scorer.texts(w).tolist()
            yield pa.RecordBatch.from_pydict({
                "text_hash": batch.column("text_hash"),
                "doc_id": batch.column("doc_id"),
                "lang": batch.column("lang"),
                "n_symbols": pa.array(symbols, pa.int64()),
                "log_perplexity": pa.array([-x / n if n else None for x, n in zip(logs, symbols)], pa.float64()),
            })

    return run


def classify(docs: DataFrame, trusted: DataFrame, reach: float = REACH, word_reach: float = WORD_REACH) -> DataFrame:
    """doc_id, lang, n_symbols, log_perplexity, threshold, word_log_perplexity, word_threshold, good of every document.

    ``trusted`` lists doc_ids. Two models count the whole texts of all trusted
    documents: one the characters in words, one the words in order
    (``word_model``). The grams of all documents are joined with the counts, shard by
    shard, which gives each its probability; documents add them up. A document
    is good if each log perplexity is at most its language's threshold: from the
    quantiles of the trusted documents of that language, the upper quartile and
    ``reach`` or ``word_reach`` spreads more.

    Null, empty and wordless texts have no perplexity and are not good. A null
    language is a language of its own; one without trusted documents has the
    threshold of all. Repeated rows are scored alike; repeated and null ids in
    ``trusted`` change nothing. Without trusted documents nothing is good. An
    empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("text_hash"))
    spread = F.xxhash64("doc_id", "text_hash")
    listed = materialize(trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "trusted")
    marked = join_small(rows, listed.withColumn("_known", F.lit(True)), ["doc_id"], "left", spread)
    if listed.count() > BROADCAST_ROWS:
        # The texts are shuffled once, not each time that they are read.
        marked = materialize(marked, "marked-texts")
    model = kneser_ney.train(kneser_ney.count_grams(marked.where("_known"), "trusted-grams"), "trusted-model")
    asked = kneser_ney.count_grams(rows, "corpus-grams")
    table = kneser_ney.Table(materialize(kneser_ney.probabilities(asked, model), "corpus-p"))
    words = word_model.perplexities(marked, F.col("_known").isNotNull(), "trusted-words")
    schema = "text_hash long, doc_id long, lang string, n_symbols long, log_perplexity double"
    scored = materialize(rows.mapInArrow(_score(table), schema), "scores")
    scored = materialize(join_small(scored, words, ["text_hash"], "left", F.xxhash64("doc_id")), "word-scores").withColumn("_lang", F.struct("lang"))
    base = join_small(scored, listed, ["doc_id"], "left_semi", spread).where(F.col("log_perplexity").isNotNull())
    base = materialize(base, "trusted-scores")
    kinds = [("", "log_perplexity", reach), ("word_", "word_log_perplexity", word_reach)]
    for kind, value, far in kinds:
        bands = kneser_ney.fences(base, "_lang", value, far).select("_lang", F.col("high").alias(f"_{kind}high"))
        pooled = kneser_ney.fences(base.withColumn("_all", F.lit(0)), "_all", value, far).select("high").first()
        scored = join_small(scored, materialize(bands, f"{kind}bands"), ["_lang"], "left", spread)
        threshold = F.coalesce(f"_{kind}high", F.lit(float(pooled[0]) if pooled else None).cast("double"))
        scored = scored.withColumn(f"{kind}threshold", threshold)
    good = [F.coalesce(F.col(value) <= F.col(f"{kind}threshold"), F.lit(False)) for kind, value, _ in kinds]
    return scored.select(
        "doc_id", "lang", "n_symbols", "log_perplexity", "threshold", "word_log_perplexity", "word_threshold", (good[0] & good[1]).alias("good")
    )
