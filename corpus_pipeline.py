"""A training corpus from raw documents, in stages that each write Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.llm import jaccard, mixing, quality_rules, templates, tokens
from guestlens.llm.common import join_small, read
from guestlens.llm.queries import vocabulary
from guestlens.session import delete_path, landed, new_path, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stand in their language's band.

    Null, empty and short texts go. A document is named by id, language and a
    hash of its text, which decide its verdict; so repeated rows go or stay together.
    """

    def make() -> DataFrame:
        rejected = quality_rules.judge(docs).where(~F.col("kept"))
        return rejected.select(F.struct("doc_id", "lang", "text_hash").alias("_name")).distinct()

    named = docs.select(*COLUMNS, F.struct("doc_id", "lang", F.xxhash64("text").alias("text_hash")).alias("_name"))
    return join_small(named, landed(spark, "rejected", make), ["_name"], "left_anti").drop("_name")


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; of repeated rows one.

    Documents without words all stay.
    """
    return jaccard.one_of_each(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none."""
    judged = templates.decontaminate(docs, read(spark, sf_dir, "benchmark"), COLUMNS)
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words are not taken."""
    mixed = mixing.mix(docs, mixing.n_words(F.col("text")), COLUMNS)
    times = F.expr("taken div size").cast("int")
    taken = mixed.where("taken > 0")
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(1), times)).alias("_time")).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in files, read back; null and empty texts have the end id only."""
    return tokens.token_files(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("token-ID output", token_stage),
]

# Perplexities of a trained model and compressed files are not SQL; the tests
# hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again.

    A stage works in a folder of its own, which goes when its result is written; so
    does the result before it. The token files stay.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage{k}")
        if k == len(STAGES) - 1:
            stage(spark, docs, sf_dir).write.parquet(path)
        else:
            with scratch(spark, f"work{k}"):
                stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
