"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from guestlens.llm import (
    infill, jaccard, language_id, licenses, mixing, quality_model, quality_rules, repeats, sharding, spelling, templates,
    tokens, toxicity,
)
from guestlens.llm.common import read


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def sample_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf, "documents"))


def token_output(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_files(read(spark, sf, "documents"), vocabulary())


def mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_documents(read(spark, sf, "documents"))


def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf, "documents"), with_text=False).drop("kept_text")


def jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf, "documents")).drop("stays", "text_hash")


def quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    trusted = read(spark, sf, "labels").where("quality = 1")
    return quality_model.classify(read(spark, sf, "documents"), trusted)


def rate_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.rate_documents(read(spark, sf, "documents"))


def toxicity_scores(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(read(spark, sf, "documents"), read(spark, sf, "labels").select("doc_id", "toxic"))


def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return templates.decontaminate(read(spark, sf, "documents"), read(spark, sf, "benchmark"), ["doc_id"])


def license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(read(spark, sf, "documents"), licenses.known_digests(spark))


def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf, "documents"))


def fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return infill.infill_digests(read(spark, sf, "documents"))


def identify_language(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(read(spark, sf, "documents"))


QUERIES = {
    "op1_sharding": sample_sharding,
    "op2_quality_classifier": quality_classifier,
    "op3_token_output": token_output,
    "op4_quality_rules": rate_quality,
    "op5_decontamination": decontamination,
    "op6_mixing": mix_sources,
    "op7_substring_dedup": substring_dedup,
    "op8_jaccard_join": jaccard_join,
    "op9_license_scan": license_scan,
    "op10_toxicity": toxicity_scores,
    "op11_spelling_variants": spelling_variants,
    "op12_fill_in_middle": fill_in_middle,
    "op13_language_id": identify_language,
}

ORACLE_SQL: dict[str, str] = {
    "op9_license_scan": licenses.scan_sql(),
    "op12_fill_in_middle": infill.infill_sql(),
}
