"""The corpus pipeline: languages, near duplicates, benchmark passages, the mix and the token files, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat.llm import chosen_path, decontaminate, language, mixing, tokens
from veracat.llm.common import settings
from veracat.session import materialise

#: Score, of 1, below which a text counts as told wrong, for a language without held-out rows to derive it from.
LEAST_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and those far from every profile, go."""
    settings(spark)
    profiles = language.fit(docs.where(F.col("lang").isNotNull()), "doc_id", "text", "lang")
    return language.keep_identified(docs, profiles, "text", LEAST_SCORE, language.least_scores(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id; texts without words are no class."""
    settings(spark)
    return chosen_path.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    settings(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until their sources weigh what they should."""
    settings(spark)
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    settings(spark)
    return tokens.encode_to_orc(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("token_files", write_tokens),
]
# Ranked profiles, sampled paths and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
