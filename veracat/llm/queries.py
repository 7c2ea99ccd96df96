"""The operators bound to the benchmark tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracat.llm import chosen_path, decontaminate, fingerprints, hard_negatives, language, lines, mixing, paragraphs, quality, repair, tokens, warc
from veracat.llm.common import settings

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            settings(spark)
            return fn(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

        QUERIES[fn.__name__] = (run, sql)
        return fn

    return add


@query(mixing.SQL)
def op3_mix_sources(table):
    return mixing.mix_plan(table("documents")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query(quality.SQL)
def op4_quality_ledger(table):
    entries = quality.apply_policy(quality.stored_ledger(table("documents")), "v1")
    base_failed = F.col("failures").bitwiseAND(F.lit(quality.mask("base")).cast("bigint")) != 0
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (F.col("kept") & ~base_failed).alias("kept"), "n_lines", "policy", "failures")


@query(decontaminate.SQL)
def op8_decontaminate(table):
    return decontaminate.annotate(table("documents"), table("benchmark"))


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op2_token_files(table):
    return tokens.encode_to_orc(table("documents"), word_bpe())


@query()
def op9_token_counts(table):
    return tokens.count_tokens(table("documents"), word_bpe())


@query()
def op6_language_id(table):
    docs = table("documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    profiles = language.fit(docs.where((remainder != 2) & F.col("lang").isNotNull()), "doc_id", "text", "lang")
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", "text", held_out), profiles).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op7_warc_archive(table):
    return warc.archive(table("pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_chosen_path_join(table):
    return chosen_path.join(table("documents")).select("doc_id", "class_id", "n_links")


@query()
def op10_repeated_paragraphs(table):
    return paragraphs.per_document(paragraphs.repeats(table("documents")))


@query(lines.SQL)
def op1_line_dedup(table):
    return lines.dedup_lines(table("documents")).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query()
def op13_document_fingerprints(table):
    return fingerprints.edited(table("documents"))


@query(repair.SQL)
def op12_repair_conversations(table):
    return repair.repair(table("conversations"))


@query(hard_negatives.SQL)
def op11_hard_negatives(table):
    rows = hard_negatives.quantised(table("embeddings"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", shifted), F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))
