"""The queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, html_text, language, line_dedup, merkle, mixing, near_duplicates, pii, prefix_trie, tokens, warc
from tessera.llm.common import table
from tessera.llm.quality_classifier import quality_scores
from tessera.llm.quality_rules import quality_rules


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_digest(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return found.select("doc_id", "n_lines", "n_removed", "n_moved", "removed_words", F.length(text).cast("long").alias("n_chars"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_ids,
        op2_language_id,
        op3_warc,
        op4_quality_rules,
        op5_decontamination,
        op6_mixing,
        op7_quality_classifier,
        op8_near_duplicates,
        op9_personal_data,
        op10_line_dedup,
        op11_prefix_trie,
        op12_html_text,
        op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {
    "op3_warc": warc.ORACLE,
    "op5_decontamination": decontamination.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op8_near_duplicates": near_duplicates.ORACLE,
    "op9_personal_data": pii.oracle_sql(),
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_html_text": html_text.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
