"""Registered queries of the document operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cobasket.llm import align, audit, langid, leaks, lines, near, packing, quality_rank, rules, secrets, substrings, tokens, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.encoded_documents(spark, _table(spark, sf_dir))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.find_secrets(_table(spark, sf_dir))


def op3_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores: doc_id, held_out, score, predicted."""
    return quality_rank.rank(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores: doc_id, held_out, score, predicted."""
    return toxicity.rate(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into windows of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows of smaller doc_ids, as digests."""
    return substrings.digest(_table(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, as digests."""
    return lines.digest(lines.dedup_lines(_table(spark, sf_dir)))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near.classes(_table(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, the base rule and the verdict of the adaptive rules for every document."""
    return rules.report(_table(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return leaks.find_leaks(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep and remove at each step of all their orders, by source."""
    return audit.audit(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document: doc_id, held_out, lang_pred, score."""
    return langid.languages(_table(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers line up in every document."""
    return align.align(_table(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files, op2_secrets, op3_quality_rank, op4_toxicity, op5_packing,
        op6_substring_dedup, op7_line_dedup, op8_minhash, op9_quality_rules, op10_decontamination,
        op11_filter_audit, op12_language_id, op13_token_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op6_substring_dedup": substrings.ORACLE,
    "op7_line_dedup": lines.ORACLE,
    "op11_filter_audit": audit.ORACLE,
}
