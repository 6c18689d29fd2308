"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (decontam, html_extract, jaccard_join, merkle, mixing, oracle, pii, quality_rules, secret_scan, simhash, token_output, variants, warc,
                            weak_label)
from ledgerline.llm.common import read_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_label.classify(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(read_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(read_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    offered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered).otherwise(F.col("text"))
    return merkle.verify(merkle.build_manifest(docs, offered={"text": offered}))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_quality_classifier, op2_decontamination, op3_quality_rules, op4_warc_archives, op5_token_output,
           op6_secret_scan, op7_html_text, op8_personal_data, op9_simhash, op10_source_mix, op11_merkle_manifest,
           op12_jaccard_join, op13_spelling_variants)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """Where SQL can express a query; the others are tested by brute force."""
    return {"op2_decontamination": oracle.CONTAMINATION, "op4_warc_archives": oracle.ARCHIVES,
            "op11_merkle_manifest": oracle.MANIFEST, "op12_jaccard_join": oracle.JACCARD,
            "op13_spelling_variants": oracle.VARIANTS,
            "op3_quality_rules": oracle.QUALITY}
