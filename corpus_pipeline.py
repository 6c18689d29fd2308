"""Corpus pipeline: from ``documents`` to token shards, five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's docs.

Defined cases, stage by stage as in each operator's docstring: null and empty
texts fail the base quality rules and go with the first stage; rows without an
id are judged by their texts; of rows that are equal one stays; ties go to the
smallest id; an empty table gives empty stages and no shards; extra columns,
whatever their names, go along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontam, mixing, quality_rules, simhash, token_output
from ledgerline.llm.common import read_table, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.drop_near_duplicates(docs)


#: Share of a document's words from which it goes whole for its test passages.
MAX_COVERAGE = 0.2


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; documents that
    consist of them by more than ``MAX_COVERAGE`` go."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), max_coverage=MAX_COVERAGE)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document is there as often as it is taken."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards; per document what is read back from them."""
    import public_tokenizers

    return token_output.token_output(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixture), ("token_output", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: Fingerprints, learned fences and token ids have no SQL: tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None
