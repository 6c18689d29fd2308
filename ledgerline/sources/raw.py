"""Named raw tables read with their fixed schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline import schemas as S


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``source(name)``: the Parquet table at ``path`` read through the raw
    schema of ``table``; columns missing from the files come back NULL."""
    return spark.read.schema(S.struct(S.RAW_SCHEMAS[table])).parquet(path)


def write_raw(df: DataFrame, path: str, table: str) -> str:
    """Land a frame as a raw table: columns selected and cast to the schema."""
    cols = [df[n].cast(S.spark_type(t)).alias(n) for n, t in S.RAW_SCHEMAS[table]]
    df.select(*cols).write.mode("overwrite").parquet(path)
    return path
