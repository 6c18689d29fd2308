"""Tolerant bulk load of delimited files.

Files are read with every column as a string (so short records are padded
with NULL, long ones truncated, and nothing is dropped by the parser), NULL
tokens are mapped to NULL, then each column is ``try_cast`` to its schema
type. A row is rejected when some column had a value that did not cast.

* ``on_error='abort'``: any reject raises (tenants, categories, FX).
* ``on_error='continue'``: rejects are returned next to the good rows.

gzip is not splittable: a ``.csv.gz`` file is parsed by one task. Where there
are fewer files than the caller asks tasks for, the good rows are repartitioned
after the scan to spread the casts and everything downstream across the
cluster; more files are as many tasks already. Rejects and history check each
row in the task that parsed it: only counts and rejected rows leave the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas as S

# Text values read as NULL besides the empty field (fixed by the file format).
NULL_TOKENS = ["", "NULL", "null"]


class LoadAborted(RuntimeError):
    pass


@dataclass
class LoadResult:
    good: DataFrame
    rejects: DataFrame
    history: DataFrame


def _null_tokens(c: Column) -> Column:
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def read_strings(spark: SparkSession, path: str, columns: list[str], header: bool = True,
                 delimiter: str = ",", repartition: int | None = None) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = (spark.read.option("header", header).option("sep", delimiter).option("quote", '"')
          .option("escape", '"').option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True).option("mode", "PERMISSIVE")
          .option("encoding", "UTF-8").schema(schema).csv(path)
          .select(*[_null_tokens(F.trim(F.col(c))).alias(c) for c in columns],
                  F.col("_metadata.file_name").alias("_file")))
    if repartition and len(df.inputFiles()) < repartition:
        df = df.repartition(repartition)
    return df


def load_csv(spark: SparkSession, path: str, schema: list[tuple[str, str]], load_ts: str,
             on_error: str = "continue", header: bool = True, delimiter: str = ",",
             repartition: int | None = None) -> LoadResult:
    """Load ``path`` into ``schema`` (list of (name, SQL type)).

    The file carries every schema column except ``_loaded_at``, which is
    stamped with ``load_ts``. Returns good rows (typed), rejects (raw text +
    ``_error_columns``) and a per-file history frame."""
    file_cols = [n for n, _ in schema if n != "_loaded_at"]
    types = dict(schema)
    casts = {c: F.col(c).try_cast(S.spark_type(types[c])) for c in file_cols}
    bad = [F.when(F.col(c).isNotNull() & casts[c].isNull(), F.lit(c)) for c in file_cols]
    flagged, spread = (read_strings(spark, path, file_cols, header, delimiter, n).select(
        "*", F.concat_ws(",", *bad).alias("_error_columns")) for n in (None, repartition))
    ok = F.col("_error_columns") == ""
    ts = F.lit(load_ts).cast("timestamp_ntz")
    good = spread.where(ok).select(*[casts[c].alias(c) for c in file_cols],
                                   ts.alias("_loaded_at"))
    rejects = flagged.where(~ok).select(*file_cols, "_file", "_error_columns")
    if on_error == "abort":
        n_bad = rejects.limit(1).count()
        if n_bad:
            raise LoadAborted(f"{path}: rejected records, load aborted")
    elif on_error != "continue":
        raise ValueError(on_error)
    history = load_history(flagged, ts)
    return LoadResult(good, rejects, history)


def load_history(flagged: DataFrame, load_ts: Column) -> DataFrame:
    """One row per file: rows parsed / loaded / rejected, status, time."""
    err = (F.col("_error_columns") != "").cast("int")
    h = flagged.groupBy(F.col("_file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("row_parsed"),
        F.sum(1 - err).cast("bigint").alias("row_count"),
        F.sum(err).cast("bigint").alias("error_count"))
    status = (F.when(F.col("error_count") == 0, "LOADED")
              .when(F.col("row_count") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))
    return h.select("file_name", status.alias("status"), "row_count", "row_parsed", "error_count",
                    load_ts.alias("last_load_time"))


def append_history(history: DataFrame, table: str, path: str) -> None:
    """Append a load's history to the history table."""
    history.select(F.lit(table).alias("table_name"), "*").write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str, failed: bool = False) -> DataFrame:
    """The history table, newest load first."""
    rows = spark.read.parquet(path)
    return (failed_only(rows) if failed else rows).orderBy(F.col("last_load_time").desc(), "table_name", "file_name")


def failed_only(history: DataFrame) -> DataFrame:
    """A7 ``RETURN_FAILED_ONLY``: files with at least one rejected record."""
    return history.where(F.col("error_count") > 0)


def load_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table, ordered by name."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")
