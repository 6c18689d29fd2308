"""Run audit (F10): one row per model and phase, appended to an audit table.

The reference's hook logs (run id, model, phase, invocation id, target,
started_at, logged_at) before and after an incremental model; we add the
model's row count at that point and what the merge did. A stored table's
record holds both, so neither the table nor the delta is counted for it; the
count of another frame is one distributed count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("run_id string, model string, phase string, invocation_id string, "
                "target string, started_at timestamp_ntz, logged_at timestamp_ntz")


def audit_row(spark: SparkSession, df: DataFrame | None, run_id: str, model: str, phase: str,
              invocation_id: str, target: str, started_at: dt.datetime,
              logged_at: dt.datetime | None = None) -> DataFrame:
    meta = spark.createDataFrame(
        [(run_id, model, phase, invocation_id, target, started_at, logged_at or started_at)],
        AUDIT_SCHEMA)
    if df is None:
        return meta.withColumn("row_count", F.lit(None).cast("bigint"))
    # Both sides are single rows (metadata, one global count): attach the
    # count as a column through a one-row join on a constant key.
    n = df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("_k", F.lit(1))
    return meta.withColumn("_k", F.lit(1)).join(F.broadcast(n), "_k").drop("_k")


def recorded_audit_row(spark: SparkSession, state: dict | None, run_id: str, model: str, phase: str, invocation_id: str,
                       target: str, started_at: dt.datetime, logged_at: dt.datetime | None = None) -> DataFrame:
    """As ``audit_row``, from a stored table's record: its rows, and (after a
    merge) the rows inserted, updated and deleted."""
    state = state or {}
    last = state.get("last") or {} if phase == "post" else {}
    row = (run_id, model, phase, invocation_id, target, started_at, logged_at or started_at, state.get("rows"),
           last.get("inserted"), last.get("updated"), last.get("deleted"))
    return spark.createDataFrame([row], f"{AUDIT_SCHEMA}, row_count bigint, rows_inserted bigint, rows_updated bigint, rows_deleted bigint")


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
