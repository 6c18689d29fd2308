"""The account history as a stored table (F8/F9), without rewriting it.

Versions lie in three partitions: ``open`` (as they were opened), ``closing``
(closed since the open ones were last written; their open form still stands in
``open``) and ``closed``. A run appends what it closes to ``closing`` and what
it opens to ``open``; no file of an earlier run is touched. Readers leave out
the open versions that ``closing`` holds, by version id.

When ``closing`` has grown beyond a share of the open versions, the run starts
with settling: the open versions are written without the closed ones, and the
closing ones move to ``closed``. Closed versions are never read by a run, so
its work follows the open versions and the source, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.snapshot import snapshot_changes, snapshot_check
from ledgerline.sources import tables

PART = "version_part"
SETTLE_AT = 0.25


def _parts(spark: SparkSession, path: str, *names: str) -> DataFrame:
    return tables.read_table(spark, path, only=list(names))


def open_versions(spark: SparkSession, path: str) -> DataFrame:
    closing = _parts(spark, path, "closing").select("dbt_scd_id")
    return _parts(spark, path, "open").join(closing, "dbt_scd_id", "left_anti")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every version, open and closed, as ``snapshot_check`` gives them."""
    now = open_versions(spark, path)
    return _parts(spark, path, "closing", "closed").select(*now.columns).unionByName(now).select(
        *[c for c in _parts(spark, path, "open").columns if c != PART])


def settle(spark: SparkSession, path: str) -> None:
    """Write the open versions without those that were closed since, and move
    the closing ones to the closed: one commit."""
    closing, now = _parts(spark, path, "closing"), open_versions(spark, path)
    rows = closing.withColumn(PART, F.lit("closed")).unionByName(now.withColumn(PART, F.lit("open")))
    tables.append_rows(rows, path, PART, replacing=["open", "closing"])


def run_snapshot(spark: SparkSession, path: str, current: DataFrame, key: str, check_cols: list[str], as_of,
                 hard_deletes: bool = True, settle_at: float = SETTLE_AT) -> DataFrame:
    """One snapshot run into the table at ``path``; the whole history."""
    part = F.when(F.col("dbt_valid_to").isNull(), F.lit("open")).otherwise(F.lit("closing"))
    if tables.table_state(spark, path) is None:
        first = snapshot_check(None, current, key, check_cols, as_of, hard_deletes)
        tables.write_table(first.withColumn(PART, F.lit("open")), path, [PART], [key])
        return read_history(spark, path)
    if _parts(spark, path, "closing").count() > settle_at * max(1, _parts(spark, path, "open").count()):
        settle(spark, path)
    now = open_versions(spark, path).drop(PART)
    changes = snapshot_changes(now, current, key, check_cols, as_of, hard_deletes)
    tables.append_rows(changes.withColumn(PART, part), path, PART, [key])
    return read_history(spark, path)
