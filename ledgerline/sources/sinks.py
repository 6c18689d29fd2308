"""Exports (A13, A14): files partitioned by tenant for downstream systems.

The reference ships both as placeholders; these write what they name: the
latest day of tenant KPIs (JSON) and the AML compliance extract (CSV), one
directory per tenant so each partner receives only its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.marts import aml_suspects


def latest_day(kpis: DataFrame, day_col: str = "jour") -> DataFrame:
    """Rows of the newest day: one global max (a single row after partial
    aggregation), then a filter joined on that one value."""
    last = kpis.agg(F.max(day_col).alias("_last"))
    return kpis.join(F.broadcast(last), F.col(day_col) == F.col("_last"), "inner").drop("_last")


def _by_tenant(df: DataFrame) -> DataFrame:
    """Group rows by tenant before a per-tenant directory write, so each task
    writes few tenant directories (not one small file per tenant per task).
    REBALANCE lets AQE split a hot tenant over several tasks and merge small
    ones, where a hash repartition would send a whole tenant to one task."""
    return df.hint("rebalance", "tenant_id")


def export_tenant_kpis(kpis: DataFrame, path: str) -> DataFrame:
    out = latest_day(kpis)
    _by_tenant(out).write.mode("overwrite").partitionBy("tenant_id").json(path)
    return out


def compliance_extract(fact: DataFrame) -> DataFrame:
    return aml_suspects(fact).select(
        "tenant_id", "transaction_id", "compte_id", "date_transaction", "montant", "devise",
        "montant_eur", "aml_flag", "aml_score", "fraud_score", "is_flagged_for_review", "statut")


def export_compliance_report(fact: DataFrame, path: str) -> DataFrame:
    out = compliance_extract(fact)
    (_by_tenant(out).write.mode("overwrite").option("header", True)
     .partitionBy("tenant_id").csv(path))
    return out
