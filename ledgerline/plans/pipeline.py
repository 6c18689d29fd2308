"""End-to-end run in production order, as plain function calls (no scheduler).

source checks -> account snapshot, SCD2, dimensions -> staging, fact and
transfers (built at first, then merged within their lookback, an audit row
before and after each) -> marts -> data tests with stored failures -> exports.
Every table lands in ``out_dir`` (``sources.tables``); the large ones are
partitioned by month. Returns the data-test report.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ledgerline.functions.columns import trunc_date
from ledgerline.operators import audit, dims, facts, marts, staging
from ledgerline.operators import incremental as inc
from ledgerline.operators import quality as Q
from ledgerline.plans import fixtures as FX
from ledgerline.plans import history, microbatch, suite
from ledgerline.plans.warehouse import Warehouse
from ledgerline.contracts import FCT_TRANSACTIONS_CONTRACT
from ledgerline.session import size_for_input
from ledgerline.sources import sinks, tables

FACT_LAYOUT = dict(partition_by=["mois_transaction"], sort_by=["tenant_id", "transaction_id"],
                   bloom_cols=["transaction_id"])


class PipelineAborted(RuntimeError):
    pass


def run_pipeline(w: Warehouse, out_dir: str, lookback_days: int = 3, run_id: str = "run") -> DataFrame:
    spark = w.raw.spark
    size_for_input(spark, [w.raw.sf_dir])  # cluster runs: partition sizes from the input size
    started = dt.datetime.fromisoformat(f"{w.params.as_of} 00:00:00")
    # 1. source checks (the DAG's guard runs before anything is built)
    if Q.nonempty(w.raw_transactions, "raw_transactions").limit(1).count():
        raise PipelineAborted("raw_transactions is empty")
    tables.write_table(suite.source_freshness(w), f"{out_dir}/source_freshness")
    tables.write_table(Q.run_suite(suite.source_checks(w)), f"{out_dir}/source_tests")

    # 2. account history, then the dimensions (full rebuild)
    versions = history.run_snapshot(spark, f"{out_dir}/snapshot_comptes", w.raw.comptes().select(*FX.SNAPSHOT_SOURCE),
                                    "compte_id", FX.SNAPSHOT_CHECK, started)
    tables.write_table(dims.dim_comptes_scd2(versions), f"{out_dir}/dim_comptes_scd2")
    tables.write_table(w.int_fx_rates_daily, f"{out_dir}/int_fx_rates_daily")
    for name, order in (("dim_tenants", None), ("dim_comptes", ["tenant_id"]), ("dim_categories", None),
                        ("bridge_comptes_titulaires", None)):
        tables.write_table(getattr(w, name), f"{out_dir}/{name}", sort_by=order)

    # 3. staging, fact and transfers: the first run builds all, later runs
    #    merge what came within the lookback of the stored table's newest load
    def incremental(name, source, key, build, update, contract=None, month_of="mois_transaction"):
        """Merge (or build) one table; an audit row before and after."""
        path = f"{out_dir}/{name}"
        state = tables.table_state(spark, path)
        log = lambda phase: audit.append_audit(audit.recorded_audit_row(
            spark, tables.table_state(spark, path), run_id, name, phase, run_id, "prod", started), f"{out_dir}/run_audit")
        log("pre")
        if state:
            high = tables.table_watermark(spark, path, "_loaded_at")
            delta = build(inc.lookback(source, source, "_loaded_at", lookback_days, high=high) if high else source)
            # sorted, filtered and checked as the first build was (the table's record says how)
            tables.upsert_table(spark, path, delta, key, month_of, update, watermark_col="_loaded_at")
        else:
            keys = [key] if isinstance(key, str) else key
            tables.write_table(build(source), path, [month_of], ["tenant_id", keys[0]],
                               FACT_LAYOUT["bloom_cols"] if name == "fct_transactions" else None,
                               watermark_col="_loaded_at", contract=contract, key=keys)
        log("post")
        return tables.read_table(spark, path)

    month = lambda c: trunc_date("month", c)
    stg = incremental("stg_transactions", w.raw_transactions, "transaction_id", lambda raw: staging.stg_transactions(
        raw).withColumn("mois_transaction", month("date_transaction")), FX.STG_TX_UPDATE)
    fact = incremental("fct_transactions", stg, "transaction_id", lambda s: w.fact_from(
        facts.int_transactions_normalisees(s.drop("mois_transaction"), w.stg_comptes, w.stg_categories)),
        FX.FCT_TX_UPDATE, FCT_TRANSACTIONS_CONTRACT)
    transfers = incremental("stg_virements", w.raw.virements(), "virement_id", lambda raw: staging.stg_virements(
        raw).withColumn("mois_virement", month("date_virement")), None, month_of="mois_virement")
    legs = incremental("fct_virements", transfers, ["virement_id", "virement_leg"],
                       lambda s: facts.fct_virements(s.drop("mois_virement")).withColumn(
                           "mois_virement", month("date_virement")), None, month_of="mois_virement")
    # the fact once more, by day batches: the days not done yet, and the last ones again
    ran = microbatch.run_microbatch(
        spark, f"{out_dir}/fct_transactions_microbatch", stg, lambda s: w.fact_from(facts.int_transactions_normalisees(
            s.drop("mois_transaction"), w.stg_comptes, w.stg_categories)), "date_transaction", "jour_transaction",
        w.params.as_of, w.params.microbatch_begin, sort_by=["tenant_id"], watermark_col="_loaded_at")
    if failed := [b for b in ran if b.error]:
        raise PipelineAborted(f"day batches from {failed[0].start}: {failed[0].error}")
    # A model graph of its own on the stored tables: the caller's ``w`` stays
    # lazy, and must not pin files that the next run replaces.
    stored = Warehouse(w.raw, w.params, w.use_events)
    stored.fct_transactions, stored.fct_virements = fact, legs.drop("mois_virement")
    for name in ("dim_comptes", "dim_tenants", "dim_categories"):
        setattr(stored, name, tables.read_table(spark, f"{out_dir}/{name}"))
    tables.write_table(stored.fct_transactions_v2, f"{out_dir}/fct_transactions_v2", **FACT_LAYOUT)
    tables.write_table(marts.mart_transactions_anomalies(fact), f"{out_dir}/mart_transactions_anomalies")

    # 4. marts read the stored fact
    tables.write_table(marts.mart_tenant_kpis_daily(fact, stored.dim_tenants),
                       f"{out_dir}/mart_tenant_kpis_daily", sort_by=["jour", "tenant_id"])
    tables.write_table(marts.mart_solde_journalier(fact, stored.fct_virements, stored.dim_comptes),
                       f"{out_dir}/mart_solde_journalier", sort_by=["tenant_id", "jour"])
    tables.write_table(marts.mart_reconciliation(fact, w.params.as_of), f"{out_dir}/mart_reconciliation")
    tables.write_table(marts.mart_cohortes_retention(fact, stored.dim_comptes),
                       f"{out_dir}/mart_cohortes_retention")
    tables.write_table(marts.aml_suspects(fact), f"{out_dir}/mart_aml_suspects", ["tenant_id"])

    # 5. data tests on the stored models (each check reads a table, not the
    #    pipeline that built it); the report and the failing rows are stored
    checks = suite.reference_checks(stored)
    tables.write_table(Q.run_suite(checks), f"{out_dir}/dq_report")
    Q.store_failures(checks, tables.read_table(spark, f"{out_dir}/dq_report"), f"{out_dir}/dq_failures")

    # 6. exports
    kpis = tables.read_table(spark, f"{out_dir}/mart_tenant_kpis_daily")
    sinks.export_tenant_kpis(kpis, f"{out_dir}/exports/tenant_kpis")
    sinks.export_compliance_report(fact, f"{out_dir}/exports/compliance")
    return tables.read_table(spark, f"{out_dir}/dq_report")
