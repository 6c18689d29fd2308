"""End-to-end run: first (full) run, then an incremental run on the same output."""

import os
import uuid

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_run_stores_history_transfers_and_audit(spark):
    """What the run keeps: snapshot and SCD2, merged transfers, audit rows,
    source checks; and the same rows after a run that brings nothing new."""
    from ledgerline.plans.pipeline import run_pipeline
    from ledgerline.plans.warehouse import Warehouse
    from ledgerline.session import scratch_dir
    from ledgerline.sources import tables
    from ledgerline.sources.adapters import RawTables
    out = scratch_dir(spark, f"test-pipeline-{uuid.uuid4().hex[:8]}")
    w = Warehouse(RawTables(spark, SF))
    report = {r["test_name"]: r["status"] for r in run_pipeline(w, out).collect()}
    assert report["unique_fct_transactions_transaction_id"] == "pass"
    names = ("snapshot_comptes", "dim_comptes_scd2", "fct_virements", "stg_virements", "stg_transactions", "fct_transactions_v2",
             "fct_transactions_microbatch")
    first = {n: tables.read_table(spark, f"{out}/{n}").count() for n in names}
    assert first["snapshot_comptes"] == w.raw.comptes().count()
    assert first["fct_virements"] == w.fct_virements.count() and first["stg_transactions"] == w.stg_transactions.count()
    run_pipeline(Warehouse(RawTables(spark, SF)), out, run_id="again")
    assert first == {n: tables.read_table(spark, f"{out}/{n}").count() for n in names}
    logged = {(r["run_id"], r["model"], r["phase"]): r for r in spark.read.parquet(f"{out}/run_audit").collect()}
    audit = {k: r["row_count"] for k, r in logged.items()}
    assert logged["again", "fct_transactions", "post"]["rows_inserted"] == 0 == logged["again", "fct_virements", "post"]["rows_deleted"]
    assert logged["again", "stg_transactions", "post"]["rows_updated"] > 0 and logged["run", "fct_virements", "post"]["rows_updated"] is None
    assert audit["run", "fct_virements", "pre"] is None
    assert audit["again", "fct_virements", "pre"] == audit["again", "fct_virements", "post"] == first["fct_virements"]
    fact = tables.read_table(spark, f"{out}/fct_transactions")
    assert fact.count() == w.fct_transactions.count() == fact.select("transaction_id").distinct().count()
    assert tables.read_table(spark, f"{out}/source_tests").count() == 17
    assert tables.read_table(spark, f"{out}/source_freshness").count() == 8


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_second_run_on_changed_input(spark):
    """A second run that brings late statuses, moved dates, new rows and
    deleted accounts: the fact as by ``incremental_fact_run``, the history as
    by the snapshot, the day batches as their ledger says."""
    from pyspark.sql import functions as F

    from ledgerline.operators.snapshot import snapshot_check
    from ledgerline.plans import fixtures as FX
    from ledgerline.plans import history
    from ledgerline.plans.pipeline import run_pipeline
    from ledgerline.plans.registry import incremental_fact_run
    from ledgerline.plans.warehouse import Params, Warehouse
    from ledgerline.session import scratch_dir
    from ledgerline.sources import tables
    from ledgerline.sources.adapters import RawTables

    class Loaded(RawTables):
        """The raw tables as one of the two loads left them."""

        def __init__(self, load):
            super().__init__(spark, SF)
            self.load, self.plain = load, RawTables(spark, SF)

        def transactions(self):
            f = FX.SparkFixtures(self.plain)
            return f.tx_cut() if self.load == 1 else f.tx_v2()

        def comptes(self):
            rows = self.plain.comptes()
            return rows if self.load == 1 else rows.where(F.col("compte_id") % 10 != 3).withColumn(
                "statut", F.when(F.col("compte_id") % 7 == 1, F.lit("clos")).otherwise(F.col("statut")))

    out = scratch_dir(spark, f"test-pipeline-{uuid.uuid4().hex[:8]}")
    for load, as_of in ((1, "2001-12-30"), (2, "2001-12-31")):
        run_pipeline(Warehouse(Loaded(load), Params(as_of=as_of)), out, lookback_days=7, run_id=f"load{load}")
    w, f = Warehouse(Loaded(2)), FX.SparkFixtures(RawTables(spark, SF))
    rows = lambda df, cols: sorted(map(str, df.select(*cols).collect()))
    # accounts enrich a transaction when it comes, so compare what is of the transaction
    cols = [c for c in w.fct_transactions.columns if c not in ("type_compte", "customer_segment", "pays_compte")]
    assert rows(tables.read_table(spark, f"{out}/fct_transactions"), cols) == rows(incremental_fact_run(w, f.tx_cut(), f.tx_v2(), 7), cols)
    before = None
    for load, as_of in ((1, "2001-12-30 00:00:00"), (2, "2001-12-31 00:00:00")):
        before = snapshot_check(before, Loaded(load).comptes().select(*FX.SNAPSHOT_SOURCE), "compte_id", FX.SNAPSHOT_CHECK, as_of)
    assert rows(history.read_history(spark, f"{out}/snapshot_comptes"), before.columns) == rows(before, before.columns)
    state = tables.table_state(spark, f"{out}/fct_transactions")
    assert state["layout"]["bloom_cols"] == ["transaction_id"] and state["last"]["inserted"] > 0
    assert max(tables.table_state(spark, f"{out}/fct_transactions_microbatch")["days"]) == "2001-12-31"
