"""SCD2 snapshot: check strategy, hard deletes, returning keys."""

from ledgerline.operators.dims import dim_comptes_scd2
from ledgerline.operators.snapshot import snapshot_check

COLS = "compte_id bigint, statut string, risk_score int"
T = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def run(spark, hist, rows, i):
    cur = spark.createDataFrame(rows, COLS)
    return snapshot_check(hist, cur, "compte_id", ["statut"], T[i])


def test_three_status_changes_give_three_versions(spark):
    h = run(spark, None, [(1, "actif", 1)], 0)
    h = run(spark, h, [(1, "suspendu", 1)], 1)
    h = run(spark, h, [(1, "suspendu", 5)], 2)  # unchecked column only: no version
    h = run(spark, h, [(1, "actif", 5)], 3)
    rows = sorted(h.collect(), key=lambda r: r.dbt_valid_from)
    assert [r.statut for r in rows] == ["actif", "suspendu", "actif"]
    assert [r.dbt_valid_to is None for r in rows] == [False, False, True]
    # contiguous intervals
    assert rows[0].dbt_valid_to == rows[1].dbt_valid_from and rows[1].dbt_valid_to == rows[2].dbt_valid_from


def test_hard_delete_and_return(spark):
    h = run(spark, None, [(1, "actif", 1), (2, "actif", 1)], 0)
    h = run(spark, h, [(1, "actif", 1)], 1)
    closed = {r.compte_id: r for r in h.collect() if r.compte_id == 2}
    assert closed[2].dbt_valid_to is not None
    h = run(spark, h, [(1, "actif", 1), (2, "actif", 1)], 2)
    v2 = [r for r in h.collect() if r.compte_id == 2]
    assert len(v2) == 2 and sum(r.dbt_valid_to is None for r in v2) == 1
    dim = {(r.compte_id, r.version_number): r for r in dim_comptes_scd2_like(h).collect()}
    assert dim[(2, 2)].is_current and not dim[(2, 1)].is_current


def dim_comptes_scd2_like(h):
    from pyspark.sql import functions as F
    full = h
    for c in ["tenant_id", "numero_compte", "iban", "email", "nom_client", "prenom_client",
              "type_compte", "devise", "kyc_level", "kyc_date_verification", "aml_flag",
              "customer_segment", "is_pep", "updated_at"]:
        full = full.withColumn(c, F.lit(None).cast("string"))
    return dim_comptes_scd2(full)


def test_null_safe_comparison(spark):
    h = run(spark, None, [(1, None, 1)], 0)
    h = run(spark, h, [(1, None, 1)], 1)
    assert h.count() == 1  # NULL -> NULL is not a change
    h = run(spark, h, [(1, "actif", 1)], 2)
    assert h.count() == 2
