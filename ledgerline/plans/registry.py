"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver tables at
``sf_dir`` through the raw adapters, so its work grows with the scale factor.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import trunc_date
from ledgerline.operators import dims, fx, marts
from ledgerline.plans import history, microbatch
from ledgerline.plans import oracle as O
from ledgerline.plans.warehouse import Params, Warehouse
from ledgerline.session import scratch_dir
from ledgerline.sources import tables
from ledgerline.sources.adapters import EVENTS_AS_OF, RawTables

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

# The point-lookup key of the BI query (H2); any existing transaction id.
LOOKUP_TRANSACTION_ID = 1002


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def wh(spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
    return Warehouse(RawTables(spark, sf_dir), **kw)


def events_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(RawTables(spark, sf_dir), params=Params(as_of=EVENTS_AS_OF), use_events=True)


# --- staging ------------------------------------------------------------------

for _name in ("stg_tenants", "stg_categories", "stg_fx_rates", "stg_comptes", "stg_transactions",
              "stg_virements", "stg_titulaires", "stg_compte_titulaires"):
    register(_name, O.model_query(f"SELECT * FROM {_name}"))(
        (lambda n: lambda spark, sf: getattr(wh(spark, sf), n))(_name))


# --- intermediate ---------------------------------------------------------------

@register("date_spine", O.model_query("""
    SELECT CAST(g AS DATE) AS date_day
    FROM (SELECT min(jour_transaction) AS lo, max(jour_transaction) AS hi FROM int_transactions_normalisees) b,
         generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)"""))
def q_date_spine(spark, sf):
    return fx.spine_between(wh(spark, sf).int_transactions_normalisees, "jour_transaction")


@register("int_fx_rates_daily", O.model_query("SELECT * FROM int_fx_rates_daily"))
def q_fx_daily(spark, sf):
    return wh(spark, sf).int_fx_rates_daily


@register("int_transactions_normalisees", O.model_query("SELECT * FROM int_transactions_normalisees"))
def q_norm(spark, sf):
    return wh(spark, sf).int_transactions_normalisees


# --- dims -------------------------------------------------------------------------

@register("dim_tenants", O.model_query("SELECT * FROM dim_tenants"))
def q_dim_tenants(spark, sf):
    return wh(spark, sf).dim_tenants


@register("dim_comptes", O.model_query("SELECT * FROM dim_comptes"))
def q_dim_comptes(spark, sf):
    return wh(spark, sf).dim_comptes


@register("dim_categories", O.model_query("""
    SELECT * FROM cat_tree"""))
def q_dim_categories(spark, sf):
    return wh(spark, sf).dim_categories


@register("bridge_comptes_titulaires", O.model_query("SELECT * FROM bridge"))
def q_bridge(spark, sf):
    return wh(spark, sf).bridge_comptes_titulaires


# The holders of an account in a list; the k-th one's share ends where the next
# one's begins, and the first (cents mod holders) get a cent more.
_SHARES = {"account_cents": "SELECT compte_id, CAST(sum(montant_eur) * 100 AS HUGEINT) AS cents FROM fct_transactions GROUP BY 1",
           "holders": "SELECT compte_id, list(titulaire_id ORDER BY titulaire_id, id) AS h FROM stg_compte_titulaires WHERE is_active "
                      "GROUP BY 1",
           "shares": """
      SELECT compte_id, h[k] AS titulaire_id, cents // len(h) + CASE WHEN k <= cents % len(h) THEN 1 ELSE 0 END AS part
      FROM account_cents JOIN holders USING (compte_id), LATERAL (SELECT unnest(range(1, len(h) + 1)) AS k)
      UNION ALL
      SELECT compte_id, titulaire_id, 0 FROM account_cents JOIN stg_compte_titulaires USING (compte_id) WHERE NOT is_active
      UNION ALL
      SELECT compte_id, titulaire_id, (2 * cents + len(h)) // (2 * len(h))
      FROM account_cents JOIN stg_compte_titulaires USING (compte_id) LEFT JOIN holders USING (compte_id) WHERE is_active IS NULL"""}


@register("holder_allocation", O.with_models("""
    SELECT titulaire_id, count(part) AS nb_comptes, CAST(CAST(sum(part) AS DECIMAL(38,0)) * 0.01 AS DECIMAL(18,2)) AS montant_alloue_eur
    FROM shares GROUP BY titulaire_id""", *O.ALL_MODELS, _SHARES))
def q_holder_allocation(spark, sf):
    w = wh(spark, sf)
    return dims.holder_allocation(w.fct_transactions, w.bridge_comptes_titulaires)


@register("dq_shares_add_up", O.model_query("""
    SELECT compte_id, CAST(sum(montant_eur) AS DECIMAL(18,2)) AS montant_compte_eur, CAST(0 AS DECIMAL(18,2)) AS ecart_eur
    FROM fct_transactions WHERE false GROUP BY 1"""))
def q_shares_add_up(spark, sf):
    """Accounts whose active holders' shares don't add up to the cent."""
    w = wh(spark, sf)
    return Q.shares_add_up(dims.holder_shares(w.fct_transactions, w.bridge_comptes_titulaires))


# --- facts ------------------------------------------------------------------------

@register("fct_transactions", O.model_query("SELECT * FROM fct_transactions"))
def q_fct(spark, sf):
    return wh(spark, sf).fct_transactions


@register("fct_transactions_v2", O.model_query("""
    SELECT *, CAST(CASE WHEN type_operation = 'debit'
                        THEN CAST((10 * CAST(montant_eur * 100 AS HUGEINT) + 6) // 12 AS DECIMAL(38,0)) * 0.01
                        ELSE montant_eur END AS DECIMAL(18,2)) AS montant_hors_taxes
    FROM fct_transactions"""))
def q_fct_v2(spark, sf):
    return wh(spark, sf).fct_transactions_v2


@register("fct_virements", O.model_query("SELECT * FROM fct_virements"))
def q_fct_vir(spark, sf):
    return wh(spark, sf).fct_virements


# --- marts ------------------------------------------------------------------------

# A long list of measures, each row one number that a transaction, a distinct
# transaction or a distinct account adds to its tenant's day; summed by name.
_KPI_CTES = {
    "measures": """
      SELECT tenant_id, jour_transaction AS jour, unnest(['rows', 'flag', 'aml ' || aml_flag]) AS m,
             unnest([1, CAST(is_flagged_for_review AS INT), 1]) AS v FROM fct_transactions
      UNION ALL
      SELECT tenant_id, jour_transaction, unnest(['fee', type_operation]), unnest([frais, montant_eur]) FROM fct_transactions
      WHERE statut = 'validee'
      UNION ALL
      SELECT tenant_id, jour, 'is ' || statut, 1
      FROM (SELECT DISTINCT tenant_id, jour_transaction AS jour, statut, transaction_id FROM fct_transactions)
      UNION ALL
      SELECT tenant_id, jour, 'account', 1
      FROM (SELECT DISTINCT tenant_id, jour_transaction AS jour, compte_id FROM fct_transactions) WHERE compte_id IS NOT NULL""",
    "kpi_days": """
      SELECT tenant_id, jour, map_from_entries(list((m, v))) AS x
      FROM (SELECT tenant_id, jour, m, sum(v) AS v FROM measures WHERE m IS NOT NULL GROUP BY ALL) GROUP BY ALL""",
    "fraud_days": f"""
      SELECT tenant_id, jour_transaction AS jour, {O.avg6_sql('fraud_score')} AS mean, max(fraud_score) AS top
      FROM fct_transactions GROUP BY ALL"""}
_kpi = lambda name, kind: f"CAST(coalesce(x['{name}'], 0) AS {kind})"
_N, _EUR = "BIGINT", "DECIMAL(18,2)"


@register("mart_tenant_kpis_daily", O.with_models(f"""
    SELECT d.jour, d.tenant_id, tenant_code, tenant_name, contract_tier, {_kpi('rows', _N)} AS nb_transactions,
           {_kpi('account', _N)} AS nb_comptes_actifs, {_kpi('is validee', _N)} AS nb_transactions_validees,
           {_kpi('is rejetee', _N)} AS nb_transactions_rejetees,
           {O.pct_sql(_kpi('is validee', _N), _kpi('rows', _N))} AS taux_validation_pct,
           {_kpi('credit', _EUR)} AS volume_credit_eur, {_kpi('debit', _EUR)} AS volume_debit_eur,
           CAST({_kpi('credit', _EUR)} - {_kpi('debit', _EUR)} AS {_EUR}) AS volume_net_eur, {_kpi('fee', _EUR)} AS revenus_frais_eur,
           {_kpi('flag', _N)} AS nb_transactions_flagged, {_kpi('aml suspicious', _N)} AS nb_aml_suspicious,
           mean AS fraud_score_moyen, top AS fraud_score_max
    FROM kpi_days d JOIN fraud_days r ON r.jour = d.jour AND r.tenant_id = d.tenant_id
    LEFT JOIN dim_tenants t ON t.tenant_id = d.tenant_id""", *O.ALL_MODELS, _KPI_CTES))
def q_kpis(spark, sf):
    return wh(spark, sf).mart_tenant_kpis_daily


# Both kinds of movement in one signed list; a day's sums per kind and tenant.
_MOVES = """
      SELECT compte_id, jour, tenant_id, kind, sum(amount) AS s FROM (
        SELECT compte_id, jour_transaction AS jour, tenant_id, 'tx' AS kind, montant_signe_eur AS amount
        FROM fct_transactions WHERE statut = 'validee'
        UNION ALL
        SELECT compte_id, CAST(date_virement AS DATE), tenant_id, 'vir',
               montant * (CASE virement_leg WHEN 'sortant' THEN -1 ELSE 1 END) FROM fct_virements)
      GROUP BY ALL"""
# As coded (Q5) the tenant is no part of the match: each tenant's transactions
# of an account and day meet each tenant's transfers of it.
_FLOWS = {"moves": _MOVES, "flows": """
      SELECT coalesce(a.t, b.t) AS tenant_id, compte_id, jour, CAST(coalesce(a.s, 0) AS DECIMAL(18,2)) AS flux_transactions,
             CAST(coalesce(b.s, 0) AS DECIMAL(18,2)) AS flux_virements
      FROM (SELECT compte_id, jour, unnest(coalesce(x, [NULL])) AS a, y
            FROM (SELECT compte_id, jour, list({'t': tenant_id, 's': s}) FILTER (kind = 'tx') AS x,
                         list({'t': tenant_id, 's': s}) FILTER (kind = 'vir') AS y FROM moves GROUP BY ALL)) l,
           LATERAL (SELECT unnest(coalesce(l.y, [NULL])) AS b) r"""}
_FLOWS_TENANT = {"moves": _MOVES, "flows": """
      SELECT tenant_id, compte_id, jour,
             CAST(coalesce(sum(s) FILTER (kind = 'tx'), 0) AS DECIMAL(18,2)) AS flux_transactions,
             CAST(coalesce(sum(s) FILTER (kind = 'vir'), 0) AS DECIMAL(18,2)) AS flux_virements
      FROM moves GROUP BY ALL"""}


@register("mart_solde_journalier", O.with_models("""
    SELECT f.tenant_id, f.compte_id, f.jour, f.flux_transactions, f.flux_virements,
           CAST(f.flux_transactions + f.flux_virements AS DECIMAL(18,2)) AS flux_total_jour,
           CAST(c.solde_initial + sum(f.flux_transactions + f.flux_virements) OVER (
                PARTITION BY f.compte_id ORDER BY f.jour, f.tenant_id, f.flux_transactions, f.flux_virements
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS solde_cumule_eur
    FROM flows f JOIN dim_comptes c ON f.compte_id = c.compte_id""", *O.ALL_MODELS, _FLOWS))
def q_solde(spark, sf):
    return wh(spark, sf).mart_solde_journalier


# A batch's day has two sides, matched and open; the mart lays them side by side.
_SIDES = {"sides": """
      SELECT tenant_id, reconciliation_batch_id, source_system, jour_transaction, is_reconciled AS ok, count(*) AS n,
             sum(montant_eur) AS eur, min(date_transaction) AS first_at, max(date_transaction) AS last_at
      FROM fct_transactions GROUP BY ALL HAVING reconciliation_batch_id IS NOT NULL""",
          "batch_days": """
      SELECT tenant_id, reconciliation_batch_id, source_system, jour_transaction, CAST(sum(n) AS BIGINT) AS total,
             CAST(coalesce(any_value(n) FILTER (ok), 0) AS BIGINT) AS matched,
             CAST(coalesce(any_value(n) FILTER (NOT ok), 0) AS BIGINT) AS open_n, CAST(sum(eur) AS DECIMAL(18,2)) AS eur,
             CAST(coalesce(any_value(eur) FILTER (ok), 0) AS DECIMAL(18,2)) AS matched_eur,
             min(first_at) AS first_at, max(last_at) AS last_at
      FROM sides GROUP BY ALL"""}


@register("mart_reconciliation", O.with_models(f"""
    SELECT tenant_id, reconciliation_batch_id, source_system, jour_transaction, total AS nb_transactions,
           matched AS nb_rapprochees, open_n AS nb_non_rapprochees, {O.pct_sql('matched', 'total')} AS taux_rapprochement_pct,
           eur AS montant_total_eur, matched_eur AS montant_rapproche_eur,
           CAST(eur - matched_eur AS DECIMAL(18,2)) AS ecart_montant_eur, first_at AS first_tx, last_at AS last_tx,
           date_diff('day', CAST(last_at AS DATE), {O.AS_OF_D}) AS jours_depuis_dernier_tx,
           open_n > 0 AND CAST(last_at AS DATE) < {O.AS_OF_D} - INTERVAL 3 DAY AS alerte_reconciliation
    FROM batch_days""", *O.ALL_MODELS, _SIDES))
def q_recon(spark, sf):
    return wh(spark, sf).mart_reconciliation


# Months are numbers (12 * year + month); every account looks at each of the 13
# months from its own one, and finds a validated transaction there or not.
_COHORT_CTES = {
    "members": "SELECT compte_id, CAST(date_trunc('month', date_ouverture) AS DATE) AS cohort_mois, "
               "12 * year(date_ouverture) + month(date_ouverture) AS born FROM dim_comptes "
               "WHERE date_ouverture IS NOT NULL",
    "busy": "SELECT DISTINCT compte_id, 12 * year(date_transaction) + month(date_transaction) AS at "
            "FROM fct_transactions WHERE statut = 'validee'",
    "cells": """
        SELECT m.cohort_mois, CAST(o AS BIGINT) AS mois_offset, count(DISTINCT m.compte_id) AS nb_utilisateurs_cohorte,
               count(DISTINCT m.compte_id) FILTER (b.at IS NOT NULL) AS nb_utilisateurs_actifs
        FROM members m, range(13) r(o) LEFT JOIN busy b ON b.compte_id = m.compte_id AND b.at = m.born + o
        GROUP BY ALL""",
}
_COHORT_SQL = ("SELECT *, " + O.pct_sql("nb_utilisateurs_actifs", "nb_utilisateurs_cohorte")
               + " AS taux_retention_pct FROM cells WHERE {} ORDER BY cohort_mois, mois_offset")

register("mart_cohortes_retention", O.with_models(
    _COHORT_SQL.format("nb_utilisateurs_actifs > 0"), *O.ALL_MODELS, _COHORT_CTES))(
    lambda spark, sf: wh(spark, sf).mart_cohortes_retention)

register("mart_cohortes_zero_fill", O.with_models(_COHORT_SQL.format("true"), *O.ALL_MODELS, _COHORT_CTES))(
    lambda spark, sf: (lambda w: marts.mart_cohortes_retention(w.fct_transactions, w.dim_comptes,
                                                               zero_fill=True))(wh(spark, sf)))


@register("mart_transactions_anomalies", O.model_query("""
    SELECT transaction_id, compte_id, date_transaction, montant_eur, montant_eur AS moyenne_90j,
           CAST(0.0 AS DOUBLE) AS ecart_type_90j, CAST(0.0 AS DOUBLE) AS z_score, false AS is_anomalie,
           'low' AS severite
    FROM fct_transactions WHERE statut = 'validee'"""))
def q_anom(spark, sf):
    return wh(spark, sf).mart_transactions_anomalies


# --- BI ---------------------------------------------------------------------------

@register("bi_tenant_month", O.model_query("""
    SELECT tenant_id, mois_transaction, CAST(sum(montant_eur) AS DECIMAL(18,2)) AS sum_montant_eur,
           count(*) AS nb_transactions
    FROM fct_transactions GROUP BY 1, 2 ORDER BY 1, 2"""))
def q_bi1(spark, sf):
    return marts.bi_tenant_month(wh(spark, sf).fct_transactions)


@register("bi_point_lookup", O.model_query(
    f"SELECT * FROM fct_transactions WHERE transaction_id = {LOOKUP_TRANSACTION_ID}"))
def q_bi2(spark, sf):
    return marts.bi_point_lookup(wh(spark, sf).fct_transactions, LOOKUP_TRANSACTION_ID)


@register("bi_aml_filter", O.model_query(f"""
    SELECT tenant_id, count(*) AS nb_transactions, {O.avg6_sql('aml_score')} AS aml_score_moyen
    FROM fct_transactions WHERE aml_flag <> 'clean' GROUP BY 1"""))
def q_bi3(spark, sf):
    return marts.bi_aml_filter(wh(spark, sf).fct_transactions)


@register("aml_suspects", O.model_query("SELECT * FROM fct_transactions WHERE aml_flag <> 'clean'"))
def q_aml(spark, sf):
    return marts.aml_suspects(wh(spark, sf).fct_transactions)


# --- incremental (F1-F7, F11) ---------------------------------------------------

from ledgerline.operators import incremental as inc  # noqa: E402
from ledgerline.operators import snapshot as snap  # noqa: E402
from ledgerline.operators import facts, staging  # noqa: E402
from ledgerline.operators.staging import STG_TRANSACTIONS_COLUMNS as STG_TX  # noqa: E402
from ledgerline.plans import fixtures as FX  # noqa: E402

_STG_VIR = ["virement_id", "tenant_id", "compte_source_id", "compte_dest_id", "montant", "devise",
            "date_virement", "date_execution", "motif", "reference", "statut", "type_virement",
            "frais", "created_at", "updated_at", "_loaded_at"]
_FCT_VIR = ["virement_id", "tenant_id", "compte_id", "contrepartie_compte_id", "virement_leg",
            "montant_signe", "montant", "devise", "date_virement", "statut", "_loaded_at"]
_FCT = ["transaction_id", "external_transaction_id", "tenant_id", "compte_id", "categorie_id",
        "date_transaction", "jour_transaction", "semaine_transaction", "mois_transaction",
        "date_valeur", "date_settlement", "montant", "devise", "montant_eur", "montant_signe",
        "montant_signe_eur", "frais", "montant_net", "type_operation", "sens", "statut",
        "moyen_paiement", "canal", "type_compte", "customer_segment", "pays_compte",
        "nom_categorie", "type_categorie", "groupe", "marchand_nom", "marchand_categorie",
        "marchand_pays", "marchand_mcc", "aml_score", "aml_flag", "fraud_score",
        "is_flagged_for_review", "is_reconciled", "reconciliation_batch_id", "source_system",
        "created_at", "updated_at", "_loaded_at"]


def fx_sql(final: str, extra: dict[str, str]) -> str:
    return O.with_models(final, *O.ALL_MODELS, FX.duckdb_fixture_ctes(), extra)


def _fix(spark, sf) -> tuple[Warehouse, FX.SparkFixtures]:
    w = wh(spark, sf)
    return w, FX.SparkFixtures(w.raw)


_MERGE_CTES = {"stg_t": O.stg_tx_sql("tx_cut"), "stg_d": O.stg_tx_sql("tx_delta")}


@register("merge_upsert", fx_sql(
    O.merge_sql("stg_t", "stg_d", ["transaction_id"], STG_TX, STG_TX, FX.STG_TX_UPDATE), _MERGE_CTES))
def q_merge_upsert(spark, sf):
    _, f = _fix(spark, sf)
    return inc.merge(staging.stg_transactions(f.tx_cut()), staging.stg_transactions(f.tx_delta()),
                     "transaction_id", FX.STG_TX_UPDATE)


@register("merge_upsert_outer_join", fx_sql(
    O.merge_sql("stg_t", "stg_d", ["transaction_id"], STG_TX, STG_TX, FX.STG_TX_UPDATE), _MERGE_CTES))
def q_merge_upsert_outer(spark, sf):
    """The same merge as one full outer join."""
    _, f = _fix(spark, sf)
    return inc.merge(staging.stg_transactions(f.tx_cut()), staging.stg_transactions(f.tx_delta()),
                     "transaction_id", FX.STG_TX_UPDATE, plan="outer")


@register("merge_all_columns", fx_sql(
    O.merge_sql("vir_t", "vir_d", ["virement_id"], _STG_VIR, _STG_VIR, None),
    {"vir_t": O.stg_vir_sql("vir_cut"), "vir_d": O.stg_vir_sql("vir_delta")}))
def q_merge_all(spark, sf):
    _, f = _fix(spark, sf)
    return inc.merge(staging.stg_virements(f.vir_cut()), staging.stg_virements(f.vir_delta()),
                     "virement_id", None)


@register("merge_composite_key", fx_sql(
    O.merge_sql("legs_t", "legs_d", ["virement_id", "virement_leg"], _FCT_VIR, _FCT_VIR, None),
    {"vir_t": O.stg_vir_sql("vir_cut"), "vir_d": O.stg_vir_sql("vir_delta"),
     "legs_t": O.fct_vir_sql("vir_t"), "legs_d": O.fct_vir_sql("vir_d")}))
def q_merge_composite(spark, sf):
    _, f = _fix(spark, sf)
    t = facts.fct_virements(staging.stg_virements(f.vir_cut()))
    d = facts.fct_virements(staging.stg_virements(f.vir_delta()))
    return inc.merge(t, d, ["virement_id", "virement_leg"], None)


@register("merge_new_columns", fx_sql(
    O.merge_sql("stg_t", "stg_dn", ["transaction_id"], STG_TX, STG_TX + ["canal_detail"],
                FX.STG_TX_UPDATE),
    {**_MERGE_CTES, "stg_dn": "SELECT *, canal || '/' || moyen_paiement AS canal_detail FROM stg_d"}))
def q_merge_new_cols(spark, sf):
    _, f = _fix(spark, sf)
    d = staging.stg_transactions(f.tx_delta())
    d = d.withColumn("canal_detail", F.concat(F.col("canal"), F.lit("/"), F.col("moyen_paiement")))
    return inc.merge(staging.stg_transactions(f.tx_cut()), d, "transaction_id", FX.STG_TX_UPDATE)


def incremental_fact_run(w: Warehouse, raw_before: DataFrame, raw_after: DataFrame,
                         days: int = 7, touch_loaded_at: bool = False,
                         delete_unqualified: bool = False) -> DataFrame:
    """one incremental run of staging then fact, each with its lookback
    window and column-limited merge, starting from tables built on
    ``raw_before`` and reading ``raw_after``.

    Options for the quirks: ``touch_loaded_at`` (Q4) adds ``_loaded_at`` to
    both update lists, so an updated row advances the watermark;
    ``delete_unqualified`` (Q3) removes from the fact the keys whose new
    version no longer qualifies (rejected, cancelled, reversal)."""
    spark = w.raw.spark
    extra = ["_loaded_at"] if touch_loaded_at else []
    base = scratch_dir(spark, f"run-{uuid.uuid4().hex}")
    stg_path, fact_path = f"{base}/stg_transactions", f"{base}/fct_transactions"
    month = "mois_transaction"
    staged = lambda raw: staging.stg_transactions(raw).withColumn(month, trunc_date("month", "date_transaction"))
    fact_of = lambda stg: w.fact_from(facts.int_transactions_normalisees(
        stg.drop(month), w.stg_comptes, w.stg_categories))
    tables.write_table(staged(raw_before), stg_path, [month], watermark_col="_loaded_at")
    tables.write_table(fact_of(tables.read_table(spark, stg_path)), fact_path, [month],
                       watermark_col="_loaded_at")
    recent = lambda source, path: inc.lookback(
        source, source, "_loaded_at", days, high=tables.table_watermark(spark, path, "_loaded_at"))
    tables.upsert_table(spark, stg_path, staged(recent(raw_after, stg_path)), "transaction_id", month,
                        FX.STG_TX_UPDATE + extra, watermark_col="_loaded_at")
    window = recent(tables.read_table(spark, stg_path), fact_path)
    drop = None
    if delete_unqualified:
        keep = F.col("statut").isin(*facts.FACT_STATUSES) & (F.col("is_reversal") == F.lit(False))
        drop = window.where(~F.coalesce(keep, F.lit(False))).select("transaction_id")
    tables.upsert_table(spark, fact_path, fact_of(window), "transaction_id", month, FX.FCT_TX_UPDATE + extra,
                        watermark_col="_loaded_at", delete_keys=drop)
    return tables.read_table(spark, fact_path)


def _lookback_ctes(extra: list[str] | None = None, delete: bool = False) -> dict[str, str]:
    extra = extra or []
    ctes = {
        "stg_t": O.stg_tx_sql("tx_cut"),
        "stg_lb": O.stg_tx_sql(f"({O.lookback_sql('tx_v2', 'stg_t', 7)})"),
        "stg_new": O.merge_sql("stg_t", "stg_lb", ["transaction_id"], STG_TX, STG_TX,
                               FX.STG_TX_UPDATE + extra),
        "norm_t": O.norm_sql("stg_t"), "fct_t": O.fact_sql("norm_t"),
        "win": O.lookback_sql("stg_new", "fct_t", 7),
        "norm_d": O.norm_sql("win"), "fct_d": O.fact_sql("norm_d"),
        "merged": O.merge_sql("fct_t", "fct_d", ["transaction_id"], _FCT, _FCT, FX.FCT_TX_UPDATE + extra),
    }
    if delete:
        ctes["merged_del"] = ("SELECT * FROM merged WHERE transaction_id NOT IN (SELECT transaction_id FROM win "
                              "WHERE NOT coalesce(statut IN ('validee', 'en_attente') AND is_reversal = false, false))")
    return ctes


@register("merge_touch_loaded_at", None)
def q_merge_touch(spark, sf):
    w, f = _fix(spark, sf)
    return incremental_fact_run(w, f.tx_cut(), f.tx_v2(), 7, touch_loaded_at=True)


@register("merge_delete_unqualified", None)
def q_merge_delete(spark, sf):
    w, f = _fix(spark, sf)
    # With the watermark advanced on update (Q4 option), so that the status
    # changes reach the fact's window and the deletions are visible.
    return incremental_fact_run(w, f.tx_cut(), f.tx_v2(), 7, touch_loaded_at=True,
                                delete_unqualified=True)


@register("merge_lookback", fx_sql(
    O.merge_sql("fct_t", "fct_d", ["transaction_id"], _FCT, _FCT, FX.FCT_TX_UPDATE),
    {"stg_t": O.stg_tx_sql("tx_cut"),
     "stg_lb": O.stg_tx_sql(f"({O.lookback_sql('tx_v2', 'stg_t', 7)})"),
     "stg_new": O.merge_sql("stg_t", "stg_lb", ["transaction_id"], STG_TX, STG_TX, FX.STG_TX_UPDATE),
     "norm_t": O.norm_sql("stg_t"), "fct_t": O.fact_sql("norm_t"),
     "norm_d": O.norm_sql(f"({O.lookback_sql('stg_new', 'fct_t', 7)})"), "fct_d": O.fact_sql("norm_d")}))
def q_merge_lookback(spark, sf):
    w, f = _fix(spark, sf)
    return incremental_fact_run(w, f.tx_cut(), f.tx_v2(), 7)


@register("merge_full_refresh", fx_sql("SELECT * FROM fct_v2",
                                       {"stg_v2": O.stg_tx_sql("tx_v2"), "norm_v2": O.norm_sql("stg_v2"),
                                        "fct_v2": O.fact_sql("norm_v2")}))
def q_merge_full_refresh(spark, sf):
    w, f = _fix(spark, sf)
    fresh = w.fact_from(facts.int_transactions_normalisees(
        staging.stg_transactions(f.tx_v2()), w.stg_comptes, w.stg_categories))
    return inc.merge(None, fresh, "transaction_id", FX.FCT_TX_UPDATE)


# --- microbatch (E4/F6) -------------------------------------------------------------

_EV_DAY = (f"CAST(date_transaction AS DATE) >= DATE '{FX.MICROBATCH_START}' AND "
           f"CAST(date_transaction AS DATE) < DATE '{FX.MICROBATCH_END}'")


@register("fct_transactions_microbatch", fx_sql(
    f"SELECT * FROM ev_fct_t WHERE NOT ({_EV_DAY}) UNION ALL SELECT * FROM ev_fct_s WHERE {_EV_DAY}",
    {"ev_stg_t": O.stg_tx_sql(f"(SELECT * FROM raw_event_transactions WHERE date_transaction < "
                              f"TIMESTAMP '{FX.MICROBATCH_TARGET_END} 00:00:00')"),
     "ev_norm_t": O.norm_sql("ev_stg_t"), "ev_fct_t": O.fact_sql("ev_norm_t"),
     "ev_stg_s": O.stg_tx_sql("events_altered"), "ev_norm_s": O.norm_sql("ev_stg_s"),
     "ev_fct_s": O.fact_sql("ev_norm_s")}))
def q_microbatch(spark, sf):
    w, f = _fix(spark, sf)

    def fact_of(raw):
        return w.fact_from(facts.int_transactions_normalisees(
            staging.stg_transactions(raw), w.stg_comptes, w.stg_categories))
    ev = w.raw.event_transactions()
    target = fact_of(ev.where(F.col("date_transaction")
                              < F.lit(f"{FX.MICROBATCH_TARGET_END} 00:00:00").cast("timestamp_ntz")))
    source = fact_of(f.events_altered())
    return inc.replace_batches(target, source, "date_transaction", FX.MICROBATCH_START,
                               FX.MICROBATCH_END)


# --- snapshot / SCD2 (F8, F9, D5) ----------------------------------------------------

_T1, _T2, _T3 = FX.SNAPSHOT_TIMES
_SNAP_CTES = {
    "h1": O.snapshot_sql(None, "accounts_run1", "compte_id", FX.SNAPSHOT_SOURCE, FX.SNAPSHOT_CHECK, _T1),
    "h2": O.snapshot_sql("h1", "accounts_run2", "compte_id", FX.SNAPSHOT_SOURCE, FX.SNAPSHOT_CHECK, _T2),
    "h3": O.snapshot_sql("h2", "accounts_run3", "compte_id", FX.SNAPSHOT_SOURCE, FX.SNAPSHOT_CHECK, _T3),
}


def snapshot_runs(spark, sf, runs: int) -> DataFrame:
    _, f = _fix(spark, sf)
    hist = None
    for r in range(1, runs + 1):
        hist = snap.snapshot_check(hist, f.accounts_at(r), "compte_id", FX.SNAPSHOT_CHECK,
                                   FX.SNAPSHOT_TIMES[r - 1])
    return hist


register("snapshot_two_runs", fx_sql("SELECT * FROM h2", _SNAP_CTES))(
    lambda spark, sf: snapshot_runs(spark, sf, 2))
register("snapshot_three_runs", fx_sql("SELECT * FROM h3", _SNAP_CTES))(
    lambda spark, sf: snapshot_runs(spark, sf, 3))

_SK_NULL = "'_dbt_utils_surrogate_key_null_'"


@register("dim_comptes_scd2", fx_sql(f"""
    SELECT md5(coalesce(CAST(compte_id AS VARCHAR), {_SK_NULL}) || '-' ||
               coalesce(strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S.%f'), {_SK_NULL})) AS dim_compte_sk,
           compte_id, tenant_id, numero_compte, iban, email, nom_client, prenom_client, type_compte, devise,
           statut, kyc_level, kyc_date_verification, aml_flag, customer_segment, is_pep, risk_score,
           dbt_valid_from AS date_debut_validite, dbt_valid_to AS date_fin_validite,
           dbt_valid_to IS NULL AS is_current,
           row_number() OVER (PARTITION BY compte_id ORDER BY dbt_valid_from) AS version_number,
           updated_at
    FROM h3""", _SNAP_CTES))
def q_scd2(spark, sf):
    return dims.dim_comptes_scd2(snapshot_runs(spark, sf, 3))


# --- anomalies (G6) and dense balance (Q6) -----------------------------------------

_SEV = "CASE WHEN abs(z_score) > 5 THEN 'high' WHEN abs(z_score) > 4 THEN 'medium' ELSE 'low' END"


@register("anomaly_zscore", fx_sql(f"""
    SELECT transaction_id, compte_id, date_transaction, montant_eur, moyenne_90j, ecart_type_90j, z_score,
           coalesce(abs(z_score) > 3, false) AS is_anomalie, {_SEV} AS severite
    FROM (
      SELECT transaction_id, compte_id, date_transaction, montant_eur,
             CAST(CASE WHEN n = 0 THEN NULL ELSE
                  CAST(sign(sc) * ((2 * abs(sc) * 10000 + n) // (2 * n)) AS DECIMAL(38,0)) * 0.000001
                  END AS DECIMAL(18,6)) AS moyenne_90j,
             round(sd, 6) AS ecart_type_90j,
             round(CASE WHEN sd > 0 THEN (x - m) / sd END, 6) AS z_score
      FROM (
        SELECT *, avg(x) OVER w AS m, stddev_samp(x) OVER w AS sd,
               CAST(sum(montant_eur) OVER w * 100 AS HUGEINT) AS sc, count(montant_eur) OVER w AS n
        FROM (SELECT *, CAST(montant_eur AS DOUBLE) AS x, epoch_us(date_transaction) AS us
              FROM ev_fct WHERE statut = 'validee')
        WINDOW w AS (PARTITION BY compte_id ORDER BY us
                     RANGE BETWEEN {90 * 86_400_000_000} PRECEDING AND 1 PRECEDING)))""",
    {"ev_stg": O.stg_tx_sql("raw_event_transactions"), "ev_norm": O.norm_sql("ev_stg"),
     "ev_fct": O.fact_sql("ev_norm")}))
def q_zscore(spark, sf):
    return marts.anomaly_zscore(events_wh(spark, sf).fct_transactions)


@register("mart_solde_dense", fx_sql(f"""
    SELECT b.tenant_id, b.compte_id, CAST(g.d AS DATE) AS jour,
           CAST(CASE WHEN CAST(g.d AS DATE) = b.jour THEN b.flux ELSE 0 END AS DECIMAL(18,2)) AS flux_total_jour,
           CAST(b.bal AS DECIMAL(18,2)) AS solde_cumule_eur
    FROM (
      SELECT c.tenant_id, f.compte_id, f.jour, f.flux,
             c.solde_initial + sum(f.flux) OVER (PARTITION BY f.compte_id ORDER BY f.jour
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bal,
             coalesce(CAST(lead(f.jour) OVER (PARTITION BY f.compte_id ORDER BY f.jour) - 1 AS DATE),
                      DATE '{O.FX_SPINE_END}' - 1) AS upto
      FROM (SELECT compte_id, jour, sum(flux_transactions + flux_virements) AS flux FROM flows GROUP BY 1, 2) f
      JOIN dim_comptes c ON f.compte_id = c.compte_id
    ) b, generate_series(b.jour, b.upto, INTERVAL 1 DAY) g(d)
    WHERE b.jour <= DATE '{O.FX_SPINE_END}' - 1""", _FLOWS))
def q_solde_dense(spark, sf):
    w = wh(spark, sf)
    return marts.mart_solde_dense(w.fct_transactions, w.fct_virements, w.dim_comptes,
                                  w.params.fx_end)


# --- data quality (I1-I15) -------------------------------------------------------

from ledgerline.operators import quality as Q  # noqa: E402
from ledgerline.plans import suite  # noqa: E402
from ledgerline.sources.adapters import AS_OF  # noqa: E402

_AS_OF_TS = f"{AS_OF} 00:00:00"


@register("dq_suite", O.model_query(suite.suite_sql()))
def q_dq_suite(spark, sf):
    return Q.run_suite(suite.reference_checks(wh(spark, sf)))


@register("dq_unique", O.model_query(
    "SELECT compte_id, count(*) AS n_records FROM stg_compte_titulaires WHERE compte_id IS NOT NULL "
    "GROUP BY compte_id HAVING count(*) > 1"))
def q_dq_unique(spark, sf):
    return Q.unique(wh(spark, sf).stg_compte_titulaires, "compte_id")


@register("dq_not_null", O.model_query("SELECT * FROM dim_comptes WHERE date_ouverture IS NULL"))
def q_dq_not_null(spark, sf):
    return Q.not_null(wh(spark, sf).dim_comptes, "date_ouverture")


@register("dq_accepted_values", O.model_query(
    "SELECT * FROM stg_transactions WHERE type_operation IS NOT NULL "
    "AND type_operation NOT IN ('credit', 'debit')"))
def q_dq_accepted_values(spark, sf):
    return Q.accepted_values(wh(spark, sf).stg_transactions, "type_operation", ["credit", "debit"])


@register("dq_relationships", O.model_query(
    "SELECT * FROM stg_transactions t WHERE t.categorie_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM stg_categories c WHERE c.categorie_id = t.categorie_id)"))
def q_dq_relationships(spark, sf):
    w = wh(spark, sf)
    return Q.relationships(w.stg_transactions, "categorie_id", w.stg_categories, "categorie_id")


@register("dq_accepted_range", O.model_query(
    "SELECT * FROM fct_transactions WHERE montant_eur IS NOT NULL AND (montant_eur < 0 OR montant_eur > 100000000)"))
def q_dq_accepted_range(spark, sf):
    return Q.accepted_range(wh(spark, sf).fct_transactions, "montant_eur", 0, 100_000_000)


@register("dq_row_count_delta", O.model_query("""
    SELECT n_model, n_compare, delta_pct FROM (
      SELECT a.n AS n_model, b.n AS n_compare,
             round(abs(a.n - b.n) * 100.0 / nullif(b.n, 0), 4) AS delta_pct
      FROM (SELECT count(*) AS n FROM fct_transactions) a, (SELECT count(*) AS n FROM stg_transactions) b)
    WHERE delta_pct > 10"""))
def q_dq_row_count_delta(spark, sf):
    w = wh(spark, sf)
    return Q.row_count_delta(w.fct_transactions, w.stg_transactions, 10.0)


@register("dq_freshness", O.model_query(f"""
    SELECT 'raw_transactions' AS source, max_loaded_at, age_hours,
           CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > 6 THEN 'error'
                WHEN age_hours > 2 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(_loaded_at) AS max_loaded_at,
                 round((epoch_us(TIMESTAMP '{_AS_OF_TS}') - epoch_us(max(_loaded_at))) / 3600000000.0, 4)
                   AS age_hours
          FROM raw_transactions)"""))
def q_dq_freshness(spark, sf):
    return Q.freshness(wh(spark, sf).raw_transactions, "_loaded_at", _AS_OF_TS, 2, 6,
                       "raw_transactions")


_SOURCE_HOURS = {t: (6, 24) for t in ("raw_categories", "raw_compte_titulaires", "raw_fx_rates", "raw_tenants",
                                      "raw_titulaires", "raw_virements")} | {
    "raw_comptes": (12, 48), "raw_transactions": (2, 6)}


@register("dq_freshness_sources", O.model_query(" UNION ALL ".join(f"""
    SELECT source, max_loaded_at, age_hours, CASE WHEN max_loaded_at IS NULL OR age_hours > {error} THEN 'error'
           WHEN age_hours > {warn} THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT '{t}' AS source, max(_loaded_at) AS max_loaded_at,
                 round(epoch_us(TIMESTAMP '{O.AS_OF} 00:00:00') / 3600000000.0 - epoch_us(max(_loaded_at)) / 3600000000.0, 4)
                   AS age_hours FROM {t})""" for t, (warn, error) in _SOURCE_HOURS.items())))
def q_dq_freshness_sources(spark, sf):
    return suite.source_freshness(wh(spark, sf))


# The tests declared on the raw sources, written out by hand.
_SOURCE_TESTS = [
    ("unique", "raw_fx_rates", "fx_id"), ("not_null", "raw_fx_rates", "fx_id"), ("not_null", "raw_fx_rates", "date_cotation"),
    ("unique", "raw_comptes", "compte_id"), ("not_null", "raw_comptes", "compte_id"),
    ("unique", "raw_transactions", "transaction_id"), ("not_null", "raw_transactions", "transaction_id"),
    ("not_null", "raw_transactions", "tenant_id"), ("relationships", "raw_transactions", "tenant_id"),
    ("unique", "raw_virements", "virement_id"), ("not_null", "raw_virements", "virement_id"),
    ("unique", "raw_titulaires", "titulaire_id"), ("not_null", "raw_titulaires", "titulaire_id"),
    ("unique", "raw_compte_titulaires", "id"), ("not_null", "raw_compte_titulaires", "id"),
    ("not_null", "raw_compte_titulaires", "compte_id"), ("not_null", "raw_compte_titulaires", "titulaire_id")]
_SOURCE_COUNT = {
    "unique": "(SELECT count(*) FROM (SELECT 1 FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))",
    "not_null": "(SELECT count(*) FROM {t} WHERE {c} IS NULL)",
    "relationships": "(SELECT count(*) FROM {t} x ANTI JOIN raw_tenants p ON x.{c} = p.tenant_id WHERE x.{c} IS NOT NULL)"}


@register("dq_source_suite", O.model_query("SELECT *, CASE WHEN n_failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
    + " UNION ALL ".join(f"SELECT '{k}_{t}_{c}' AS test_name, '{t}' AS model, '{c}' AS column_name, 'error' AS severity, "
                         f"{_SOURCE_COUNT[k].format(t=t, c=c)} AS n_failures" for k, t, c in _SOURCE_TESTS) + ")"))
def q_dq_source_suite(spark, sf):
    return Q.run_suite(suite.source_checks(wh(spark, sf)))


@register("dq_tenant_sla", O.model_query(f"""
    SELECT t.tenant_id, t.tenant_code, t.sla_freshness_hours, l.max_loaded_at,
           round((epoch_us(TIMESTAMP '{_AS_OF_TS}') - epoch_us(l.max_loaded_at)) / 3600000000.0, 4) AS age_hours
    FROM stg_tenants t LEFT JOIN (SELECT tenant_id, max(_loaded_at) AS max_loaded_at FROM raw_transactions
                                  GROUP BY tenant_id) l ON t.tenant_id = l.tenant_id
    WHERE l.max_loaded_at IS NULL
       OR (epoch_us(TIMESTAMP '{_AS_OF_TS}') - epoch_us(l.max_loaded_at)) / 3600000000.0 > t.sla_freshness_hours"""))
def q_dq_tenant_sla(spark, sf):
    w = wh(spark, sf)
    return Q.tenant_sla(w.raw_transactions, w.stg_tenants, "_loaded_at", _AS_OF_TS)


@register("dq_nonempty", O.model_query(
    "SELECT 'raw_transactions' AS model, true AS is_empty FROM (SELECT count(*) AS n FROM raw_transactions) "
    "WHERE n = 0"))
def q_dq_nonempty(spark, sf):
    return Q.nonempty(wh(spark, sf).raw_transactions, "raw_transactions")


@register("dq_one_current", fx_sql("""
    SELECT coalesce(c.compte_id, s.compte_id) AS compte_id, coalesce(c.n_current, 0) AS n_current,
           s.compte_id IS NOT NULL AS in_source
    FROM (SELECT compte_id, CAST(sum(CASE WHEN dbt_valid_to IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_current
          FROM h3 GROUP BY compte_id) c
    FULL OUTER JOIN (SELECT DISTINCT compte_id FROM accounts_run3) s ON c.compte_id = s.compte_id
    WHERE coalesce(c.n_current, 0) > 1 OR (coalesce(c.n_current, 0) = 0 AND s.compte_id IS NOT NULL)""",
    _SNAP_CTES))
def q_dq_one_current(spark, sf):
    _, f = _fix(spark, sf)
    return Q.one_current(dims.dim_comptes_scd2(snapshot_runs(spark, sf, 3)), f.accounts_at(3))


_FX_SPINE = (f"DATE '{Params().fx_start}'", f"DATE '{Params().fx_end}'")


@register("dq_fx_recompute", O.model_query(f"""
    SELECT * FROM (
      SELECT f.transaction_id, f.devise, f.jour_transaction, f.montant, f.montant_eur,
             CAST(round(CAST(f.montant AS DECIMAL(38,2)) * CASE WHEN f.devise = 'EUR' AND f.jour_transaction >= {_FX_SPINE[0]} AND f.jour_transaction < {_FX_SPINE[1]} THEN 1
                             WHEN f.jour_transaction >= {_FX_SPINE[1]} THEN coalesce(s.taux_change_applique, 1)
                        ELSE coalesce(q.taux, s.taux_change_applique, 1) END, 2) AS DECIMAL(18,2))
               AS montant_eur_recalcule
      FROM fct_transactions f LEFT JOIN stg_transactions s ON f.transaction_id = s.transaction_id
      ASOF LEFT JOIN (SELECT * FROM stg_fx_rates WHERE taux IS NOT NULL AND devise_cible <> 'EUR'
          AND date_cotation >= {_FX_SPINE[0]} AND date_cotation < {_FX_SPINE[1]}) q
        ON f.devise = q.devise_cible AND f.jour_transaction >= q.date_cotation)
    WHERE abs(montant_eur - montant_eur_recalcule) > abs(montant_eur_recalcule) * 0.0001
       OR (montant_eur IS NULL) <> (montant_eur_recalcule IS NULL)"""))
def q_dq_fx_recompute(spark, sf):
    w = wh(spark, sf)
    return Q.fx_recompute(w.fct_transactions, w.stg_fx_rates, w.stg_transactions, w.params.fx_start, w.params.fx_end)


@register("dq_volume_anomaly", O.model_query("""
    SELECT jour, n, round(m, 6) AS moyenne, round(sd, 6) AS ecart_type,
           round(CASE WHEN sd > 0 THEN (n - m) / sd END, 6) AS z_score
    FROM (SELECT jour, n, avg(n) OVER w AS m, stddev_samp(n) OVER w AS sd
          FROM (SELECT CAST(d.jour AS DATE) AS jour, count(f.date_transaction) AS n
                FROM (SELECT unnest(generate_series(min(CAST(date_transaction AS DATE)),
                             max(CAST(date_transaction AS DATE)), INTERVAL 1 DAY)) AS jour FROM fct_transactions) d
                LEFT JOIN fct_transactions f ON CAST(f.date_transaction AS DATE) = CAST(d.jour AS DATE) GROUP BY 1)
          WINDOW w AS (ORDER BY jour - DATE '1970-01-01' RANGE BETWEEN 28 PRECEDING AND 1 PRECEDING))
    WHERE abs(round(CASE WHEN sd > 0 THEN (n - m) / sd END, 6)) > 3"""))
def q_dq_volume_anomaly(spark, sf):
    return Q.volume_anomaly(wh(spark, sf).fct_transactions, "date_transaction", 28, 3.0)


@register("dq_allocation_sum", O.model_query("""
    SELECT compte_id, somme_facteurs, nb_actifs FROM (
      SELECT compte_id, sum(allocation_factor) AS somme_facteurs,
             count(CASE WHEN is_active = true THEN 1 END) AS nb_actifs
      FROM bridge GROUP BY compte_id)
    WHERE nb_actifs > 0 AND abs(somme_facteurs - 1.0) > 0.000001"""))
def q_dq_allocation_sum(spark, sf):
    return Q.allocation_sum(wh(spark, sf).bridge_comptes_titulaires)


# --- bulk load (A1-A7) ---------------------------------------------------------------

from ledgerline import schemas as SCH  # noqa: E402
from ledgerline.plans import load_fixture as LF  # noqa: E402
from ledgerline.sources import loader  # noqa: E402

_LOAD_MEMO: dict[tuple[str, str, str], str] = {}


def _loaded(spark, sf, table: str, on_error: str = "continue") -> loader.LoadResult:
    k = (spark.sparkContext.applicationId, sf, table)
    if k not in _LOAD_MEMO:
        _LOAD_MEMO[k] = LF.build_load_fixture(RawTables(spark, sf), table)
    return loader.load_csv(spark, _LOAD_MEMO[k], SCH.RAW_SCHEMAS[table], LF.LOAD_TS,
                           on_error=on_error, repartition=spark.sparkContext.defaultParallelism)


@register("load_transactions", O.model_query(LF.expected_transactions_sql()))
def q_load_tx(spark, sf):
    return _loaded(spark, sf, "raw_transactions").good


@register("load_rejects", O.model_query(LF.expected_rejects_sql()))
def q_load_rejects(spark, sf):
    return _loaded(spark, sf, "raw_transactions").rejects.select("transaction_id", "_error_columns")


@register("load_abort_clean", O.model_query(
    "SELECT * EXCLUDE (_loaded_at), CAST('" + LF.LOAD_TS + "' AS TIMESTAMP) AS _loaded_at FROM raw_tenants"))
def q_load_abort(spark, sf):
    return _loaded(spark, sf, "raw_tenants", on_error="abort").good


_PLAIN_TABLES = [t for t in SCH.RAW_SCHEMAS if t != "raw_transactions"]


@register("load_row_counts", O.model_query(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _PLAIN_TABLES)
    + f" UNION ALL SELECT 'raw_transactions', count(*) FROM ({LF.expected_transactions_sql()}) t) ORDER BY table_name"))
def q_load_counts(spark, sf):
    return loader.load_row_counts({t: _loaded(spark, sf, t).good for t in SCH.RAW_SCHEMAS})


@register("load_history_totals", O.model_query(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_parsed, count(*) AS row_count, 0::BIGINT AS error_count FROM {t}"
        for t in _PLAIN_TABLES)
    + f" UNION ALL SELECT 'raw_transactions', (SELECT count(*) FROM raw_transactions), "
      f"(SELECT count(*) FROM ({LF.expected_transactions_sql()}) g), (SELECT count(*) FROM ({LF.expected_rejects_sql()}) r))"))
def q_load_history_totals(spark, sf):
    """The load history as appended to its table, read back, per raw table."""
    path = scratch_dir(spark, f"history-{uuid.uuid4().hex[:8]}")
    for t in SCH.RAW_SCHEMAS:
        loader.append_history(_loaded(spark, sf, t).history, t, path)
    return (loader.read_history(spark, path).groupBy("table_name")
            .agg(*[F.sum(c).alias(c) for c in ("row_parsed", "row_count", "error_count")]))


@register("load_history", None)
def q_load_history(spark, sf):
    return loader.failed_only(_loaded(spark, sf, "raw_transactions").history)


# --- generator, exports, audit, streaming (A12-A14, F10, K1) ------------------------

import datetime as _dt  # noqa: E402

from ledgerline.operators import audit  # noqa: E402
from ledgerline.sources import sinks  # noqa: E402
from ledgerline.streaming.stream_merge import stream_merge  # noqa: E402


def _kpi_sql() -> str:
    return REGISTRY["mart_tenant_kpis_daily"][1]


@register("export_tenant_kpis", f"SELECT * FROM ({_kpi_sql()}) k QUALIFY jour = max(jour) OVER ()")
def q_export_kpis(spark, sf):
    out = scratch_dir(spark, f"export-kpis-{uuid.uuid4().hex[:8]}")
    kpis = wh(spark, sf).mart_tenant_kpis_daily
    sinks.export_tenant_kpis(kpis, out)
    return spark.read.schema(kpis.schema).json(out).select(*kpis.columns)


@register("export_compliance", O.model_query("""
    SELECT tenant_id, transaction_id, compte_id, date_transaction, montant, devise, montant_eur, aml_flag,
           aml_score, fraud_score, is_flagged_for_review, statut
    FROM fct_transactions WHERE aml_flag <> 'clean'"""))
def q_export_compliance(spark, sf):
    out = scratch_dir(spark, f"export-aml-{uuid.uuid4().hex[:8]}")
    fact = wh(spark, sf).fct_transactions
    sinks.export_compliance_report(fact, out)
    kind = sinks.compliance_extract(fact).schema
    files = T.StructType([f for f in kind if f.name != "tenant_id"] + [kind["tenant_id"]])  # CSV goes by position
    return spark.read.schema(files).option("header", True).csv(out).select(*kind.names)


_RUN_ID = "run-0001"


@register("run_audit", fx_sql(f"""
    SELECT '{_RUN_ID}' AS run_id, 'fct_transactions' AS model, 'pre' AS phase, count(*) AS row_count FROM fct_t
    UNION ALL SELECT '{_RUN_ID}', 'fct_transactions', 'post', count(*) FROM merged""", _lookback_ctes()))
def q_run_audit(spark, sf):
    w, f = _fix(spark, sf)
    started = _dt.datetime(2000, 1, 5, 6, 0, 0)
    norm = facts.int_transactions_normalisees(staging.stg_transactions(f.tx_cut()), w.stg_comptes,
                                              w.stg_categories)
    before = w.fact_from(norm)
    after = incremental_fact_run(w, f.tx_cut(), f.tx_v2(), 7)
    rows = (audit.audit_row(spark, before, _RUN_ID, "fct_transactions", "pre", "inv-1", "dev", started)
            .unionByName(audit.audit_row(spark, after, _RUN_ID, "fct_transactions", "post", "inv-1",
                                         "dev", started)))
    path = scratch_dir(spark, f"audit-{uuid.uuid4().hex[:8]}")
    audit.append_audit(rows, path)
    return spark.read.parquet(path).select("run_id", "model", "phase", "row_count")


@register("stream_merge", REGISTRY["merge_upsert"][1])
def q_stream_merge(spark, sf):
    _, f = _fix(spark, sf)
    base = scratch_dir(spark, f"stream-{uuid.uuid4().hex[:8]}")
    month = F.trunc(F.col("date_transaction"), "MM").alias("_mois")
    target = staging.stg_transactions(f.tx_cut())
    tables.write_table(target.select("*", month), f"{base}/table", ["_mois"], ["transaction_id"])
    delta = staging.stg_transactions(f.tx_delta())
    delta.repartition(3).write.mode("overwrite").parquet(f"{base}/input")
    stream_merge(spark, f"{base}/input", delta.schema, f"{base}/table", "transaction_id", "_mois",
                 FX.STG_TX_UPDATE, f"{base}/_checkpoint", max_files_per_trigger=1,
                 prepare=lambda b: b.select("*", F.trunc(F.col("date_transaction"), "MM").alias("_mois")))
    return tables.read_table(spark, f"{base}/table").select(*STG_TX)


# --- options of the quirks and small operators (Q5, Q14, Q16, A10) -----------------

@register("mart_solde_join_tenant", O.with_models("""
    SELECT f.tenant_id, f.compte_id, f.jour, f.flux_transactions, f.flux_virements,
           CAST(f.flux_transactions + f.flux_virements AS DECIMAL(18,2)) AS flux_total_jour,
           CAST(c.solde_initial + sum(f.flux_transactions + f.flux_virements) OVER (
                PARTITION BY f.compte_id ORDER BY f.jour, f.tenant_id, f.flux_transactions, f.flux_virements
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS solde_cumule_eur
    FROM flows f JOIN dim_comptes c ON f.compte_id = c.compte_id""", *O.ALL_MODELS, _FLOWS_TENANT))
def q_solde_join_tenant(spark, sf):
    w = wh(spark, sf)
    return marts.mart_solde_journalier(w.fct_transactions, w.fct_virements, w.dim_comptes,
                                       join_tenant=True)


@register("dim_categories_orphans", O.model_query(
    "SELECT * FROM stg_categories WHERE categorie_id NOT IN (SELECT categorie_id FROM cat_tree)"))
def q_orphans(spark, sf):
    from ledgerline.operators.hierarchy import unreachable_nodes
    w = wh(spark, sf)
    return unreachable_nodes(w.stg_categories, w.dim_categories)


@register("dq_fx_unique", O.model_query(
    "SELECT devise_cible, date_cotation, count(*) AS n_records FROM stg_fx_rates "
    "GROUP BY devise_cible, date_cotation HAVING count(*) > 1"))
def q_fx_unique(spark, sf):
    return Q.unique(wh(spark, sf).stg_fx_rates, "devise_cible", "date_cotation")


@register("sql_tenant_totals", O.model_query("""
    SELECT tenant_code, CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions,
           CAST(sum(volume_net_eur) AS DECIMAL(18,2)) AS volume_net_eur
    FROM (SELECT a.*, t.tenant_code FROM (
            SELECT tenant_id, count(*) AS nb_transactions,
                   CAST(sum(CASE WHEN type_operation = 'credit' AND statut = 'validee' THEN montant_eur ELSE 0 END)
                      - sum(CASE WHEN type_operation = 'debit' AND statut = 'validee' THEN montant_eur ELSE 0 END)
                        AS DECIMAL(18,2)) AS volume_net_eur
            FROM fct_transactions GROUP BY tenant_id, jour_transaction) a
          LEFT JOIN dim_tenants t ON a.tenant_id = t.tenant_id)
    GROUP BY tenant_code"""))
def q_sql_totals(spark, sf):
    """A10: models as temp views, queried with spark.sql."""
    w = wh(spark, sf)
    w.register_views(["mart_tenant_kpis_daily"])
    return spark.sql("""
        SELECT tenant_code, CAST(sum(nb_transactions) AS BIGINT) AS nb_transactions,
               CAST(sum(volume_net_eur) AS DECIMAL(18,2)) AS volume_net_eur
        FROM mart_tenant_kpis_daily GROUP BY tenant_code""")


REGISTRY["merge_touch_loaded_at"] = (REGISTRY["merge_touch_loaded_at"][0],
                                     fx_sql("SELECT * FROM merged", _lookback_ctes(["_loaded_at"])))
REGISTRY["merge_delete_unqualified"] = (REGISTRY["merge_delete_unqualified"][0],
                                        fx_sql("SELECT * FROM merged_del",
                                               _lookback_ctes(["_loaded_at"], delete=True)))


# --- stored tables, read back (F1, F5, F6, F11) ---------------------------------------

def _stored_stg(spark, f) -> str:
    """Staging transactions of the first cut as a stored table by month; other
    rows than debits have no month."""
    path = f"{scratch_dir(spark, f'stored-{uuid.uuid4().hex[:8]}')}/stg_transactions"
    tables.write_table(_by_month(staging.stg_transactions(f.tx_cut())), path, ["mois"], ["transaction_id"])
    return path


def _by_month(stg: DataFrame) -> DataFrame:
    month = trunc_date("month", "date_transaction")
    return stg.withColumn("mois", F.when(F.col("type_operation") == "debit", month))


_MOIS = "CASE WHEN type_operation = 'debit' THEN CAST(date_trunc('month', date_transaction) AS DATE) END AS mois"
_STORED_CTES = {**_MERGE_CTES, "t_m": f"SELECT *, {_MOIS} FROM stg_t", "d_m": f"SELECT *, {_MOIS} FROM stg_d"}
_STG_M = [*STG_TX, "mois"]


@register("stored_upsert_null_month", fx_sql(
    O.merge_sql("t_m", "d_m", ["transaction_id"], _STG_M, _STG_M, FX.STG_TX_UPDATE), _STORED_CTES))
def q_stored_null_month(spark, sf):
    """Upsert into a table some of whose partition values are null."""
    _, f = _fix(spark, sf)
    path = _stored_stg(spark, f)
    tables.upsert_table(spark, path, _by_month(staging.stg_transactions(f.tx_delta())), "transaction_id", "mois",
                        FX.STG_TX_UPDATE, ["transaction_id"])
    return tables.read_table(spark, path)


@register("stored_upsert_moved_month", fx_sql(
    O.merge_sql("t_m", "d_moved", ["transaction_id"], _STG_M, _STG_M, FX.STG_TX_UPDATE),
    {**_STORED_CTES, "d_moved": "SELECT * REPLACE (CAST(mois + INTERVAL 1 MONTH AS DATE) AS mois) FROM d_m"}))
def q_stored_moved(spark, sf):
    """Known keys that come with another month stay one row, where they were."""
    _, f = _fix(spark, sf)
    path = _stored_stg(spark, f)
    delta = _by_month(staging.stg_transactions(f.tx_delta())).withColumn("mois", F.add_months("mois", 1))
    tables.upsert_table(spark, path, delta, "transaction_id", "mois", FX.STG_TX_UPDATE, ["transaction_id"])
    return tables.read_table(spark, path)


@register("stored_upsert_new_column", fx_sql(
    O.merge_sql("step1", "d_plain", ["transaction_id"], [*_STG_M, "canal_detail"], [*_STG_M, "canal_detail"],
                [*FX.STG_TX_UPDATE]),
    {**_STORED_CTES, "d_new": "SELECT *, canal || '/' || moyen_paiement AS canal_detail FROM d_m",
     "step1": O.merge_sql("t_m", "d_new", ["transaction_id"], _STG_M, [*_STG_M, "canal_detail"],
                          [*FX.STG_TX_UPDATE, "canal_detail"]),
     "d_plain": "SELECT *, CAST(NULL AS VARCHAR) AS canal_detail FROM d_m"}))
def q_stored_new_column(spark, sf):
    """A column that one upsert adds survives a later one that lacks it."""
    _, f = _fix(spark, sf)
    path = _stored_stg(spark, f)
    delta = _by_month(staging.stg_transactions(f.tx_delta()))
    wider = delta.withColumn("canal_detail", F.concat(F.col("canal"), F.lit("/"), F.col("moyen_paiement")))
    tables.upsert_table(spark, path, wider, "transaction_id", "mois", [*FX.STG_TX_UPDATE, "canal_detail"])
    tables.upsert_table(spark, path, delta, "transaction_id", "mois", FX.STG_TX_UPDATE)
    return tables.read_table(spark, path)


@register("stored_upsert_delete", fx_sql(
    "SELECT * FROM up WHERE transaction_id NOT IN (SELECT transaction_id FROM stg_d WHERE statut = 'rejetee')",
    {**_STORED_CTES, "up": O.merge_sql("t_m", "d_m", ["transaction_id"], _STG_M, _STG_M, FX.STG_TX_UPDATE)}))
def q_stored_delete(spark, sf):
    """An upsert that also removes the keys whose new version is rejected."""
    _, f = _fix(spark, sf)
    path = _stored_stg(spark, f)
    delta = _by_month(staging.stg_transactions(f.tx_delta()))
    tables.upsert_table(spark, path, delta, "transaction_id", "mois", FX.STG_TX_UPDATE, ["transaction_id"],
                        delete_keys=delta.where("statut = 'rejetee'").select("transaction_id"))
    return tables.read_table(spark, path)


@register("stored_microbatch", fx_sql(
    f"SELECT * FROM ev_fct_t WHERE NOT ({_EV_DAY}) UNION ALL "
    f"SELECT * FROM ev_fct_s WHERE {_EV_DAY} AND jour_transaction <> DATE '{FX.MICROBATCH_START}'",
    {"ev_stg_t": O.stg_tx_sql(f"(SELECT * FROM raw_event_transactions WHERE date_transaction < "
                              f"TIMESTAMP '{FX.MICROBATCH_TARGET_END} 00:00:00')"),
     "ev_norm_t": O.norm_sql("ev_stg_t"), "ev_fct_t": O.fact_sql("ev_norm_t"),
     "ev_stg_s": O.stg_tx_sql("events_altered"), "ev_norm_s": O.norm_sql("ev_stg_s"),
     "ev_fct_s": O.fact_sql("ev_norm_s")}))
def q_stored_microbatch(spark, sf):
    """Day batches replaced in the stored table; the first day of the range,
    of which the source has no row, is emptied."""
    w, f = _fix(spark, sf)
    path = f"{scratch_dir(spark, f'micro-{uuid.uuid4().hex[:8]}')}/fct"
    fact_of = lambda raw: w.fact_from(facts.int_transactions_normalisees(
        staging.stg_transactions(raw), w.stg_comptes, w.stg_categories))
    before = F.col("date_transaction") < F.lit(f"{FX.MICROBATCH_TARGET_END} 00:00:00").cast("timestamp_ntz")
    tables.write_table(fact_of(w.raw.event_transactions().where(before)), path, ["jour_transaction"])
    source = fact_of(f.events_altered()).where(F.col("jour_transaction") != F.lit(FX.MICROBATCH_START).cast("date"))
    batch = inc.replace_batches(None, source, "date_transaction", FX.MICROBATCH_START, FX.MICROBATCH_END)
    tables.replace_days(batch, path, "jour_transaction", FX.MICROBATCH_START, FX.MICROBATCH_END)
    return tables.read_table(spark, path)


_MICRO_CTES = {
    "ev_stg_t": O.stg_tx_sql(f"(SELECT * FROM raw_event_transactions WHERE date_transaction < "
                             f"TIMESTAMP '{FX.MICROBATCH_TARGET_END} 00:00:00')"),
    "ev_norm_t": O.norm_sql("ev_stg_t"), "ev_fct_t": O.fact_sql("ev_norm_t"),
    "ev_stg_s": O.stg_tx_sql("events_altered"), "ev_norm_s": O.norm_sql("ev_stg_s"), "ev_fct_s": O.fact_sql("ev_norm_s")}


_STORED_MICRO = REGISTRY["stored_microbatch"][1]


def _micro_table(spark, w) -> str:
    """The fact of the events before the second load, by day."""
    path = f"{scratch_dir(spark, f'micro-{uuid.uuid4().hex[:8]}')}/fct"
    before = F.col("date_transaction") < F.lit(f"{FX.MICROBATCH_TARGET_END} 00:00:00").cast("timestamp_ntz")
    target = w.fact_from(facts.int_transactions_normalisees(
        staging.stg_transactions(w.raw.event_transactions().where(before)), w.stg_comptes, w.stg_categories))
    tables.write_table(target, path, ["jour_transaction"], watermark_col="_loaded_at")
    return path


def _micro_batch(f, w) -> DataFrame:
    """The days that the second load brings, without the first of them."""
    source = w.fact_from(facts.int_transactions_normalisees(
        staging.stg_transactions(f.events_altered()), w.stg_comptes, w.stg_categories))
    return inc.replace_batches(None, source.where(F.col("jour_transaction") != F.lit(FX.MICROBATCH_START).cast("date")),
                               "date_transaction", FX.MICROBATCH_START, FX.MICROBATCH_END)


@register("stored_days_new_column", _STORED_MICRO.replace(
    "SELECT * FROM ev_fct_t WHERE", "SELECT *, CAST(NULL AS VARCHAR) AS canal_detail FROM ev_fct_t WHERE").replace(
    "SELECT * FROM ev_fct_s WHERE", "SELECT *, canal || '/' || moyen_paiement AS canal_detail FROM ev_fct_s WHERE"))
def q_stored_days_new_column(spark, sf):
    """Replaced days bring a column that the table didn't have."""
    w, f = _fix(spark, sf)
    path = _micro_table(spark, w)
    batch = _micro_batch(f, w).withColumn("canal_detail", F.concat(F.col("canal"), F.lit("/"), F.col("moyen_paiement")))
    tables.replace_days(batch, path, "jour_transaction", FX.MICROBATCH_START, FX.MICROBATCH_END)
    return tables.read_table(spark, path)


@register("stored_days_watermark", fx_sql("SELECT max(_loaded_at) AS high FROM after_days", {
    **_MICRO_CTES, "after_days": f"SELECT * FROM ev_fct_t WHERE NOT ({_EV_DAY}) UNION ALL SELECT * FROM ev_fct_s WHERE {_EV_DAY} "
                                 f"AND jour_transaction <> DATE '{FX.MICROBATCH_START}'"}))
def q_stored_days_watermark(spark, sf):
    """The recorded watermark after days were replaced."""
    w, f = _fix(spark, sf)
    path = _micro_table(spark, w)
    tables.replace_days(_micro_batch(f, w), path, "jour_transaction", FX.MICROBATCH_START, FX.MICROBATCH_END)
    return spark.createDataFrame([(tables.table_watermark(spark, path, "_loaded_at"),)], "high timestamp_ntz")


@register("microbatch_two_runs", fx_sql(f"""
    SELECT * FROM ev_all WHERE jour_transaction BETWEEN DATE '{FX.LEDGER_BEGIN}' AND DATE '{FX.LEDGER_RUNS[1]}'
      AND NOT (transaction_id % 9 = 0 AND jour_transaction = DATE '{FX.LEDGER_LATE[1]}')""",
    {"ev_stg": O.stg_tx_sql("raw_event_transactions"), "ev_norm": O.norm_sql("ev_stg"), "ev_all": O.fact_sql("ev_norm")}))
def q_microbatch_two_runs(spark, sf):
    """Two runs of the day ledger. Rows that come late lie two and five days
    before the second run's last day: its lookback of three takes the first
    ones in, the others stay out."""
    w, _ = _fix(spark, sf)
    path = f"{scratch_dir(spark, f'ledger-{uuid.uuid4().hex[:8]}')}/fct"
    events = w.raw.event_transactions()
    late = (F.col("transaction_id") % 9 == 0) & F.col("date_transaction").cast("date").isin(
        *[F.lit(d).cast("date") for d in FX.LEDGER_LATE])
    build = lambda raw: w.fact_from(facts.int_transactions_normalisees(
        staging.stg_transactions(raw), w.stg_comptes, w.stg_categories))
    for source, through in zip((events.where(~late), events), FX.LEDGER_RUNS, strict=True):
        ran = microbatch.run_microbatch(spark, path, source, build, "date_transaction", "jour_transaction", through,
                                        FX.LEDGER_BEGIN, watermark_col="_loaded_at")
        if failed := [b for b in ran if b.error]:
            raise RuntimeError(failed[0].error)
    return tables.read_table(spark, path)


def _indexed_stg(spark, f) -> str:
    """As ``_stored_stg``, with a key index (some sixteen ranges at sf0.01)."""
    path = f"{scratch_dir(spark, f'stored-{uuid.uuid4().hex[:8]}')}/stg_transactions"
    tables.write_table(_by_month(staging.stg_transactions(f.tx_cut())), path, ["mois"], ["transaction_id"],
                       ["transaction_id"], key="transaction_id", key_bits=12)
    return path


@register("stored_upsert_key_index", REGISTRY["stored_upsert_delete"][1])
def q_stored_key_index(spark, sf):
    """An upsert with deletions whose keys are looked up in the key index;
    the table is read back through the partitions that the index names."""
    _, f = _fix(spark, sf)
    path = _indexed_stg(spark, f)
    delta = _by_month(staging.stg_transactions(f.tx_delta()))
    tables.upsert_table(spark, path, delta, "transaction_id", "mois", FX.STG_TX_UPDATE,
                        delete_keys=delta.where("statut = 'rejetee'").select("transaction_id"))
    return tables.read_table(spark, path)


@register("stored_point_lookup", O.model_query(f"SELECT * FROM fct_transactions WHERE transaction_id = {LOOKUP_TRANSACTION_ID}"))
def q_stored_point_lookup(spark, sf):
    """H2 on the stored fact: the key index names the partition to read."""
    path = f"{scratch_dir(spark, f'lookup-{uuid.uuid4().hex[:8]}')}/fct"
    tables.write_table(wh(spark, sf).fct_transactions, path, ["mois_transaction"], ["tenant_id", "transaction_id"],
                       ["transaction_id"], key="transaction_id")
    return tables.lookup(spark, path, LOOKUP_TRANSACTION_ID)


@register("stored_snapshot_three_runs", REGISTRY["snapshot_three_runs"][1])
def q_stored_snapshot(spark, sf):
    """Three runs into a stored history that only grows, read from storage."""
    _, f = _fix(spark, sf)
    path = f"{scratch_dir(spark, f'history-{uuid.uuid4().hex[:8]}')}/snapshot_comptes"
    for r in (1, 2, 3):
        history.run_snapshot(spark, path, f.accounts_at(r), "compte_id", FX.SNAPSHOT_CHECK, FX.SNAPSHOT_TIMES[r - 1])
    return history.read_history(spark, path)


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
