"""Dimensions and the account-holder bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import day_diff, surrogate_key, ts_text


def dim_tenants(stg_tenants: DataFrame, as_of) -> DataFrame:
    """Tenants + days of partnership at ``as_of`` (a parameter, never the
    wall clock, so results repeat)."""
    return stg_tenants.select(
        "tenant_id", "tenant_code", "tenant_name", "country_code", "devise_locale",
        "date_onboarding", "sla_freshness_hours", "contract_tier", "is_active",
        day_diff("date_onboarding", F.lit(as_of).cast("date")).alias("anciennete_partenariat_jours"))


def activity_segment(days) -> "F.Column":
    """<=30 tres_actif, <=90 actif, <=365 dormant, else (NULL too) inactif."""
    return (F.when(days <= 30, F.lit("très_actif"))
            .when(days <= 90, F.lit("actif"))
            .when(days <= 365, F.lit("dormant"))
            .otherwise(F.lit("inactif")))


def dim_comptes(stg_comptes: DataFrame, dim_ten: DataFrame, as_of) -> DataFrame:
    """Current account dimension. The tenant side is a few rows, which
    the planner broadcasts; were it large, AQE would split a hot tenant."""
    t = dim_ten.select(F.col("tenant_id").alias("_t_tenant_id"), "tenant_code", "tenant_name")
    today = F.lit(as_of).cast("date")
    j = stg_comptes.join(t, stg_comptes["tenant_id"] == t["_t_tenant_id"], "left")
    inactivity = day_diff("date_derniere_activite", today)
    return j.select(
        "compte_id", "tenant_id", "tenant_code", "tenant_name", "numero_compte", "iban", "bic",
        "nom_client", "prenom_client", "email", "type_compte", "devise", "solde_initial",
        "solde_actuel", "date_ouverture", "date_derniere_activite", "statut", "kyc_level",
        "aml_flag", "customer_segment", "is_pep", "risk_score", "pays", "preferred_language",
        day_diff("date_ouverture", today).alias("anciennete_jours"),
        inactivity.alias("jours_depuis_activite"),
        activity_segment(inactivity).alias("segment_activite"),
    )


SCD2_COLUMNS = ["compte_id", "tenant_id", "numero_compte", "iban", "email", "nom_client",
                "prenom_client", "type_compte", "devise", "statut", "kyc_level",
                "kyc_date_verification", "aml_flag", "customer_segment", "is_pep", "risk_score"]


def dim_comptes_scd2(snapshot: DataFrame) -> DataFrame:
    """One row per account version with validity, current flag and a
    version number by account. The window's partitions are one account's
    versions (a handful of rows), so a hot account cannot skew it."""
    w = Window.partitionBy("compte_id").orderBy("dbt_valid_from")
    return snapshot.select(
        surrogate_key("compte_id", ts_text("dbt_valid_from")).alias("dim_compte_sk"),
        *SCD2_COLUMNS,
        F.col("dbt_valid_from").alias("date_debut_validite"),
        F.col("dbt_valid_to").alias("date_fin_validite"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
        F.row_number().over(w).cast("bigint").alias("version_number"),
        "updated_at",
    )


def bridge_comptes_titulaires(stg_links: DataFrame) -> DataFrame:
    """Links + is_primary + allocation_factor (0 when inactive, else
    1/number of active links; a NULL flag takes the 1/n branch).

    The active-link count is a windowed count by account: one shuffle on
    ``compte_id`` instead of an aggregate joined back."""
    w = Window.partitionBy("compte_id")
    n_active = F.count(F.when(F.col("is_active") == F.lit(True), F.lit(1))).over(w)
    factor = (F.when(F.col("is_active") == F.lit(False), F.lit(0.0))
              .otherwise(F.lit(1.0) / F.nullif(n_active, F.lit(0)).cast("double")))
    return stg_links.select(
        F.col("id").alias("bridge_id"), "compte_id", "titulaire_id", "type_relation",
        "date_debut", "date_fin", "is_active",
        (F.col("type_relation") == "principal").alias("is_primary"),
        factor.alias("allocation_factor"),
        "_loaded_at",
    )


def holder_shares(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """Each account's EUR volume split between its active holders, in cents
    that add up to it: what is left after equal shares goes cent by cent to
    the first holders by id (the largest remainders, which are equal here).

    Amounts are first summed per account (map-side partial aggregation), so
    the join with the bridge carries one row per account, not per
    transaction. Inactive links get 0; a link of unknown state gets the equal
    share, rounded (half up), beside the split; no active link, no share."""
    per_acct = fact.groupBy("compte_id").agg(F.sum("montant_eur").alias("_total"))
    active = F.col("is_active") == F.lit(True)
    holders = Window.partitionBy("compte_id")
    b = bridge.select(
        F.col("compte_id").alias("_b_compte_id"), "titulaire_id", "is_active", "allocation_factor",
        F.count(F.when(active, F.lit(1))).over(holders).alias("_n"),
        F.row_number().over(holders.orderBy(F.coalesce(active, F.lit(False)).desc(), "titulaire_id", "bridge_id")).alias("_k"))
    cents = F.abs(F.col("_total") * 100).cast("bigint")
    own = F.expr("div(_cents, nullif(_n, 0))") + (F.col("_k") <= F.col("_cents") % F.nullif(F.col("_n"), F.lit(0))).cast("bigint")
    share = (F.when(F.col("is_active") == F.lit(False), F.lit(0).cast("decimal(18,2)"))
             .when(active, F.signum("_total").cast("bigint") * own * F.lit(0.01).cast("decimal(3,2)"))
             .otherwise(F.round(F.col("_total") / F.nullif(F.col("_n"), F.lit(0)), 2)))
    j = per_acct.join(b, per_acct["compte_id"] == b["_b_compte_id"], "inner").withColumn("_cents", cents)
    return j.select("compte_id", "titulaire_id", "is_active", F.col("_total").cast("decimal(18,2)").alias("montant_compte_eur"),
                    share.cast("decimal(18,2)").alias("part_eur"))


def holder_allocation(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """What each holder has of the volumes of its accounts."""
    return (holder_shares(fact, bridge).groupBy("titulaire_id")
            .agg(F.count("part_eur").alias("nb_comptes"),
                 F.sum("part_eur").cast("decimal(18,2)").alias("montant_alloue_eur")))
