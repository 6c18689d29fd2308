"""Enrichment and facts.

Join strategy: accounts, categories and FX rates are left joins whose strategy
is the planner's. A side whose size it knows to be under the broadcast
threshold (a stored dimension, or one that AQE measured) is broadcast and the
transactions stay where they are; a larger one is shuffled, and AQE's skew-join
splits a hot account, category or (day, currency).
The fact's row filter (``statut``, ``is_reversal``) is written before the joins
so it is applied in the scan stage, not after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import trunc_date


def int_transactions_normalisees(stg_tx: DataFrame, stg_comptes: DataFrame,
                                 stg_categories: DataFrame) -> DataFrame:
    """Transactions + account attributes + category labels + calendar keys."""
    comptes = stg_comptes.select(
        F.col("compte_id").alias("_c_compte_id"), "type_compte",
        F.col("devise").alias("devise_compte"), "customer_segment",
        F.col("pays").alias("pays_compte"), "kyc_level", "is_pep")
    cats = stg_categories.select(F.col("categorie_id").alias("_k_categorie_id"), "nom_categorie",
                                 "type_categorie", "groupe")
    out = (stg_tx
           .join(comptes, stg_tx["compte_id"] == comptes["_c_compte_id"], "left")
           .join(cats, stg_tx["categorie_id"] == cats["_k_categorie_id"], "left"))
    return out.select(
        *[stg_tx[c] for c in stg_tx.columns],
        "type_compte", "devise_compte", "customer_segment", "pays_compte", "kyc_level",
        "is_pep", "nom_categorie", "type_categorie", "groupe",
        trunc_date("month", "date_transaction").alias("mois_transaction"),
        trunc_date("week", "date_transaction").alias("semaine_transaction"),
        trunc_date("day", "date_transaction").alias("jour_transaction"),
    )


FACT_STATUSES = ("validee", "en_attente")


def keep_fact_rows(df: DataFrame) -> DataFrame:
    """E1 row filter: kept statuses, non-reversal (NULL reversal flag dropped)."""
    return df.where(F.col("statut").isin(*FACT_STATUSES) & (F.col("is_reversal") == F.lit(False)))


def fct_transactions(normalised: DataFrame, fx_side: DataFrame, fx_mode: str = "multiply",
                     apply_filter: bool = True) -> DataFrame:
    """The transaction fact (43 columns).

    ``montant_eur`` is recomputed from the densified FX table:
    round(montant * coalesce(fx rate, source rate, 1), 2). With the default
    ``fx_mode='multiply'`` the EUR->X quote multiplies, as the reference does;
    ``'divide'`` converts the other way.
    """
    b = keep_fact_rows(normalised) if apply_filter else normalised
    j = b.join(fx_side, (b["jour_transaction"] == fx_side["date_cotation"])
               & (b["devise"] == fx_side["fx_devise"]), "left")
    rate = F.coalesce(F.col("taux"), F.col("taux_change_applique"), F.lit(1).cast("decimal(18,8)"))
    if fx_mode == "multiply":
        eur = F.round(F.col("montant") * rate, 2)
    elif fx_mode == "divide":
        eur = F.round(F.col("montant") / rate, 2)
    else:
        raise ValueError(fx_mode)
    return j.select(
        "transaction_id", "external_transaction_id", "tenant_id", "compte_id", "categorie_id",
        "date_transaction", "jour_transaction", "semaine_transaction", "mois_transaction",
        "date_valeur", "date_settlement",
        "montant", "devise", eur.cast("decimal(18,2)").alias("montant_eur"),
        "montant_signe", "montant_signe_eur", "frais", "montant_net",
        "type_operation", "sens", "statut", "moyen_paiement", "canal",
        "type_compte", "customer_segment", "pays_compte", "nom_categorie", "type_categorie",
        "groupe",
        "marchand_nom", "marchand_categorie", "marchand_pays", "marchand_mcc",
        "aml_score", "aml_flag", "fraud_score", "is_flagged_for_review",
        "is_reconciled", "reconciliation_batch_id",
        "source_system", "created_at", "updated_at", "_loaded_at",
    )


def with_net_of_tax(fact: DataFrame, vat: str = "1.20") -> DataFrame:
    """fct_transactions_v2 = fact + montant_hors_taxes (debits net of 20% VAT)."""
    ht = F.when(F.col("type_operation") == "debit",
                F.round(F.col("montant_eur") / F.lit(vat).cast("decimal(3,2)"), 2)
                ).otherwise(F.col("montant_eur"))
    return fact.withColumn("montant_hors_taxes", ht.cast("decimal(18,2)"))


def fct_virements(stg_vir: DataFrame) -> DataFrame:
    """E5: double entry. One scan; each executed transfer becomes an outgoing
    leg on the source account (-amount) and an incoming leg on the destination
    (+amount) via a two-element generator, not a self-union."""
    legs = F.array(
        F.struct(F.col("compte_source_id").alias("compte_id"),
                 F.col("compte_dest_id").alias("contrepartie_compte_id"),
                 F.lit("sortant").alias("virement_leg"),
                 (-F.col("montant")).alias("montant_signe")),
        F.struct(F.col("compte_dest_id").alias("compte_id"),
                 F.col("compte_source_id").alias("contrepartie_compte_id"),
                 F.lit("entrant").alias("virement_leg"),
                 F.col("montant").alias("montant_signe")),
    )
    exploded = (stg_vir.where(F.col("statut") == "execute")
                .select("virement_id", "tenant_id", "montant", "devise", "date_virement",
                        "statut", "_loaded_at", F.inline(legs)))
    return exploded.select("virement_id", "tenant_id", "compte_id", "contrepartie_compte_id",
                           "virement_leg", "montant_signe", "montant", "devise",
                           "date_virement", "statut", "_loaded_at")
