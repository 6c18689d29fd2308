"""Staging projections (B1-B9): typed, case-normalised views of the raw tables.

All of these are narrow projections / filters, so they fuse into the scan's
whole-stage-codegen span and Catalyst prunes whatever a consumer does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import RAW_TRANSACTIONS
from ledgerline.functions.columns import signed, surrogate_key


def stg_tenants(raw: DataFrame) -> DataFrame:
    return raw.select("tenant_id", "tenant_code", "tenant_name", "country_code", "devise_locale",
                      "date_onboarding", "sla_freshness_hours", "contract_tier", "is_active",
                      "_loaded_at")


def stg_categories(raw: DataFrame) -> DataFrame:
    # `is_active = true` drops NULL flags as well.
    return (raw.where(F.col("is_active") == F.lit(True))
            .select("categorie_id", "nom_categorie", "type_categorie", "groupe",
                    "categorie_parent_id", "niveau_hierarchique", "is_active", "date_creation"))


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    return raw.select("fx_id", "devise_source", "devise_cible", "date_cotation", "taux",
                      "source_provider")


def stg_comptes(raw: DataFrame) -> DataFrame:
    return raw.select(
        "compte_id", "tenant_id", "numero_compte", "iban", "bic",
        surrogate_key("nom_client", "prenom_client").alias("client_hash"),
        "nom_client", "prenom_client", "email", "telephone", "date_naissance",
        "adresse_ligne1", "adresse_ligne2", "code_postal", "ville",
        F.upper("pays").alias("pays"),
        F.lower("type_compte").alias("type_compte"),
        F.upper("devise").alias("devise"),
        "solde_initial", "solde_actuel", "date_ouverture", "date_derniere_activite",
        F.lower("statut").alias("statut"),
        "kyc_level", "kyc_date_verification", "aml_flag", "customer_segment",
        "preferred_language", "consent_marketing", "consent_data_sharing", "is_pep",
        "risk_score", "created_at", "updated_at", "created_by_source_system", "_loaded_at",
    )


# Columns of stg_transactions, in output order. Entries that are not plain
# column names are built in `stg_transactions`.
_TX_UPPER = ("devise", "frais_devise", "marchand_pays")
_TX_LOWER = ("type_operation", "sens", "moyen_paiement", "canal", "statut")
_TX_TS = ("date_transaction", "date_valeur", "date_comptabilisation", "date_reception",
          "date_traitement", "date_settlement")

# Fixed output contract: the raw columns in their order, the signed amounts
# behind ``sens``.
STG_TRANSACTIONS_COLUMNS = [c for name, _ in RAW_TRANSACTIONS
                            for c in ([name, "montant_signe", "montant_signe_eur"] if name == "sens" else [name])]


def _tx_column(name: str) -> Column:
    if name in _TX_UPPER:
        return F.upper(name).alias(name)
    if name in _TX_LOWER:
        return F.lower(name).alias(name)
    if name in _TX_TS:
        return F.col(name).cast("timestamp_ntz").alias(name)
    if name == "frais":
        return F.coalesce(F.col("frais"), F.lit(0).cast("decimal(10,2)")).alias("frais")
    if name == "montant_signe":
        return signed(F.lower("type_operation"), F.col("montant")).alias(name)
    if name == "montant_signe_eur":
        return signed(F.lower("type_operation"), F.col("montant_eur")).alias(name)
    return F.col(name)


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Typed projection, test rows removed (`is_test = false` also
    drops NULL flags), signed amounts (anything but credit/debit -> NULL)."""
    return (raw.where(F.col("is_test") == F.lit(False))
            .select(*[_tx_column(c) for c in STG_TRANSACTIONS_COLUMNS]))


def stg_virements(raw: DataFrame) -> DataFrame:
    return raw.select(
        "virement_id", "tenant_id", "compte_source_id", "compte_dest_id", "montant",
        F.upper("devise").alias("devise"),
        F.col("date_virement").cast("timestamp_ntz").alias("date_virement"),
        F.col("date_execution").cast("timestamp_ntz").alias("date_execution"),
        "motif", "reference",
        F.lower("statut").alias("statut"),
        F.lower("type_virement").alias("type_virement"),
        F.coalesce(F.col("frais"), F.lit(0).cast("decimal(10,2)")).alias("frais"),
        "created_at", "updated_at", "_loaded_at",
    )


def stg_titulaires(raw: DataFrame) -> DataFrame:
    return raw.select("titulaire_id", "nom", "prenom", "email", "telephone", "date_naissance",
                      "nationalite", "pays_residence", "type_titulaire_defaut", "is_active",
                      "created_at", "_loaded_at")


def stg_compte_titulaires(raw: DataFrame) -> DataFrame:
    return raw.select("id", "compte_id", "titulaire_id", "type_relation", "date_debut",
                      "date_fin", "is_active", "created_at", "_loaded_at")
