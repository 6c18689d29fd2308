"""Raw table schemas (the landing layer) as ordered (name, SQL type) lists.

The same list feeds ``StructType`` for typed reads, the adapters' final casts
and the CSV loader's ``try_cast`` step, so there is one definition per table.
"""

from __future__ import annotations

from pyspark.sql import types as T

TS = "TIMESTAMP_NTZ"
L = "BIGINT"
S = "STRING"
B = "BOOLEAN"
D = "DATE"


def dec(p: int, s: int) -> str:
    return f"DECIMAL({p},{s})"


RAW_TENANTS = [
    ("tenant_id", L), ("tenant_code", S), ("tenant_name", S), ("country_code", S),
    ("devise_locale", S), ("date_onboarding", D), ("sla_freshness_hours", L),
    ("contract_tier", S), ("is_active", B), ("_loaded_at", TS),
]

RAW_CATEGORIES = [
    ("categorie_id", L), ("nom_categorie", S), ("type_categorie", S), ("groupe", S),
    ("categorie_parent_id", L), ("niveau_hierarchique", L), ("is_active", B),
    ("date_creation", D), ("_loaded_at", TS),
]

RAW_FX_RATES = [
    ("fx_id", L), ("devise_source", S), ("devise_cible", S), ("date_cotation", D),
    ("taux", dec(18, 8)), ("source_provider", S), ("loaded_at", TS), ("_loaded_at", TS),
]

RAW_COMPTES = [
    ("compte_id", L), ("tenant_id", L), ("numero_compte", S), ("iban", S), ("bic", S),
    ("nom_client", S), ("prenom_client", S), ("email", S), ("telephone", S),
    ("date_naissance", D), ("adresse_ligne1", S), ("adresse_ligne2", S), ("code_postal", S),
    ("ville", S), ("pays", S), ("type_compte", S), ("devise", S),
    ("solde_initial", dec(15, 2)), ("solde_actuel", dec(15, 2)), ("date_ouverture", D),
    ("date_derniere_activite", D), ("statut", S), ("kyc_level", S),
    ("kyc_date_verification", D), ("aml_flag", S), ("customer_segment", S),
    ("preferred_language", S), ("consent_marketing", B), ("consent_data_sharing", B),
    ("is_pep", B), ("risk_score", dec(5, 2)), ("created_at", TS), ("updated_at", TS),
    ("created_by_source_system", S), ("_loaded_at", TS),
]

RAW_TRANSACTIONS = [
    # ids
    ("transaction_id", L), ("external_transaction_id", S), ("tenant_id", L), ("compte_id", L),
    ("compte_source_iban", S), ("compte_dest_iban", S),
    # times
    ("date_transaction", TS), ("date_valeur", TS), ("date_comptabilisation", TS),
    ("date_reception", TS), ("date_traitement", TS), ("date_settlement", TS),
    # amounts
    ("montant", dec(15, 2)), ("devise", S), ("montant_eur", dec(15, 2)),
    ("taux_change_applique", dec(18, 8)), ("frais", dec(10, 2)), ("frais_devise", S),
    ("montant_net", dec(15, 2)), ("type_operation", S), ("sens", S),
    # category
    ("categorie_id", L), ("categorie_auto_detectee", B), ("confiance_categorie", dec(5, 3)),
    ("sous_categorie", S), ("tags", S),
    # merchant
    ("marchand_nom", S), ("marchand_id", S), ("marchand_categorie", S), ("marchand_pays", S),
    ("marchand_mcc", L), ("marchand_siret", S),
    # payment
    ("moyen_paiement", S), ("carte_id", S), ("carte_last4", S), ("carte_type", S),
    ("carte_reseau", S), ("authentification_3ds", B),
    # context
    ("canal", S), ("device_type", S), ("device_id", S), ("user_agent", S), ("ip_address", S),
    ("session_id", S), ("geolocation_lat", dec(9, 4)), ("geolocation_lon", dec(9, 4)),
    # status
    ("statut", S), ("statut_precedent", S), ("nb_tentatives", L),
    ("date_derniere_tentative", TS), ("raison_rejet", S), ("code_erreur", S),
    ("message_erreur", S),
    # compliance
    ("aml_score", dec(6, 2)), ("aml_flag", S), ("aml_reviewed_by", S), ("aml_review_date", TS),
    ("fraud_score", dec(6, 2)), ("fraud_rules_triggered", S), ("is_flagged_for_review", B),
    # reconciliation
    ("is_reconciled", B), ("date_reconciliation", TS), ("reconciliation_batch_id", S),
    ("external_reference", S), ("internal_reference", S),
    # text
    ("description", S), ("description_brute", S), ("description_enrichie", S),
    ("libelle_court", S),
    # meta
    ("source_system", S), ("source_file_batch_id", S), ("created_at", TS), ("updated_at", TS),
    ("loaded_at", TS), ("processing_version", S), ("is_test", B), ("is_reversal", B),
    ("original_transaction_id", L), ("_loaded_at", TS),
]

RAW_VIREMENTS = [
    ("virement_id", L), ("tenant_id", L), ("compte_source_id", L), ("compte_dest_id", L),
    ("montant", dec(15, 2)), ("devise", S), ("date_virement", TS), ("date_execution", TS),
    ("motif", S), ("reference", S), ("statut", S), ("type_virement", S),
    ("frais", dec(10, 2)), ("created_at", TS), ("updated_at", TS), ("_loaded_at", TS),
]

RAW_TITULAIRES = [
    ("titulaire_id", L), ("nom", S), ("prenom", S), ("email", S), ("telephone", S),
    ("date_naissance", D), ("nationalite", S), ("pays_residence", S),
    ("type_titulaire_defaut", S), ("is_active", B), ("created_at", TS), ("_loaded_at", TS),
]

RAW_COMPTE_TITULAIRES = [
    ("id", L), ("compte_id", L), ("titulaire_id", L), ("type_relation", S),
    ("date_debut", D), ("date_fin", D), ("is_active", B), ("created_at", TS), ("_loaded_at", TS),
]

RAW_SCHEMAS = {
    "raw_tenants": RAW_TENANTS,
    "raw_categories": RAW_CATEGORIES,
    "raw_fx_rates": RAW_FX_RATES,
    "raw_comptes": RAW_COMPTES,
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_virements": RAW_VIREMENTS,
    "raw_titulaires": RAW_TITULAIRES,
    "raw_compte_titulaires": RAW_COMPTE_TITULAIRES,
}

_ATOMIC = {
    L: T.LongType(), S: T.StringType(), B: T.BooleanType(), D: T.DateType(),
    TS: T.TimestampNTZType(),
}


def spark_type(sql_type: str) -> T.DataType:
    if sql_type in _ATOMIC:
        return _ATOMIC[sql_type]
    if sql_type.startswith("DECIMAL("):
        p, s = sql_type[len("DECIMAL("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    raise ValueError(sql_type)


def struct(cols: list[tuple[str, str]], nullable: bool = True) -> T.StructType:
    return T.StructType([T.StructField(n, spark_type(t), nullable) for n, t in cols])


def duck_type(sql_type: str) -> str:
    """DuckDB spelling of a schema type (used only by the oracle fixtures)."""
    return {TS: "TIMESTAMP", S: "VARCHAR"}.get(sql_type, sql_type)
