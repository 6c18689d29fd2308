"""Schema contracts (I10): the expected column set and types of public models.

All 43 columns of the fact are listed (quirk Q22: the reference's own
contract lists only 41 of them).
"""

from __future__ import annotations

from ledgerline import schemas as S

L, STR, B, D, TS = S.L, S.S, S.B, S.D, S.TS
M = "DECIMAL(18,2)"

FCT_TRANSACTIONS_COLUMNS = [
    ("transaction_id", L), ("external_transaction_id", STR), ("tenant_id", L), ("compte_id", L),
    ("categorie_id", L), ("date_transaction", TS), ("jour_transaction", D),
    ("semaine_transaction", D), ("mois_transaction", D), ("date_valeur", TS),
    ("date_settlement", TS), ("montant", "DECIMAL(15,2)"), ("devise", STR), ("montant_eur", M),
    ("montant_signe", "DECIMAL(15,2)"), ("montant_signe_eur", "DECIMAL(15,2)"),
    ("frais", "DECIMAL(10,2)"), ("montant_net", "DECIMAL(15,2)"), ("type_operation", STR),
    ("sens", STR), ("statut", STR), ("moyen_paiement", STR), ("canal", STR), ("type_compte", STR),
    ("customer_segment", STR), ("pays_compte", STR), ("nom_categorie", STR),
    ("type_categorie", STR), ("groupe", STR), ("marchand_nom", STR), ("marchand_categorie", STR),
    ("marchand_pays", STR), ("marchand_mcc", L), ("aml_score", "DECIMAL(6,2)"), ("aml_flag", STR),
    ("fraud_score", "DECIMAL(6,2)"), ("is_flagged_for_review", B), ("is_reconciled", B),
    ("reconciliation_batch_id", STR), ("source_system", STR), ("created_at", TS),
    ("updated_at", TS), ("_loaded_at", TS),
]

FCT_TRANSACTIONS_CONTRACT = S.struct(FCT_TRANSACTIONS_COLUMNS)
