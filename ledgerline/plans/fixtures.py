"""Two-cut fixtures for the incremental, snapshot and microbatch queries.

Like the adapters, each fixture is a set of SQL rules over the raw views so
Spark (``selectExpr`` / ``where``) and the DuckDB oracle build identical
inputs. Only the operators under test differ between the engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline import schemas as S
from ledgerline.sources.adapters import DUCKDB, SPARK, Dialect, RawTables

# --- fixed values of the fixtures -----------------------------------------
MERGE_CUT = "2000-01-01 00:00:00"         # target = rows loaded before this
REDELIVERED_AT = "2000-01-05 00:00:00"    # load time of re-sent (changed) rows
TX_CHANGED = "transaction_id % 6 = 0 OR transaction_id % 35 = 0"
VIR_CHANGED = "virement_id % 15 = 0"
SNAPSHOT_TIMES = ("2001-10-01 00:00:00", "2001-11-01 00:00:00", "2001-12-01 00:00:00")
MICROBATCH_TARGET_END = "2024-01-21"      # target holds days through 2024-01-20
MICROBATCH_START, MICROBATCH_END = "2024-01-18", "2024-01-31"
EVENTS_ALTERED = "transaction_id % 9 = 0"
# Day ledger: first day, last day of each of two runs, days with late rows
# (two and five days before the second run's last day).
LEDGER_BEGIN, LEDGER_RUNS, LEDGER_LATE = "2024-01-05", ("2024-01-20", "2024-01-22"), ("2024-01-20", "2024-01-17")

# Staging and fact update lists (columns a merge may overwrite).
STG_TX_UPDATE = ["statut", "statut_precedent", "date_traitement", "date_settlement",
                 "is_reconciled", "aml_flag", "aml_score", "fraud_score", "updated_at"]
FCT_TX_UPDATE = ["statut", "is_reconciled", "aml_flag", "aml_score", "fraud_score",
                 "montant_eur", "updated_at"]
SNAPSHOT_CHECK = ["statut", "kyc_level", "aml_flag", "email", "type_compte",
                  "customer_segment", "is_pep"]
SNAPSHOT_SOURCE = ["compte_id", "tenant_id", "numero_compte", "iban", "email", "nom_client",
                   "prenom_client", "type_compte", "devise", "statut", "kyc_level",
                   "kyc_date_verification", "aml_flag", "customer_segment", "is_pep",
                   "risk_score", "updated_at"]


def _ts(d: Dialect, v: str) -> str:
    return f"CAST('{v}' AS {d.ts_type()})"


def tx_change_rules(d: Dialect) -> dict[str, str]:
    """Re-sent transactions: pending -> validated (key % 6), -> rejected
    (key % 35, wins), plus an edit of a column outside every update list."""
    return {
        "statut": "CASE WHEN transaction_id % 35 = 0 THEN 'REJETEE' "
                  "WHEN statut = 'EN_ATTENTE' THEN 'VALIDEE' ELSE statut END",
        "statut_precedent": "statut",
        "marchand_nom": "marchand_nom || '-v2'",
        "updated_at": _ts(d, REDELIVERED_AT),
        "_loaded_at": _ts(d, REDELIVERED_AT),
    }


def vir_change_rules(d: Dialect) -> dict[str, str]:
    return {
        "statut": "'EXECUTE'",
        "frais": "CAST(1 AS DECIMAL(10,2))",
        "motif": "motif || ' (corrected)'",
        "updated_at": _ts(d, REDELIVERED_AT),
        "_loaded_at": _ts(d, REDELIVERED_AT),
    }


def event_alter_rules(d: Dialect) -> dict[str, str]:
    return {"montant": "montant + CAST(1 AS DECIMAL(15,2))",
            "montant_eur": "montant_eur + CAST(1 AS DECIMAL(15,2))"}


def snapshot_rules(d: Dialect, run: int) -> tuple[dict[str, str], str]:
    """Source state of raw accounts at snapshot run 1, 2 or 3 (rules, filter)."""
    if run == 1:
        return {}, "compte_id % 29 <> 0"
    rules = {
        "statut": "CASE WHEN compte_id % 11 = 0 THEN 'suspendu' ELSE statut END",
        "risk_score": "CASE WHEN compte_id % 7 = 0 THEN risk_score + CAST(1 AS DECIMAL(5,2)) "
                      "ELSE risk_score END",
        "updated_at": f"CASE WHEN compte_id % 11 = 0 OR compte_id % 7 = 0 "
                      f"THEN {_ts(d, SNAPSHOT_TIMES[1])} ELSE updated_at END",
    }
    return rules, ("compte_id % 13 <> 0" if run == 2 else "TRUE")


def select_rules(cols: list[tuple[str, str]], rules: dict[str, str], d: Dialect) -> list[str]:
    return [f"CAST({rules.get(n, n)} AS {d.cast_type(t)}) AS {n}" for n, t in cols]


def _types(schema, names):
    m = dict(schema)
    return [(n, m[n]) for n in names]


# --- Spark side -----------------------------------------------------------------

class SparkFixtures:
    def __init__(self, raw: RawTables):
        self.raw = raw

    # transactions
    def tx_cut(self) -> DataFrame:
        return self.raw.transactions().where(f"_loaded_at < CAST('{MERGE_CUT}' AS TIMESTAMP_NTZ)")

    def tx_new(self) -> DataFrame:
        return self.raw.transactions().where(f"_loaded_at >= CAST('{MERGE_CUT}' AS TIMESTAMP_NTZ)")

    def tx_changes(self) -> DataFrame:
        return self.tx_cut().where(TX_CHANGED).selectExpr(
            *select_rules(S.RAW_TRANSACTIONS, tx_change_rules(SPARK), SPARK))

    def tx_delta(self) -> DataFrame:
        return self.tx_new().unionByName(self.tx_changes())

    def tx_v2(self) -> DataFrame:
        """Raw transactions after the re-delivery (changed rows replaced)."""
        return (self.tx_cut().where(f"NOT ({TX_CHANGED})")
                .unionByName(self.tx_changes()).unionByName(self.tx_new()))

    # transfers
    def vir_cut(self) -> DataFrame:
        return self.raw.virements().where(f"_loaded_at < CAST('{MERGE_CUT}' AS TIMESTAMP_NTZ)")

    def vir_delta(self) -> DataFrame:
        new = self.raw.virements().where(f"_loaded_at >= CAST('{MERGE_CUT}' AS TIMESTAMP_NTZ)")
        ch = self.vir_cut().where(VIR_CHANGED).selectExpr(
            *select_rules(S.RAW_VIREMENTS, vir_change_rules(SPARK), SPARK))
        return new.unionByName(ch)

    # accounts at each snapshot run
    def accounts_at(self, run: int) -> DataFrame:
        rules, where = snapshot_rules(SPARK, run)
        return self.raw.comptes().where(where).selectExpr(
            *select_rules(_types(S.RAW_COMPTES, SNAPSHOT_SOURCE), rules, SPARK))

    # events
    def events_altered(self) -> DataFrame:
        ev = self.raw.event_transactions()
        return (ev.where(f"NOT ({EVENTS_ALTERED})")
                .unionByName(ev.where(EVENTS_ALTERED).selectExpr(
                    *select_rules(S.RAW_TRANSACTIONS, event_alter_rules(SPARK), SPARK))))


# --- DuckDB side ------------------------------------------------------------------

def duckdb_fixture_ctes() -> dict[str, str]:
    d = DUCKDB
    cut = f"_loaded_at < CAST('{MERGE_CUT}' AS TIMESTAMP)"
    ctes = {
        "tx_cut": f"SELECT * FROM raw_transactions WHERE {cut}",
        "tx_new": f"SELECT * FROM raw_transactions WHERE NOT ({cut})",
        "tx_changes": f"SELECT {', '.join(select_rules(S.RAW_TRANSACTIONS, tx_change_rules(d), d))} "
                      f"FROM tx_cut WHERE {TX_CHANGED}",
        "tx_delta": "SELECT * FROM tx_new UNION ALL SELECT * FROM tx_changes",
        "tx_v2": f"SELECT * FROM tx_cut WHERE NOT ({TX_CHANGED}) UNION ALL SELECT * FROM tx_changes "
                 f"UNION ALL SELECT * FROM tx_new",
        "vir_cut": f"SELECT * FROM raw_virements WHERE {cut}",
        "vir_delta": f"SELECT * FROM raw_virements WHERE NOT ({cut}) UNION ALL "
                     f"SELECT {', '.join(select_rules(S.RAW_VIREMENTS, vir_change_rules(d), d))} "
                     f"FROM vir_cut WHERE {VIR_CHANGED}",
        "events_altered": f"SELECT * FROM raw_event_transactions WHERE NOT ({EVENTS_ALTERED}) UNION ALL "
                          f"SELECT {', '.join(select_rules(S.RAW_TRANSACTIONS, event_alter_rules(d), d))} "
                          f"FROM raw_event_transactions WHERE {EVENTS_ALTERED}",
    }
    for run in (1, 2, 3):
        rules, where = snapshot_rules(d, run)
        ctes[f"accounts_run{run}"] = (
            f"SELECT {', '.join(select_rules(_types(S.RAW_COMPTES, SNAPSHOT_SOURCE), rules, d))} "
            f"FROM raw_comptes WHERE {where}")
    return ctes
