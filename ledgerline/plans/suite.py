"""The reference's declared data tests as a spec list, run as one suite.

Each spec is (test kind, model, column, arguments), the shape of a schema
test declaration. ``reference_checks`` turns the specs into Spark checks;
``suite_sql`` into the DuckDB oracle of the same report.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import quality as Q
from ledgerline.operators.quality import Check
from ledgerline.plans.warehouse import Warehouse

# Fixed values of the declared tests.
CONTRACT_TIERS = ["gold", "silver", "bronze"]
ACCOUNT_STATUSES = ["actif", "inactif", "cloture", "suspendu"]
KYC_LEVELS = ["basic", "intermediate", "advanced", "not_verified"]
FACT_STATUSES = ["validee", "en_attente"]
TRANSFER_LEGS = ["sortant", "entrant"]

TESTS: list[tuple[str, str, str, dict]] = []


def _uq(model: str, col: str) -> None:
    TESTS.append(("unique", model, col, {}))
    TESTS.append(("not_null", model, col, {}))


_uq("stg_tenants", "tenant_id")
_uq("stg_categories", "categorie_id")
_uq("stg_fx_rates", "fx_id")
_uq("stg_comptes", "compte_id")
TESTS.append(("not_null", "stg_comptes", "tenant_id", {}))
TESTS.append(("relationships", "stg_comptes", "tenant_id", {"to": "stg_tenants", "field": "tenant_id"}))
_uq("stg_transactions", "transaction_id")
_uq("stg_virements", "virement_id")
_uq("dim_tenants", "tenant_id")
_uq("dim_tenants", "tenant_code")
TESTS.append(("accepted_values", "dim_tenants", "contract_tier", {"values": CONTRACT_TIERS}))
_uq("dim_comptes", "compte_id")
TESTS.append(("not_null", "dim_comptes", "tenant_id", {}))
TESTS.append(("relationships", "dim_comptes", "tenant_id", {"to": "dim_tenants", "field": "tenant_id"}))
TESTS.append(("accepted_values", "dim_comptes", "statut", {"values": ACCOUNT_STATUSES}))
TESTS.append(("accepted_values", "dim_comptes", "kyc_level", {"values": KYC_LEVELS}))
_uq("dim_categories", "categorie_id")
_uq("fct_transactions", "transaction_id")
TESTS.append(("not_null", "fct_transactions", "tenant_id", {}))
TESTS.append(("relationships", "fct_transactions", "tenant_id", {"to": "dim_tenants", "field": "tenant_id"}))
TESTS.append(("not_null", "fct_transactions", "compte_id", {}))
TESTS.append(("relationships", "fct_transactions", "compte_id", {"to": "dim_comptes", "field": "compte_id"}))
TESTS.append(("not_null", "fct_transactions", "montant_eur", {}))
TESTS.append(("accepted_range", "fct_transactions", "montant_eur",
              {"min": 0, "max": 100_000_000, "severity": "warn"}))
TESTS.append(("accepted_values", "fct_transactions", "statut", {"values": FACT_STATUSES}))
TESTS.append(("not_null", "fct_transactions", "date_transaction", {}))
TESTS.append(("not_null", "fct_virements", "virement_id", {}))
TESTS.append(("accepted_values", "fct_virements", "virement_leg", {"values": TRANSFER_LEGS}))


# Declared on the raw sources: keys of every table, and hours to warn and fail.
SOURCE_TESTS: list[tuple[str, str, str, dict]] = [
    *[(kind, f"raw_{t}", c, {}) for t, c in (
        ("fx_rates", "fx_id"), ("comptes", "compte_id"), ("transactions", "transaction_id"), ("virements", "virement_id"),
        ("titulaires", "titulaire_id"), ("compte_titulaires", "id")) for kind in ("unique", "not_null")],
    *[("not_null", f"raw_{t}", c, {}) for t, c in (
        ("fx_rates", "date_cotation"), ("transactions", "tenant_id"), ("compte_titulaires", "compte_id"),
        ("compte_titulaires", "titulaire_id"))],
    ("relationships", "raw_transactions", "tenant_id", {"to": "raw_tenants", "field": "tenant_id"})]
SOURCES = ("tenants", "categories", "fx_rates", "comptes", "transactions", "virements", "titulaires", "compte_titulaires")
FRESH_HOURS = {"comptes": (12, 48), "transactions": (2, 6)}
OTHER_FRESH_HOURS = (6, 24)


class Sources:
    """The raw tables by their source names."""

    def __init__(self, w: Warehouse):
        for t in SOURCES:
            setattr(self, f"raw_{t}", w.raw_transactions if t == "transactions" else getattr(w.raw, t)())


def source_checks(w: Warehouse) -> list[Check]:
    return _checks(Sources(w), SOURCE_TESTS)


def source_freshness(w: Warehouse):
    """One row per source with its age and status."""
    as_of = f"{w.params.as_of} 00:00:00"
    own = Sources(w)
    parts = [Q.freshness(getattr(own, f"raw_{t}"), "_loaded_at", as_of, *FRESH_HOURS.get(t, OTHER_FRESH_HOURS), f"raw_{t}")
             for t in SOURCES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_name(kind: str, model: str, col: str) -> str:
    return f"{kind}_{model}_{col}"


def _failing(w: Warehouse, kind: str, model: str, col: str, args: dict):
    df = getattr(w, model)
    if kind == "unique":
        return Q.unique(df, col)
    if kind == "not_null":
        return Q.not_null(df, col)
    if kind == "accepted_values":
        return Q.accepted_values(df, col, args["values"])
    if kind == "relationships":
        return Q.relationships(df, col, getattr(w, args["to"]), args["field"])
    if kind == "accepted_range":
        return Q.accepted_range(df, col, args.get("min"), args.get("max"))
    raise ValueError(kind)


def _predicate(kind: str, col: str, args: dict):
    c = F.col(col)
    if kind == "not_null":
        return c.isNull()
    if kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*args["values"])
    if kind == "accepted_range":
        return c.isNotNull() & ((c < args["min"]) | (c > args["max"]))
    return None


def reference_checks(w: Warehouse) -> list[Check]:
    return _checks(w, TESTS)


def _checks(w, tests: list[tuple[str, str, str, dict]]) -> list[Check]:
    out = []
    for k, m, c, a in tests:
        pred = _predicate(k, c, a)
        out.append(Check(test_name(k, m, c), m, c,
                         (lambda k=k, m=m, c=c, a=a: _failing(w, k, m, c, a)),
                         a.get("severity", "error"),
                         frame=(lambda m=m: getattr(w, m)) if pred is not None else None,
                         predicate=pred))
    return out


# DuckDB names of the model CTEs (the oracle's recursive hierarchy CTE).
SQL_MODEL = {"dim_categories": "cat_tree"}


def _failing_sql(kind: str, model: str, col: str, args: dict) -> str:
    m = SQL_MODEL.get(model, model)
    if kind == "unique":
        return f"SELECT {col} FROM {m} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1"
    if kind == "not_null":
        return f"SELECT * FROM {m} WHERE {col} IS NULL"
    if kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in args["values"])
        return f"SELECT * FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})"
    if kind == "relationships":
        p = SQL_MODEL.get(args["to"], args["to"])
        return (f"SELECT * FROM {m} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} p WHERE p.{args['field']} = c.{col})")
    if kind == "accepted_range":
        return (f"SELECT * FROM {m} WHERE {col} IS NOT NULL AND "
                f"({col} < {args['min']} OR {col} > {args['max']})")
    raise ValueError(kind)


def suite_sql() -> str:
    parts = []
    for k, m, c, a in TESTS:
        sev = a.get("severity", "error")
        parts.append(f"SELECT '{test_name(k, m, c)}' AS test_name, '{m}' AS model, '{c}' AS column_name, "
                     f"'{sev}' AS severity, count(*) AS n_failures FROM ({_failing_sql(k, m, c, a)}) f")
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT *, CASE WHEN n_failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            f"ELSE 'fail' END AS status FROM ({body}) s")
