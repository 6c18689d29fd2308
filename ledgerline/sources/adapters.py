"""Driver tables -> raw-shaped banking tables.

The driver's Parquet tables hold TPC-H-style data, not bank data. These
adapters are deterministic views that give every raw banking table its schema
from integer and decimal arithmetic on the driver tables, so each query's work
grows with the driver's scale factor.

Each adapter is a list of ``(column, SQL expression)`` rules over a source
frame. Spark applies them with ``selectExpr`` (they compile to the same
Catalyst expressions as ``F.*`` calls, and whole-stage codegen keeps them
JVM-side); the DuckDB oracle builds the same views from the same rules, so
the fixtures cannot drift between the two engines. Only date arithmetic is
spelled per dialect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S


@dataclass(frozen=True)
class Dialect:
    name: str  # "spark" | "duckdb"

    def ts_type(self) -> str:
        return "TIMESTAMP_NTZ" if self.name == "spark" else "TIMESTAMP"

    def cast_type(self, sql_type: str) -> str:
        return sql_type if self.name == "spark" else S.duck_type(sql_type)

    def add_seconds(self, ts: str, n: str) -> str:
        if self.name == "spark":
            return f"timestampadd(SECOND, {n}, {ts})"
        return f"({ts} + to_seconds(CAST({n} AS BIGINT)))"

    def add_days(self, date: str, n: str) -> str:
        if self.name == "spark":
            return f"date_add({date}, CAST({n} AS INT))"
        return f"CAST({date} + CAST({n} AS INTEGER) AS DATE)"

    def epoch_day(self, date: str) -> str:
        if self.name == "spark":
            return f"CAST(unix_date({date}) AS BIGINT)"
        return f"CAST(CAST({date} AS DATE) - DATE '1970-01-01' AS BIGINT)"

    def to_ts(self, date: str) -> str:
        return f"CAST({date} AS {self.ts_type()})"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")

# --- fixed values of the fixture ------------------------------------------
# Quote currencies of the FX fixture: (index, code, base rate against EUR).
FX_CURRENCIES = [(1, "USD", "1.08"), (2, "GBP", "0.85"), (3, "CHF", "0.96"),
                 (4, "SEK", "11.2"), (5, "JPY", "160")]
# Default parameters of the fixture.
AS_OF = "2001-12-31"
MICROBATCH_BEGIN = "2001-11-01"  # first day of the fact's day batches
EVENTS_AS_OF = "2024-02-01"
FX_SPINE_START = "1995-01-01"
FX_SPINE_END = "2002-01-01"  # exclusive


def _w(case_of: str, pairs: list[tuple[str, str]], default: str) -> str:
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in pairs)
    return f"CASE {body} ELSE {default} END"


# --- rules -----------------------------------------------------------------

def tenants_rules(d: Dialect) -> dict[str, str]:
    k = "n_nationkey"
    return {
        "tenant_id": k,
        "tenant_code": f"'T' || CAST({k} AS STRING)",
        "tenant_name": "n_name",
        "country_code": "'FR'",
        "devise_locale": "'EUR'",
        "date_onboarding": d.add_days("DATE '2021-01-01'", f"{k} * 60"),
        "sla_freshness_hours": f"CASE {k} % 5 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 6 "
                               f"WHEN 3 THEN 12 ELSE 24 END",
        "contract_tier": f"CASE {k} % 3 WHEN 0 THEN 'gold' WHEN 1 THEN 'silver' ELSE 'bronze' END",
        "is_active": f"{k} % 20 <> 0",
        "_loaded_at": f"CAST('2001-12-30 20:00:00' AS {d.ts_type()})",
    }


def categories_rules(d: Dialect, level: int) -> dict[str, str]:
    ts = f"CAST('2001-12-30 21:00:00' AS {d.ts_type()})"
    common = {"date_creation": "DATE '1994-06-01'", "_loaded_at": ts,
              "niveau_hierarchique": str(level)}
    if level == 1:
        k = "r_regionkey"
        return {**common, "categorie_id": f"1000 + {k}", "nom_categorie": "r_name",
                "type_categorie": f"CASE WHEN {k} % 2 = 0 THEN 'depense' ELSE 'revenu' END",
                "groupe": "r_name", "categorie_parent_id": "NULL", "is_active": "TRUE"}
    if level == 2:
        k = "n_nationkey"
        return {**common, "categorie_id": f"2000 + {k}", "nom_categorie": "n_name",
                "type_categorie": f"CASE WHEN n_regionkey % 2 = 0 THEN 'depense' ELSE 'revenu' END",
                "groupe": f"'G' || CAST(n_regionkey AS STRING)",
                "categorie_parent_id": "1000 + n_regionkey", "is_active": f"{k} % 13 <> 7"}
    k = "s_suppkey"
    return {**common, "categorie_id": f"1000000 + {k}", "nom_categorie": "s_name",
            "type_categorie": f"CASE WHEN {k} % 4 = 0 THEN 'revenu' ELSE 'depense' END",
            "groupe": f"'G' || CAST(s_nationkey % 5 AS STRING)",
            "categorie_parent_id": "2000 + s_nationkey", "is_active": f"{k} % 17 <> 5"}


def fx_rules(d: Dialect) -> dict[str, str]:
    ed = "ed"
    return {
        "fx_id": f"{ed} * 10 + ccy_i",
        "devise_source": "'EUR'",
        "devise_cible": "ccy",
        "date_cotation": "quote_day",
        "taux": f"CAST(ccy_base AS DECIMAL(18,8)) + CAST(({ed} * 31 + 17 * ccy_i) % 100 AS DECIMAL(18,8)) * 0.001",
        "source_provider": "'ECB'",
        "loaded_at": d.add_seconds(d.to_ts("quote_day"), "64800"),
        "_loaded_at": d.add_seconds(d.to_ts("quote_day"), "64800"),
    }


FX_FILTER = "(ed + 3) % 7 < 5 AND (ed + 3 * ccy_i) % 11 <> 0"


def comptes_rules(d: Dialect) -> dict[str, str]:
    k = "c_custkey"
    opening = d.add_days("DATE '1994-01-01'", f"(7 * {k}) % 1500")
    return {
        "compte_id": k,
        "tenant_id": "c_nationkey",
        "numero_compte": f"'ACC' || CAST({k} AS STRING)",
        "iban": f"'FR76' || CAST(10000000 + {k} AS STRING)",
        "bic": "'BANKFRPP'",
        "nom_client": "c_name",
        "prenom_client": f"CASE WHEN {k} % 17 = 0 THEN NULL ELSE c_mktsegment END",
        "email": f"'client' || CAST({k} AS STRING) || '@example.org'",
        "pays": f"CASE {k} % 3 WHEN 0 THEN 'fr' WHEN 1 THEN 'Be' ELSE 'LU' END",
        "type_compte": f"CASE {k} % 4 WHEN 0 THEN 'Courant' WHEN 1 THEN 'EPARGNE' "
                       f"WHEN 2 THEN 'joint' ELSE 'Pro' END",
        "devise": f"CASE {k} % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'Gbp' ELSE 'eur' END",
        "solde_initial": "CAST(c_acctbal AS DECIMAL(15,2))",
        "solde_actuel": "CAST(c_acctbal AS DECIMAL(15,2))",
        "date_ouverture": f"CASE WHEN {k} % 50 = 0 THEN NULL ELSE {opening} END",
        "date_derniere_activite": d.add_days("DATE '2000-01-01'", f"(11 * {k}) % 720"),
        "statut": f"CASE WHEN {k} % 10 = 8 THEN 'Inactif' WHEN {k} % 10 = 9 THEN 'CLOTURE' "
                  f"WHEN {k} % 2 = 0 THEN 'actif' ELSE 'Actif' END",
        "kyc_level": f"CASE {k} % 4 WHEN 0 THEN 'basic' WHEN 1 THEN 'intermediate' "
                     f"WHEN 2 THEN 'advanced' ELSE 'not_verified' END",
        "kyc_date_verification": d.add_days("DATE '1995-01-01'", f"(13 * {k}) % 1000"),
        "aml_flag": f"CASE WHEN {k} % 40 = 0 THEN 'watchlist_check' ELSE 'clean' END",
        "customer_segment": "c_mktsegment",
        "preferred_language": "'fr'",
        "is_pep": f"{k} % 125 = 0",
        "risk_score": f"CAST({k} % 10000 AS DECIMAL(8,0)) * 0.01",
        "created_at": d.to_ts(d.add_days("DATE '1994-01-01'", f"(7 * {k}) % 1500")),
        "updated_at": f"CAST('2001-12-01 00:00:00' AS {d.ts_type()})",
        "created_by_source_system": "'CORE_BANKING'",
        "_loaded_at": f"CAST('2001-12-31 06:00:00' AS {d.ts_type()})",
    }


def transactions_rules(d: Dialect) -> dict[str, str]:
    k = "o_orderkey"
    ts = d.add_seconds("o_orderdate", f"(37 * {k}) % 86400")
    montant = "CAST(o_totalprice AS DECIMAL(15,2))"
    taux = f"CAST(1 + CAST({k} % 30 AS DECIMAL(18,8)) * 0.01 AS DECIMAL(18,8))"
    frais = f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE CAST({k} % 500 AS DECIMAL(10,2)) * 0.01 END"
    return {
        "transaction_id": k,
        "external_transaction_id": f"'EXT-' || CAST({k} AS STRING)",
        "tenant_id": "c_nationkey",
        "compte_id": "o_custkey",
        "date_transaction": ts,
        "date_valeur": d.add_seconds(ts, "86400"),
        "date_settlement": d.add_seconds(ts, "172800"),
        "montant": montant,
        "devise": _w("", [(f"{k} % 10 < 5", "'eur'"), (f"{k} % 10 = 5", "'usd'"),
                          (f"{k} % 10 = 6", "'gbp'"), (f"{k} % 10 = 7", "'chf'"),
                          (f"{k} % 10 = 8", "'jpy'")], "'sek'"),
        "taux_change_applique": taux,
        "montant_eur": f"round({montant} * {taux}, 2)",
        "frais": frais,
        "frais_devise": "'eur'",
        "montant_net": f"{montant} - coalesce({frais}, 0)",
        "type_operation": _w("", [("substr(o_orderpriority, 1, 1) IN ('1', '2')", "'CREDIT'"),
                                  (f"{k} % 211 = 0", "'AUTRE'")], "'DEBIT'"),
        "sens": "CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'ENTRANT' ELSE 'SORTANT' END",
        "categorie_id": f"1000000 + (7 * {k}) % 120",
        "marchand_nom": f"'MERCHANT-' || CAST({k} % 97 AS STRING)",
        "marchand_categorie": f"CASE {k} % 4 WHEN 0 THEN 'grocery' WHEN 1 THEN 'travel' "
                              f"WHEN 2 THEN 'utilities' ELSE 'retail' END",
        "marchand_pays": "'fr'",
        "marchand_mcc": f"5000 + {k} % 100",
        "moyen_paiement": f"CASE {k} % 3 WHEN 0 THEN 'CARTE' WHEN 1 THEN 'Virement' ELSE 'prelevement' END",
        "canal": f"CASE {k} % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'web' WHEN 2 THEN 'Agence' ELSE 'API' END",
        "statut": (f"CASE o_orderstatus WHEN 'F' THEN 'VALIDEE' "
                   f"WHEN 'O' THEN CASE WHEN {k} % 3 = 0 THEN 'EN_ATTENTE' ELSE 'VALIDEE' END "
                   f"ELSE CASE {k} % 4 WHEN 0 THEN 'REJETEE' WHEN 1 THEN 'ANNULEE' "
                   f"WHEN 2 THEN 'EN_COURS_VERIFICATION' ELSE 'VALIDEE' END END"),
        "aml_score": f"CAST({k} % 10000 AS DECIMAL(8,0)) * 0.01",
        "aml_flag": _w("", [(f"{k} % 67 = 0", "'suspicious'"), (f"{k} % 71 = 0", "'manual_review'")],
                       "'clean'"),
        "fraud_score": f"CAST((7 * {k}) % 10000 AS DECIMAL(8,0)) * 0.01",
        "is_flagged_for_review": f"{k} % 41 = 0",
        "is_reconciled": f"CASE WHEN {k} % 23 = 0 THEN NULL ELSE {k} % 11 <> 0 END",
        "reconciliation_batch_id": f"CASE WHEN {k} % 10 = 9 THEN NULL ELSE 'BATCH-' || CAST({k} % 5 AS STRING) END",
        "source_system": f"CASE WHEN {k} % 2 = 0 THEN 'CORE_BANKING' ELSE 'CARD_GATEWAY' END",
        "created_at": ts,
        "updated_at": d.add_seconds(ts, "1800"),
        "loaded_at": d.add_seconds(ts, "3600"),
        "is_test": f"{k} % 101 = 0",
        "is_reversal": f"CASE WHEN {k} % 307 = 0 THEN NULL ELSE {k} % 199 = 0 END",
        "_loaded_at": d.add_seconds(ts, "3600"),
    }


def event_transactions_rules(d: Dialect) -> dict[str, str]:
    k = "event_id"
    montant = "CAST(value AS DECIMAL(15,2))"
    return {
        "transaction_id": k,
        "external_transaction_id": f"'EVT-' || CAST({k} AS STRING)",
        "tenant_id": "user_id % 25",
        "compte_id": "user_id",
        "date_transaction": "ts",
        "montant": montant,
        "devise": "'EUR'",
        "montant_eur": montant,
        "taux_change_applique": "CAST(1 AS DECIMAL(18,8))",
        "type_operation": f"CASE WHEN {k} % 4 = 0 THEN 'CREDIT' ELSE 'DEBIT' END",
        "statut": "'VALIDEE'",
        "categorie_id": "NULL",
        "aml_flag": "'clean'",
        "is_reconciled": "TRUE",
        "source_system": "'EVENTS'",
        "created_at": "ts",
        "updated_at": "ts",
        "is_test": "FALSE",
        "is_reversal": "FALSE",
        "_loaded_at": d.add_seconds("ts", "3600"),
    }


def virements_rules(d: Dialect) -> dict[str, str]:
    k = "o_orderkey"
    return {
        "virement_id": k,
        "tenant_id": "c_nationkey",
        "compte_source_id": "o_custkey",
        "compte_dest_id": f"(o_custkey + 1 + {k} % 50) % n_cust",
        "montant": "round(CAST(o_totalprice AS DECIMAL(15,2)) * 0.01, 2)",
        "devise": f"CASE {k} % 3 WHEN 0 THEN 'eur' WHEN 1 THEN 'usd' ELSE 'GBP' END",
        "date_virement": "o_orderdate",
        "date_execution": d.add_seconds("o_orderdate", "86400"),
        "motif": f"'transfer ' || CAST({k} AS STRING)",
        "reference": f"'VIR-' || CAST({k} AS STRING)",
        "statut": f"CASE {k} % 20 WHEN 0 THEN 'EN_ATTENTE' WHEN 5 THEN 'ANNULE' ELSE 'EXECUTE' END",
        "type_virement": f"CASE WHEN {k} % 2 = 0 THEN 'SEPA' ELSE 'Instant' END",
        "frais": f"CASE WHEN {k} % 4 = 0 THEN NULL ELSE CAST(0.5 AS DECIMAL(10,2)) END",
        "created_at": "o_orderdate",
        "updated_at": "o_orderdate",
        "_loaded_at": d.add_seconds("o_orderdate", "7200"),
    }


def titulaires_rules(d: Dialect) -> dict[str, str]:
    k = "c_custkey"
    return {
        "titulaire_id": k,
        "nom": "c_name",
        "prenom": "c_mktsegment",
        "email": f"'holder' || CAST({k} AS STRING) || '@example.org'",
        "nationalite": "'FR'",
        "pays_residence": "'FR'",
        "type_titulaire_defaut": f"CASE WHEN {k} % 10 = 0 THEN 'entreprise' ELSE 'particulier' END",
        "is_active": "TRUE",
        "created_at": f"CAST('1994-01-01 00:00:00' AS {d.ts_type()})",
        "_loaded_at": f"CAST('2001-12-31 06:00:00' AS {d.ts_type()})",
    }


def links_rules(d: Dialect, leg: int) -> dict[str, str]:
    k = "c_custkey"
    opening = d.add_days("DATE '1994-01-01'", f"(7 * {k}) % 1500")
    base = {
        "id": f"{k} * 3 + {leg}",
        "compte_id": k,
        "created_at": d.to_ts(opening),
        "_loaded_at": f"CAST('2001-12-31 06:00:00' AS {d.ts_type()})",
        "date_debut": opening,
    }
    if leg == 0:
        return {**base, "titulaire_id": k, "type_relation": "'principal'",
                "date_fin": "NULL", "is_active": "TRUE"}
    if leg == 1:
        return {**base, "titulaire_id": f"({k} + 1) % n_cust", "type_relation": "'cotitulaire'",
                "date_fin": f"CASE WHEN {k} % 50 = 0 THEN DATE '2000-06-30' ELSE NULL END",
                "is_active": f"{k} % 50 <> 0"}
    return {**base, "titulaire_id": f"({k} + 2) % n_cust", "type_relation": "'mandataire'",
            "date_fin": "NULL", "is_active": "TRUE"}


LINK_FILTERS = {0: "TRUE", 1: "c_custkey % 5 = 0", 2: "c_custkey % 20 = 0"}


def projection(schema: list[tuple[str, str]], rules: dict[str, str], d: Dialect) -> list[str]:
    """Typed select list: every schema column, cast to its type, NULL if no rule."""
    out = []
    for name, typ in schema:
        expr = rules.get(name, "NULL")
        out.append(f"CAST({expr} AS {d.cast_type(typ)}) AS {name}")
    return out


# --- Spark side --------------------------------------------------------------

class RawTables:
    """Lazily built raw-shaped DataFrames over one driver scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _n_customers(self) -> int:
        # A single scalar computed once: the modulus of the synthetic link and
        # transfer rules. Nothing but this number reaches the driver.
        if "_n_cust" not in self._cache:
            self._cache["_n_cust"] = self.driver("customer").count()
        return self._cache["_n_cust"]

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def tenants(self) -> DataFrame:
        return self._get("raw_tenants", lambda: self.driver("nation").selectExpr(
            *projection(S.RAW_TENANTS, tenants_rules(SPARK), SPARK)))

    def categories(self) -> DataFrame:
        def build():
            parts = [
                self.driver("region").selectExpr(*projection(S.RAW_CATEGORIES, categories_rules(SPARK, 1), SPARK)),
                self.driver("nation").selectExpr(*projection(S.RAW_CATEGORIES, categories_rules(SPARK, 2), SPARK)),
                self.driver("supplier").selectExpr(*projection(S.RAW_CATEGORIES, categories_rules(SPARK, 3), SPARK)),
            ]
            return parts[0].unionByName(parts[1]).unionByName(parts[2])
        return self._get("raw_categories", build)

    def fx_rates(self) -> DataFrame:
        def build():
            days = (self.driver("orders")
                    .select(F.to_date("o_orderdate").alias("quote_day")).distinct()
                    .withColumn("ed", F.unix_date("quote_day").cast("bigint")))
            # Quote currencies are a fixed 5-element list: expand each day with
            # a generator instead of joining.
            ccys = F.array(*[F.struct(F.lit(i).cast("bigint").alias("ccy_i"),
                                      F.lit(c).alias("ccy"),
                                      F.lit(b).alias("ccy_base"))
                             for i, c, b in FX_CURRENCIES])
            grid = days.select("quote_day", "ed", F.inline(ccys)).where(FX_FILTER)
            return grid.selectExpr(*projection(S.RAW_FX_RATES, fx_rules(SPARK), SPARK))
        return self._get("raw_fx_rates", build)

    def comptes(self) -> DataFrame:
        return self._get("raw_comptes", lambda: self.driver("customer").selectExpr(
            *projection(S.RAW_COMPTES, comptes_rules(SPARK), SPARK)))

    def _orders_customers(self) -> DataFrame:
        o = self.driver("orders")
        c = self.driver("customer").select("c_custkey", "c_nationkey")
        return o.join(c, o.o_custkey == c.c_custkey, "inner")

    def transactions(self) -> DataFrame:
        return self._get("raw_transactions", lambda: self._orders_customers().selectExpr(
            *projection(S.RAW_TRANSACTIONS, transactions_rules(SPARK), SPARK)))

    def event_transactions(self) -> DataFrame:
        return self._get("raw_event_transactions", lambda: self.driver("events").selectExpr(
            *projection(S.RAW_TRANSACTIONS, event_transactions_rules(SPARK), SPARK)))

    def virements(self) -> DataFrame:
        def build():
            # Every order also books one transfer: the whole orders table.
            src = (self._orders_customers()
                   .withColumn("n_cust", F.lit(self._n_customers()).cast("bigint")))
            return src.selectExpr(*projection(S.RAW_VIREMENTS, virements_rules(SPARK), SPARK))
        return self._get("raw_virements", build)

    def titulaires(self) -> DataFrame:
        return self._get("raw_titulaires", lambda: self.driver("customer").selectExpr(
            *projection(S.RAW_TITULAIRES, titulaires_rules(SPARK), SPARK)))

    def compte_titulaires(self) -> DataFrame:
        def build():
            cust = self.driver("customer").withColumn(
                "n_cust", F.lit(self._n_customers()).cast("bigint"))
            legs = [cust.where(LINK_FILTERS[leg]).selectExpr(
                *projection(S.RAW_COMPTE_TITULAIRES, links_rules(SPARK, leg), SPARK))
                for leg in (0, 1, 2)]
            return legs[0].unionByName(legs[1]).unionByName(legs[2])
        return self._get("raw_compte_titulaires", build)


# --- DuckDB side (oracle fixtures) ---------------------------------------------

def _sel(schema, rules, src: str, where: str = "TRUE") -> str:
    return f"SELECT {', '.join(projection(schema, rules, DUCKDB))} FROM {src} WHERE {where}"


def duckdb_raw_ctes() -> dict[str, str]:
    """CTE bodies that build the raw views inside DuckDB from the driver views."""
    d = DUCKDB
    oc = "(SELECT * FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"
    ncust = "(SELECT count(*) AS n_cust FROM customer)"
    ccy_values = ", ".join(f"({i}, '{c}', '{b}')" for i, c, b in FX_CURRENCIES)
    fx_src = (f"(SELECT quote_day, {d.epoch_day('quote_day')} AS ed, ccy_i, ccy, ccy_base "
              f"FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS quote_day FROM orders) days, "
              f"(VALUES {ccy_values}) AS cc(ccy_i, ccy, ccy_base))")
    return {
        "raw_tenants": _sel(S.RAW_TENANTS, tenants_rules(d), "nation"),
        "raw_categories": " UNION ALL ".join([
            _sel(S.RAW_CATEGORIES, categories_rules(d, 1), "region"),
            _sel(S.RAW_CATEGORIES, categories_rules(d, 2), "nation"),
            _sel(S.RAW_CATEGORIES, categories_rules(d, 3), "supplier")]),
        "raw_fx_rates": _sel(S.RAW_FX_RATES, fx_rules(d), fx_src, FX_FILTER),
        "raw_comptes": _sel(S.RAW_COMPTES, comptes_rules(d), "customer"),
        "raw_transactions": _sel(S.RAW_TRANSACTIONS, transactions_rules(d), oc),
        "raw_event_transactions": _sel(S.RAW_TRANSACTIONS, event_transactions_rules(d), "events"),
        "raw_virements": _sel(S.RAW_VIREMENTS, virements_rules(d),
                              f"(SELECT * FROM {oc} x, {ncust} n)"),
        "raw_titulaires": _sel(S.RAW_TITULAIRES, titulaires_rules(d), "customer"),
        "raw_compte_titulaires": " UNION ALL ".join(
            _sel(S.RAW_COMPTE_TITULAIRES, links_rules(d, leg),
                 f"(SELECT * FROM customer, {ncust} n)", LINK_FILTERS[leg]) for leg in (0, 1, 2)),
    }
