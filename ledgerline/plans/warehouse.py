"""Model graph as plain Python composition.

``Warehouse`` wires raw tables -> staging -> intermediate -> dims/facts -> marts
as lazy DataFrames. Nothing executes until a consumer runs an action, so
Catalyst sees each mart's whole plan (filter pushdown into the scans, column
pruning through the 43-column fact, constant folding of the fixture rules).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from ledgerline.operators import dims, facts, fx, hierarchy, marts, staging
from ledgerline.sources.adapters import AS_OF, FX_SPINE_END, FX_SPINE_START, MICROBATCH_BEGIN, RawTables


@dataclass
class Params:
    as_of: str = AS_OF
    fx_start: str = FX_SPINE_START
    fx_end: str = FX_SPINE_END
    fx_mode: str = "multiply"
    microbatch_begin: str = MICROBATCH_BEGIN


@dataclass
class Warehouse:
    raw: RawTables
    params: Params = field(default_factory=Params)
    use_events: bool = False  # transactions from the dense `events` table

    def register_views(self, names: list[str]) -> None:
        """A10: expose models as temp views (``view``/``ephemeral`` sinks), so
        they can be queried with ``spark.sql``; nothing is stored."""
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)

    # staging
    @cached_property
    def stg_tenants(self) -> DataFrame:
        return staging.stg_tenants(self.raw.tenants())

    @cached_property
    def stg_categories(self) -> DataFrame:
        return staging.stg_categories(self.raw.categories())

    @cached_property
    def stg_fx_rates(self) -> DataFrame:
        return staging.stg_fx_rates(self.raw.fx_rates())

    @cached_property
    def stg_comptes(self) -> DataFrame:
        return staging.stg_comptes(self.raw.comptes())

    @property
    def raw_transactions(self) -> DataFrame:
        return self.raw.event_transactions() if self.use_events else self.raw.transactions()

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw_transactions)

    @cached_property
    def stg_virements(self) -> DataFrame:
        return staging.stg_virements(self.raw.virements())

    @cached_property
    def stg_titulaires(self) -> DataFrame:
        return staging.stg_titulaires(self.raw.titulaires())

    @cached_property
    def stg_compte_titulaires(self) -> DataFrame:
        return staging.stg_compte_titulaires(self.raw.compte_titulaires())

    # intermediate
    @cached_property
    def int_fx_rates_daily(self) -> DataFrame:
        p = self.params
        return fx.fx_rates_daily(self.stg_fx_rates, p.fx_start, p.fx_end)

    @cached_property
    def int_transactions_normalisees(self) -> DataFrame:
        return facts.int_transactions_normalisees(self.stg_transactions, self.stg_comptes,
                                                  self.stg_categories)

    # dims
    @cached_property
    def dim_tenants(self) -> DataFrame:
        return dims.dim_tenants(self.stg_tenants, self.params.as_of)

    @cached_property
    def dim_comptes(self) -> DataFrame:
        return dims.dim_comptes(self.stg_comptes, self.dim_tenants, self.params.as_of)

    @cached_property
    def dim_categories(self) -> DataFrame:
        return hierarchy.dim_categories(self.stg_categories)

    @cached_property
    def bridge_comptes_titulaires(self) -> DataFrame:
        return dims.bridge_comptes_titulaires(self.stg_compte_titulaires)

    # facts
    def fact_from(self, normalised: DataFrame) -> DataFrame:
        p = self.params
        return facts.fct_transactions(normalised,
                                      fx.fx_for_join(self.int_fx_rates_daily),
                                      p.fx_mode)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return self.fact_from(self.int_transactions_normalisees)

    @cached_property
    def fct_transactions_v2(self) -> DataFrame:
        return facts.with_net_of_tax(self.fct_transactions)

    @cached_property
    def fct_virements(self) -> DataFrame:
        return facts.fct_virements(self.stg_virements)

    # marts
    @cached_property
    def mart_tenant_kpis_daily(self) -> DataFrame:
        return marts.mart_tenant_kpis_daily(self.fct_transactions, self.dim_tenants)

    @cached_property
    def mart_solde_journalier(self) -> DataFrame:
        return marts.mart_solde_journalier(self.fct_transactions, self.fct_virements,
                                           self.dim_comptes)

    @cached_property
    def mart_reconciliation(self) -> DataFrame:
        return marts.mart_reconciliation(self.fct_transactions, self.params.as_of)

    @cached_property
    def mart_cohortes_retention(self) -> DataFrame:
        return marts.mart_cohortes_retention(self.fct_transactions, self.dim_comptes)

    @cached_property
    def mart_transactions_anomalies(self) -> DataFrame:
        return marts.mart_transactions_anomalies(self.fct_transactions)
