"""Data-quality operators (I1-I15) and a suite runner.

Every check returns a DataFrame of *failing* rows (empty = pass), so a suite
can store failures (``store_failures``) and a report only needs counts. All
checks are distributed: aggregations run partial-then-final, anti joins are
planned by AQE, and the only values that reach the driver are the counts a
report asks for.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import remove_path



# --- I1-I5: column tests ---------------------------------------------------------

def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Non-null key values seen more than once -> (cols..., n_records)."""
    nn = F.lit(True)
    for c in cols:
        nn = nn & F.col(c).isNotNull()
    return (df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Non-null values outside the accepted set."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """I4: non-null child keys without a parent row (left anti join).

    How to join is the planner's choice: a small parent is broadcast and the
    child — often the fact — only streamed; AQE splits a hot child key."""
    p = parent.select(F.col(field).alias("_p_key")).distinct()
    child = df.where(F.col(col).isNotNull())
    return child.join(p, child[col] == p["_p_key"], "left_anti")


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None,
                   inclusive: bool = True) -> DataFrame:
    """Non-null values outside [min, max]."""
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return df.where(c.isNotNull() & bad)


# --- I6-I9: table tests ----------------------------------------------------------

def row_count_delta(model: DataFrame, compare: DataFrame, max_pct: float = 10.0) -> DataFrame:
    """One row when |n_model - n_compare| * 100 / n_compare > max_pct.
    An empty comparison table passes (the ratio is NULL). Both counts are
    single aggregates; their one-row results are joined on a constant key."""
    a = model.agg(F.count(F.lit(1)).alias("n_model")).withColumn("_k", F.lit(1))
    b = compare.agg(F.count(F.lit(1)).alias("n_compare")).withColumn("_k", F.lit(1))
    j = a.join(b, "_k").drop("_k")
    pct = (F.abs(F.col("n_model") - F.col("n_compare")).cast("double") * 100.0
           / F.nullif(F.col("n_compare"), F.lit(0)).cast("double"))
    return (j.select("n_model", "n_compare", F.round(pct, 4).alias("delta_pct"))
            .where(F.col("delta_pct") > max_pct))


def freshness(df: DataFrame, loaded_at: str, as_of, warn_hours: float, error_hours: float,
              source: str = "") -> DataFrame:
    """Age of the newest load vs thresholds -> one row with status
    pass / warn / error (error also when the table is empty)."""
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    m = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = ((F.unix_micros(now.cast("timestamp")) -
            F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3_600_000_000.0))
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(F.col("age_hours") > error_hours, "error")
              .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    return (m.select(F.lit(source).alias("source"), "max_loaded_at",
                     F.round(age, 4).alias("age_hours"))
            .withColumn("status", status))


def tenant_sla(df: DataFrame, tenants: DataFrame, loaded_at: str, as_of) -> DataFrame:
    """I8: per tenant, newest load vs the tenant's own ``sla_freshness_hours``;
    failing tenants only (including tenants with no data)."""
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    latest = df.groupBy("tenant_id").agg(F.max(loaded_at).alias("max_loaded_at"))
    t = tenants.select(F.col("tenant_id").alias("_t_id"), "tenant_code", "sla_freshness_hours")
    j = t.join(latest, t["_t_id"] == latest["tenant_id"], "left")
    age = ((F.unix_micros(now.cast("timestamp")) -
            F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3_600_000_000.0))
    return (j.select(F.col("_t_id").alias("tenant_id"), "tenant_code", "sla_freshness_hours",
                     "max_loaded_at", F.round(age, 4).alias("age_hours"))
            .where(F.col("max_loaded_at").isNull()
                   | (F.col("age_hours") > F.col("sla_freshness_hours"))))


def nonempty(df: DataFrame, name: str = "") -> DataFrame:
    """One failing row when the table has no row. Reads at most one row
    per partition (``limit(1)`` before the count)."""
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") == 0).select(F.lit(name).alias("model"),
                                           F.lit(True).alias("is_empty"))


# --- I12-I15: business checks ---------------------------------------------------

def one_current(scd2: DataFrame, source: DataFrame, key: str = "compte_id") -> DataFrame:
    """Keys with more than one current version, or none while the key is
    still in the source (a hard-deleted key legitimately has none)."""
    cur = scd2.groupBy(key).agg(
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).cast("bigint").alias("n_current"))
    src = source.select(F.col(key).alias("_s_key")).distinct().withColumn("_in_src", F.lit(True))
    j = cur.join(src, cur[key] == src["_s_key"], "full_outer")
    return (j.select(F.coalesce(cur[key], src["_s_key"]).alias(key),
                     F.coalesce("n_current", F.lit(0).cast("bigint")).alias("n_current"),
                     F.coalesce("_in_src", F.lit(False)).alias("in_source"))
            .where((F.col("n_current") > 1) | ((F.col("n_current") == 0) & F.col("in_source"))))


def fx_recompute(fact: DataFrame, quotes: DataFrame, source: DataFrame, start, end, tolerance: float = 1e-4,
                 fx_mode: str = "multiply") -> DataFrame:
    """Recompute every EUR amount (all rows, not a sample) and return
    those whose relative error exceeds ``tolerance``.

    The rate comes from the staged quotes, not from the table that the fact
    used: the newest quote of the currency up to the row's day, among those of
    the spine [start, end), 1 for EUR. Rows without one are held against the fallback: the rate of the source row
    (``source``: transaction_id, taux_change_applique), else 1."""
    ranges = Window.partitionBy("devise_cible").orderBy("date_cotation")
    inside = (F.col("date_cotation") >= F.lit(start).cast("date")) & (F.col("date_cotation") < F.lit(end).cast("date"))
    q = (quotes.where("taux is not null and devise_cible <> 'EUR'").where(inside)
         .select(F.col("devise_cible").alias("_ccy"), F.col("date_cotation").alias("_from"), F.col("taux").alias("_taux"),
                 F.coalesce(F.lead("date_cotation").over(ranges), F.lit(end).cast("date")).alias("_next")))
    days = F.sequence(F.trunc("_from", "MM"), F.trunc(F.date_sub("_next", 1), "MM"), F.expr("interval 1 month"))
    by_month = q.where("_next > _from").select("*", F.explode(days).alias("_month"))
    src = source.select(F.col("transaction_id").alias("_id"), "taux_change_applique")
    rows = fact.join(src, fact["transaction_id"] == src["_id"], "left").withColumn("_m", F.trunc("jour_transaction", "MM"))
    j = rows.join(by_month, (F.col("devise") == F.col("_ccy")) & (F.col("_m") == F.col("_month"))
                  & (F.col("jour_transaction") >= F.col("_from")) & (F.col("jour_transaction") < F.col("_next")), "left")
    one = F.lit(1).cast("decimal(18,8)")
    spine = F.col("jour_transaction").between(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    rate = F.when((F.col("devise") == "EUR") & spine, one).otherwise(F.coalesce("_taux", "taux_change_applique", one))
    raw = F.col("montant") * rate if fx_mode == "multiply" else F.col("montant") / rate
    out = j.select("transaction_id", "devise", "jour_transaction", "montant", "montant_eur",
                   F.round(raw, 2).cast("decimal(18,2)").alias("montant_eur_recalcule"))
    diff = F.abs(F.col("montant_eur") - F.col("montant_eur_recalcule"))
    return out.where((diff > F.abs(F.col("montant_eur_recalcule")) * F.lit(tolerance))
                     | (F.col("montant_eur").isNull() != F.col("montant_eur_recalcule").isNull()))


def volume_anomaly(df: DataFrame, ts: str = "date_transaction", days: int = 28,
                   threshold: float = 3.0) -> DataFrame:
    """Daily row counts scored against the trailing ``days`` days. A day
    without rows, between the first and the last, counts 0: an outage shows.

    Counts are aggregated per day first, so the window runs over one row per
    day; it has no partition key because the series is global, and its size
    is bounded by the calendar, not by the data volume."""
    counted = (df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("jour"))
               .agg(F.count(F.lit(1)).alias("n")))
    counted = counted.withColumn("_next", F.lead("jour").over(Window.orderBy("jour")))
    gap = F.when(F.col("_next") > F.date_add("jour", 1), F.sequence(F.date_add("jour", 1), F.date_sub("_next", 1)))
    daily = counted.select(F.inline(F.concat(
        F.array(F.struct(F.col("jour"), F.col("n"))),
        F.transform(F.coalesce(gap, F.array().cast("array<date>")),
                    lambda d: F.struct(d.alias("jour"), F.lit(0).cast("long").alias("n"))))))
    w = Window.orderBy(F.unix_date("jour")).rangeBetween(-days, -1)
    stats = daily.select("jour", "n", F.avg("n").over(w).alias("_m"),
                         F.stddev_samp("n").over(w).alias("_sd"))
    z = F.when(F.col("_sd") > 0, (F.col("n") - F.col("_m")) / F.col("_sd"))
    return (stats.select("jour", "n", F.round("_m", 6).alias("moyenne"),
                         F.round("_sd", 6).alias("ecart_type"), F.round(z, 6).alias("z_score"))
            .where(F.abs(F.col("z_score")) > threshold))


def allocation_sum(bridge: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Accounts with an active link whose allocation factors do not sum to 1."""
    per = bridge.groupBy("compte_id").agg(
        F.sum("allocation_factor").alias("somme_facteurs"),
        F.count(F.when(F.col("is_active") == F.lit(True), 1)).alias("nb_actifs"))
    return per.where((F.col("nb_actifs") > 0) & (F.abs(F.col("somme_facteurs") - 1.0) > tol))


def shares_add_up(shares: DataFrame) -> DataFrame:
    """Accounts whose active holders' shares don't add up to the account's
    volume (``dims.holder_shares``)."""
    per = shares.where(F.col("is_active") == F.lit(True)).groupBy("compte_id").agg(
        F.max("montant_compte_eur").alias("montant_compte_eur"),
        (F.max("montant_compte_eur") - F.sum("part_eur")).cast("decimal(18,2)").alias("ecart_eur"))
    return per.where(F.col("ecart_eur") != 0)


# --- suite ------------------------------------------------------------------------

@dataclass
class Check:
    name: str
    model: str
    column: str | None
    failing: Callable[[], DataFrame]
    severity: str = "error"
    # Row-level tests may also give the model frame and the failing-row
    # predicate, so the suite can count several tests in one scan.
    frame: Callable[[], DataFrame] | None = None
    predicate: Column | None = None


def _report_row(c: Check, n: Column) -> Column:
    return F.struct(F.lit(c.name).alias("test_name"), F.lit(c.model).alias("model"),
                    F.lit(c.column).cast("string").alias("column_name"),
                    F.lit(c.severity).alias("severity"), n.cast("bigint").alias("n_failures"))


def store_failures(checks: list[Check], report: DataFrame, path: str) -> list[str]:
    """Write the failing rows of every test that fails, a folder per test, and
    return those tests. The report (one row per test) is what is looked at.
    Rows that an earlier run stored for tests of the suite that pass now go."""
    failed = {r["test_name"] for r in report.where("n_failures > 0").select("test_name").collect()}
    for c in checks:
        if c.name in failed:
            c.failing().write.mode("overwrite").parquet(f"{path}/{c.name}")
        else:
            remove_path(report.sparkSession, f"{path}/{c.name}")
    return sorted(failed)


def run_suite(checks: list[Check]) -> DataFrame:
    """Report: one row per check with its failure count and status.

    Row-level checks of one model are conditional counts in a single
    aggregate (one scan per model); the others (uniqueness, relationships)
    count their failing-row frames. Everything is unioned into one plan, so
    the suite is one Spark job and only the report reaches a caller."""
    parts = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.frame is not None and c.predicate is not None:
            by_model.setdefault(c.model, []).append(c)
        else:
            parts.append(c.failing().agg(F.count(F.lit(1)).alias("_n"))
                         .select(F.inline(F.array(_report_row(c, F.col("_n"))))))
    for cs in by_model.values():
        agg = cs[0].frame().agg(*[F.count(F.when(c.predicate, F.lit(1))).alias(f"_c{i}")
                                  for i, c in enumerate(cs)])
        parts.append(agg.select(F.inline(F.array(*[_report_row(c, F.col(f"_c{i}"))
                                                   for i, c in enumerate(cs)]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("n_failures") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return out.withColumn("status", status)
