"""Column-level helpers (scalar functions of §2.12), all built-in expressions.

Nothing here is a Python UDF: every helper returns a Catalyst ``Column`` so
it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the surrogate-key convention (public dbt_utils behaviour).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
# One fixed text form for timestamps inside hashes.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_text(col) -> Column:
    return F.date_format(_c(col), TS_TEXT_FORMAT)


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined string forms, NULL replaced by a fixed token.
    Pass timestamps through ``ts_text`` first so the text form is fixed."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def signed(kind: Column, amount: Column) -> Column:
    """credit -> +x, debit -> -x, anything else -> NULL (no otherwise)."""
    return F.when(kind == "credit", amount).when(kind == "debit", -amount)


def day_diff(start, end) -> Column:
    """Day boundaries crossed from start to end (warehouse datediff('day'))."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def month_diff(start, end) -> Column:
    """Month boundaries crossed (warehouse datediff('month')), not full months."""
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("bigint")


def trunc_date(unit: str, col) -> Column:
    """date_trunc to a DATE ('week' starts on Monday)."""
    return F.date_trunc(unit, _c(col)).cast("date")


def pct(num, den, scale: int = 2) -> Column:
    """round(100 * num / nullif(den, 0), scale) as DECIMAL(9, scale), exact
    decimal arithmetic (ANSI division by zero is avoided by nullif)."""
    n = _c(num).cast("decimal(20,0)")
    d = F.nullif(_c(den).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(n * F.lit(100) / d, scale).cast(f"decimal(9,{scale})")


def money(col, p: int = 18) -> Column:
    return _c(col).cast(f"decimal({p},2)")
