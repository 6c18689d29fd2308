"""SCD2 snapshot with the check strategy (F8) and hard-delete invalidation.

One full outer join of the *open* versions with the current source on the
key. Closed versions pass through untouched (they never join), so the shuffle
is proportional to the number of live keys, not to the history length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import ts_text

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def scd_id(key: str, ts: Column) -> Column:
    """Row key of a version: md5(key || '|' || fixed-format timestamp)."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), ts_text(ts)))


def snapshot_check(history: DataFrame | None, current: DataFrame, key: str,
                   check_cols: list[str], as_of, hard_deletes: bool = True) -> DataFrame:
    """Return the new history after one snapshot run at ``as_of``.

    * new key -> open a version (valid_from = as_of, valid_to NULL);
    * any check column changed (NULL-safe) -> close the open version
      (valid_to = as_of) and open a new one;
    * unchanged -> nothing, even if unchecked columns changed;
    * key gone from the source -> close its open version (``hard_deletes``);
      a key that comes back later opens a fresh version.
    """
    ts = F.lit(str(as_of)).cast("timestamp_ntz")
    src_cols = current.columns
    opened_new = current.select(*src_cols, scd_id(key, ts).alias("dbt_scd_id"),
                                ts.alias("dbt_updated_at"), ts.alias("dbt_valid_from"),
                                F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))
    if history is None:
        return opened_new
    out_cols = history.columns
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    open_ = (history.where(F.col("dbt_valid_to").isNull())
             .select(*[F.col(c).alias("_o_" + c) for c in out_cols]).withColumn("_in_o", F.lit(True)))
    cur = current.select(*[F.col(c).alias("_c_" + c) for c in src_cols]).withColumn("_in_c", F.lit(True))
    j = open_.join(cur, F.col("_o_" + key) == F.col("_c_" + key), "full_outer")
    in_o, in_c = F.col("_in_o").isNotNull(), F.col("_in_c").isNotNull()
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col("_o_" + c).eqNullSafe(F.col("_c_" + c))
    changed = in_o & in_c & changed
    gone = in_o & ~in_c
    # History side: kept as is, or closed now.
    close_now = changed | (gone if hard_deletes else F.lit(False))
    old_side = j.where(in_o).select(
        *[F.col("_o_" + c).alias(c) for c in out_cols if c != "dbt_valid_to"],
        F.when(close_now, ts).otherwise(F.col("_o_dbt_valid_to")).alias("dbt_valid_to"))
    # Source side: a new version for new or changed keys.
    new_side = j.where(in_c & (~in_o | changed)).select(
        *[F.col("_c_" + c).alias(c) for c in src_cols]).select(
        *src_cols, scd_id(key, ts).alias("dbt_scd_id"),
        ts.alias("dbt_updated_at"), ts.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))
    return (closed.select(*out_cols)
            .unionByName(old_side.select(*out_cols))
            .unionByName(new_side.select(*out_cols)))


def snapshot_changes(open_versions: DataFrame, current: DataFrame, key: str, check_cols: list[str], as_of,
                     hard_deletes: bool = True) -> DataFrame:
    """What one run adds to a stored history: the versions it closes and the
    ones it opens, with ``dbt_valid_to`` telling them apart. Unchanged versions
    don't appear. One full outer join of the open versions with the source; a
    joined row gives at most one closed and one opened version."""
    ts = F.lit(str(as_of)).cast("timestamp_ntz")
    cols, src = open_versions.columns, current.columns
    o = open_versions.select(F.struct(*cols).alias("o"), F.col(key).alias("_ok"))
    c = current.select(F.struct(*src).alias("c"), F.col(key).alias("_ck"))
    j = o.join(c, F.col("_ok") == F.col("_ck"), "full_outer").drop(key)
    in_o, in_c = F.col("o").isNotNull(), F.col("c").isNotNull()
    differs = F.lit(False)
    for x in check_cols:
        differs = differs | ~F.col(f"o.{x}").eqNullSafe(F.col(f"c.{x}"))
    closes = in_o & ((in_c & differs) | (~in_c & F.lit(hard_deletes)))
    opens = in_c & (~in_o | differs)
    typed = {f.name: f.dataType for f in open_versions.schema.fields}
    closed = F.struct(*[(ts if x == "dbt_valid_to" else F.col(f"o.{x}")).cast(typed[x]).alias(x) for x in cols])
    fresh_id = F.md5(F.concat_ws("|", F.col(f"c.{key}").cast("string"), ts_text(ts)))
    meta = {"dbt_scd_id": fresh_id, "dbt_updated_at": ts, "dbt_valid_from": ts, "dbt_valid_to": F.lit(None)}
    opened = F.struct(*[(meta[x] if x in meta else F.col(f"c.{x}") if x in src else F.lit(None)).cast(typed[x]).alias(x) for x in cols])
    both = F.array(F.when(closes, closed), F.when(opens, opened))
    return j.select(F.inline(F.filter(both, lambda v: v.isNotNull())))
