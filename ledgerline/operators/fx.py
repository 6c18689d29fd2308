"""Date spine and FX densification.

The reference builds a (currency x day) grid with a cross join, left-joins the
quotes and forward-fills with ``last_value(... ignore nulls)``. Here the same
rows come from the quotes themselves: each quote is expanded over the days up
to (not including) the currency's next quote, clipped to the spine. No grid,
no cross join; the only shuffle is one window by currency, whose partitions
hold one row per quoted day (bounded by the spine length, not by data volume).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _d(x) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x))


def spine_days(start, end) -> int:
    return (_d(end) - _d(start)).days


def date_spine(spark: SparkSession, start, end, col: str = "date_day") -> DataFrame:
    """One row per day in [start, end) (end exclusive), distributed via
    ``spark.range`` rather than a single exploded array."""
    n = spine_days(start, end)
    return spark.range(n).select(
        F.date_add(F.lit(_d(start)), F.col("id").cast("int")).alias(col))


def densify_ffill(df: DataFrame, keys: list[str], date_col: str, value_col: str,
                  start, end) -> DataFrame:
    """C2+C3: last observation carried forward over [start, end) per key.

    Days before a key's first observation produce no row; observations outside
    the spine are ignored; NULL values do not interrupt the carry. Observations
    of one key and day stay on that day, each a row; the last one is carried.
    """
    start_d, last_d = _d(start), _d(end) - dt.timedelta(days=1)
    obs = (df.where(F.col(value_col).isNotNull()
                    & F.col(date_col).between(F.lit(start_d), F.lit(last_d)))
           .select(*keys, date_col, value_col))
    w = Window.partitionBy(*keys).orderBy(date_col)
    nxt = F.lead(date_col).over(w)
    upto = F.when(nxt.isNull(), F.lit(last_d)).otherwise(F.greatest(F.date_sub(nxt, 1), F.col(date_col)))
    return (obs.withColumn("_upto", upto)
            .select(*keys, F.explode(F.sequence(F.col(date_col), F.col("_upto"))).alias(date_col),
                    value_col))


def fx_rates_daily(stg_fx: DataFrame, start, end) -> DataFrame:
    """int_fx_rates_daily (date_cotation, devise_source, devise_cible, taux).

    As in the reference the quote's source currency is not read: every row is
    an EUR quote, and an EUR -> EUR identity row is added for each spine day.
    """
    spark = stg_fx.sparkSession
    filled = (densify_ffill(stg_fx, ["devise_cible"], "date_cotation", "taux", start, end)
              .select("date_cotation", F.lit("EUR").alias("devise_source"), "devise_cible",
                      F.col("taux").cast("decimal(18,8)").alias("taux")))
    eur = date_spine(spark, start, end, "date_cotation").select(
        "date_cotation", F.lit("EUR").alias("devise_source"), F.lit("EUR").alias("devise_cible"),
        F.lit(1).cast("decimal(18,8)").alias("taux"))
    return filled.unionByName(eur)


def fx_for_join(fx_daily: DataFrame) -> DataFrame:
    """The (day, currency) -> rate side of the fact's FX join.

    Q16: a second rate for a day and currency would double the fact's rows, so
    the job fails when there is one."""
    side = fx_daily.groupBy("date_cotation", F.col("devise_cible").alias("fx_devise")).agg(
        F.max("taux").alias("taux"), F.count(F.lit(1)).alias("_n"))
    message = F.concat_ws(" ", F.lit("more than one rate for"), F.col("date_cotation").cast("string"), "fx_devise")
    return side.where(F.when(F.col("_n") > 1, F.raise_error(message)).isNull()).drop("_n")


def spine_between(df: DataFrame, date_col: str, col: str = "date_day") -> DataFrame:
    """C1 over the data's own range: every day from min to max of ``date_col``.

    The bounds come from one global aggregate (partial per task, a single
    row after the exchange); the expansion is bounded by the calendar range,
    not by the row count.
    """
    b = df.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi")).alias(col))
