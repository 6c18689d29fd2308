"""Hot accounts: z-score frames and holder shares."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dims, marts
from ledgerline.operators import quality as Q


def frames(rows, days=90):
    """(count, mean) of the rows in [t - days, t) of the same account."""
    out = {}
    for i, k, t, _ in rows:
        own = [v for _, k2, u, v in rows if k2 == k and k is not None and t is not None and u is not None
               and t - dt.timedelta(days=days) <= u < t and v is not None]
        out[i] = (len(own), sum(own) / len(own) if own else None)
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, k, t, None if v is None else Decimal(str(v))) for i, k, t, v in rows],
                                 "transaction_id long, compte_id long, date_transaction timestamp_ntz, montant_eur decimal(18,2)")


@pytest.mark.parametrize("spread", ["one_day", "one_instant", "window_edges"])
def test_zscore_of_a_hot_account(spark, spread):
    """All rows on one account and day, at one instant, or about the frame's
    ends; the frames as counted row by row, z as by the bucketed form."""
    draw, day = random.Random(3), dt.datetime(2024, 3, 5)
    at = {"one_day": lambda k: day + dt.timedelta(microseconds=draw.randrange(86_400_000_000)),
          "one_instant": lambda k: day + dt.timedelta(hours=k // 100),
          "window_edges": lambda k: day + dt.timedelta(days=draw.choice([0, 1, 89, 90, 91, 180]), microseconds=draw.choice([-1, 0, 1]))}[spread]
    rows = [(k, 1 if k % 50 else 2, at(k), round(draw.uniform(-50, 500), 2)) for k in range(400)]
    rows += [(900, None, day, 5.0), (901, 1, None, 5.0), (902, 3, day, None), (903, 3, day + dt.timedelta(hours=1), 5.0)]
    found = {r["transaction_id"]: r for r in marts.rolling_zscore_blocks(table(spark, rows)).collect()}
    want = frames(rows)
    assert set(found) == set(want)
    for i, (n, mean) in want.items():
        got = found[i]["moyenne_90j"]
        assert (got is None) == (n == 0) and (not n or abs(float(got) - mean) < 1e-4), (i, n)
    plain = [r for r in rows if r[1] is not None and r[2] is not None and r[3] is not None]
    other = {r["transaction_id"]: r["z_score"] for r in marts.rolling_zscore(table(spark, plain), bucket_days=30).collect()}
    again = {r["transaction_id"]: r["z_score"] for r in marts.rolling_zscore_blocks(table(spark, plain)).collect()}
    for i, z in other.items():
        assert (z is None) == (again[i] is None) and (z is None or abs(z - again[i]) < 1e-4)


def test_windows_of_the_zscore_are_bounded(spark):
    """Every window is over the days of an account, the seconds of a day or
    the instants of a second."""
    plan = marts.rolling_zscore_blocks(table(spark, [(1, 1, dt.datetime(2024, 1, 1), 1.0)]))._jdf.queryExecution().optimizedPlan().toString()
    keys = {tuple(sorted(c.split("#")[0].strip() for c in line.rsplit("], [", 2)[1].strip("[]").split(",")))
            for line in plan.splitlines() if "+- Window [" in line}
    assert keys == {("_k",), ("_day", "_k"), ("_day", "_k", "_sec")}


def test_shares_add_up_to_the_cent(spark):
    """100.00 among three holders, a negative total, one holder, links that
    are inactive or of unknown state, an account without active links."""
    totals = {1: "100.00", 2: "-0.05", 3: "7.77", 4: "0.01", 5: "12.00", 6: "3.10"}
    fact = spark.createDataFrame([(k, Decimal(v)) for k, v in totals.items()] + [(1, Decimal("0.00"))],
                                 "compte_id long, montant_eur decimal(18,2)")
    links = [(1, 1, 30, True), (2, 1, 10, True), (3, 1, 20, True), (4, 2, 10, True), (5, 2, 20, True), (6, 2, 30, True), (7, 3, 10, True),
             (8, 3, 40, False), (9, 4, 10, True), (10, 4, 20, True), (11, 5, 50, False), (12, 6, 10, True), (13, 6, 60, None)]
    bridge = spark.createDataFrame(links, "bridge_id long, compte_id long, titulaire_id long, is_active boolean").withColumn(
        "allocation_factor", F.lit(1.0))
    shares = dims.holder_shares(fact, bridge)
    got = {(r["compte_id"], r["titulaire_id"]): r["part_eur"] for r in shares.collect()}
    assert {k: str(v) for k, v in got.items() if k[0] == 1} == {(1, 10): "33.34", (1, 20): "33.33", (1, 30): "33.33"}
    assert {k: str(v) for k, v in got.items() if k[0] == 2} == {(2, 10): "-0.02", (2, 20): "-0.02", (2, 30): "-0.01"}
    assert got[3, 10] == Decimal("7.77") and got[3, 40] == 0 and got[5, 50] == 0 and got[4, 10] + got[4, 20] == Decimal("0.01")
    assert Q.shares_add_up(shares).count() == 0
    broken = shares.withColumn("part_eur", F.when(F.col("titulaire_id") == 20, 0).otherwise(F.col("part_eur")).cast("decimal(18,2)"))
    assert {r["compte_id"] for r in Q.shares_add_up(broken).collect()} == {1, 2}
