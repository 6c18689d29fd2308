"""Dense balances: amounts have their type before they expand to days."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators import marts


def test_days_copy_amounts(spark):
    day = lambda n: dt.date(2024, 1, n)
    fact = spark.createDataFrame(
        [(1, 7, "validee", day(2), 10.5), (1, 7, "validee", day(5), -4.25), (1, 8, "rejetee", day(1), 9.0), (1, 9, "validee", day(9), 1.0)],
        "tenant_id long, compte_id long, statut string, jour_transaction date, m double").selectExpr("*", "cast(m as decimal(15,2)) montant_signe_eur")
    transfers = spark.createDataFrame([(1, 7, dt.datetime(2024, 1, 5), "sortant", 1.0)],
                                      "tenant_id long, compte_id long, date_virement timestamp_ntz, virement_leg string, m double").selectExpr(
        "*", "cast(m as decimal(15,2)) montant")
    accounts = spark.createDataFrame([(1, 7, 100.0), (1, 8, 1.0), (1, 9, 2.0)], "tenant_id long, compte_id long, m double").selectExpr(
        "tenant_id", "compte_id", "cast(m as decimal(15,2)) solde_initial")
    dense = marts.mart_solde_dense(fact, transfers, accounts, "2024-01-08")
    got = [tuple(r)[1:] for r in dense.orderBy("compte_id", "jour").collect()]
    flow, balance = {2: "10.50", 5: "-5.25"}, {2: "110.50", 3: "110.50", 4: "110.50"}
    assert got == [(7, day(n), Decimal(flow.get(n, "0.00")), Decimal(balance.get(n, "105.25"))) for n in range(2, 8)]
    assert [f.dataType.simpleString() for f in dense.schema][3:] == ["decimal(18,2)"] * 2
    per_day = dense._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[0]
    assert "cast(" not in per_day
