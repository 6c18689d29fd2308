"""The reference's unit tests of the transaction staging model."""

import datetime as dt
from decimal import Decimal

from helpers import raw_frame, rows_by
from ledgerline import schemas as S
from ledgerline.operators.staging import stg_transactions


def tx(i, amount, op, ts, is_test=False, **kw):
    return {"transaction_id": i, "tenant_id": 1, "compte_id": 100, "montant": Decimal(amount),
            "type_operation": op, "date_transaction": ts, "statut": "validee",
            "is_test": is_test, "devise": "EUR", "montant_eur": Decimal(amount), **kw}


def test_credit_is_positive(spark):
    df = raw_frame(spark, S.RAW_TRANSACTIONS, [tx(1, "500.00", "credit", dt.datetime(2024, 1, 1, 9))])
    r = rows_by(stg_transactions(df), "transaction_id")[1]
    assert r.montant_signe == Decimal("500.00")


def test_debit_is_negative(spark):
    df = raw_frame(spark, S.RAW_TRANSACTIONS, [tx(2, "250.00", "debit", dt.datetime(2024, 1, 1, 10))])
    r = rows_by(stg_transactions(df), "transaction_id")[2]
    assert r.montant_signe == Decimal("-250.00")


def test_test_rows_excluded(spark):
    df = raw_frame(spark, S.RAW_TRANSACTIONS, [
        tx(3, "100.00", "credit", dt.datetime(2024, 1, 1), is_test=True),
        tx(4, "200.00", "credit", dt.datetime(2024, 1, 1), is_test=False)])
    out = rows_by(stg_transactions(df), "transaction_id")
    assert set(out) == {4} and out[4].montant == Decimal("200.00")


def test_other_operation_has_no_sign_and_case_is_normalised(spark):
    df = raw_frame(spark, S.RAW_TRANSACTIONS, [
        tx(5, "10.00", "AUTRE", dt.datetime(2024, 1, 1), devise="usd", statut="VALIDEE")])
    r = rows_by(stg_transactions(df), "transaction_id")[5]
    assert r.montant_signe is None and r.devise == "USD" and r.statut == "validee"
    assert r.frais == Decimal("0.00")
