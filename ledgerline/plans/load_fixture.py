"""Load fixture: raw tables written by Spark as gzip CSV, with bad records.

The file content is derived from the driver tables (the raw adapters), so it
grows with the scale factor. Records are built as text so the fixture can
hold what a real export holds: blank and NULL tokens, padded values, quoted
commas, short and long records and values that do not cast. Every file
starts with a header line (prepended per partition). A table's files are
written when a query first loads that table.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.session import scratch_dir
from ledgerline.sources.adapters import RawTables

LOAD_TS = "2002-01-01 02:00:00"

# Fixed corruption rules of the transactions file, by transaction id.
# (column, condition, text) — text replaces the column's value.
TX_CORRUPTIONS = [
    ("montant", "transaction_id % 97 = 0", "'abc'"),
    ("date_transaction", "transaction_id % 89 = 0", "'2024-13-45 99:99:99'"),
    ("frais", "transaction_id % 83 = 0", "'NULL'"),
    ("marchand_categorie", "transaction_id % 61 = 0", "'null'"),
    ("canal", "transaction_id % 59 = 0", "''"),
    ("statut", "transaction_id % 79 = 0", "'  ' || statut || '  '"),
    ("marchand_nom", "transaction_id % 73 = 0", "marchand_nom || ', \"Big\"'"),
]
SHORT_RECORD = "transaction_id % 71 = 0"   # last 3 fields missing
LONG_RECORD = "transaction_id % 67 = 0 AND transaction_id % 71 <> 0"  # one extra field
SHORT_DROP = 3


def _text(name: str, typ: str) -> str:
    if typ == S.TS:
        return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') || '+00:00'"
    if typ == S.B:
        return f"CASE WHEN {name} THEN 'True' WHEN NOT {name} THEN 'False' END"
    return f"CAST({name} AS STRING)"


def _quoted(c: Column) -> Column:
    needs = (F.instr(c, ",") > 0) | (F.instr(c, '"') > 0)
    return F.when(needs, F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))).otherwise(c)


def csv_lines(df: DataFrame, schema: list[tuple[str, str]], corruptions=(),
              short: str | None = None, long: str | None = None) -> DataFrame:
    cols = [(n, t) for n, t in schema if n != "_loaded_at"]
    rules = {}
    for col, cond, text in corruptions:
        rules[col] = f"CASE WHEN {cond} THEN {text} ELSE {_text(col, dict(cols)[col])} END"
    fields = [_quoted(F.expr(rules.get(n, _text(n, t)))) for n, t in cols]
    fields = [F.coalesce(f, F.lit("")) for f in fields]
    full = F.concat_ws(",", *fields)
    line = full
    if short:
        line = F.when(F.expr(short), F.concat_ws(",", *fields[:-SHORT_DROP])).otherwise(line)
    if long:
        line = F.when(F.expr(long), F.concat(line, F.lit(",EXTRA"))).otherwise(line)
    return df.select(line.alias("value"))


#: ``monotonically_increasing_id`` numbers the rows of a partition in its lower bits.
_ROW_IN_PARTITION = (1 << 33) - 1


def write_csv(df: DataFrame, schema: list[tuple[str, str]], path: str, **kw) -> str:
    """One gzip file per partition; the header goes before its first row."""
    header = ",".join(n for n, _ in schema if n != "_loaded_at")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)) == 0
    lines = csv_lines(df, schema, **kw).select(
        F.when(first, F.concat(F.lit(f"{header}\n"), "value")).otherwise(F.col("value")).alias("value"))
    lines.write.mode("overwrite").option("compression", "gzip").text(path)
    return path


def build_load_fixture(raw: RawTables, table: str) -> str:
    """Write the file of one raw table; returns its path, in the shared
    checkpoint folder, keyed by the scale-factor folder name."""
    base = scratch_dir(raw.spark, os.path.join("load-fixture", os.path.basename(raw.sf_dir)))
    name = table.removeprefix("raw_")
    bad = dict(corruptions=TX_CORRUPTIONS, short=SHORT_RECORD, long=LONG_RECORD) if name == "transactions" else {}
    return write_csv(getattr(raw, name)(), S.RAW_SCHEMAS[table], f"{base}/{name}", **bad)


# --- expected result of the load (oracle side) --------------------------------------

def expected_transactions_sql() -> str:
    """DuckDB: the typed rows the loader must keep from the transactions file."""
    over = {
        "frais": "CASE WHEN transaction_id % 83 = 0 THEN NULL ELSE frais END",
        "marchand_categorie": "CASE WHEN transaction_id % 61 = 0 THEN NULL ELSE marchand_categorie END",
        "canal": "CASE WHEN transaction_id % 59 = 0 THEN NULL ELSE canal END",
        "marchand_nom": "CASE WHEN transaction_id % 73 = 0 THEN marchand_nom || ', \"Big\"' ELSE marchand_nom END",
        "_loaded_at": f"CAST('{LOAD_TS}' AS TIMESTAMP)",
    }
    file_cols = [n for n, _ in S.RAW_TRANSACTIONS if n != "_loaded_at"]
    for n in file_cols[-SHORT_DROP:]:
        over[n] = f"CASE WHEN {SHORT_RECORD} THEN NULL ELSE {n} END"
    sel = ", ".join(f"{over.get(n, n)} AS {n}" for n, _ in S.RAW_TRANSACTIONS)
    return (f"SELECT {sel} FROM raw_transactions "
            f"WHERE NOT (transaction_id % 97 = 0 OR transaction_id % 89 = 0)")


def expected_rejects_sql() -> str:
    return ("SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, "
            "CASE WHEN transaction_id % 89 = 0 AND transaction_id % 97 = 0 THEN 'date_transaction,montant' "
            "WHEN transaction_id % 89 = 0 THEN 'date_transaction' ELSE 'montant' END AS _error_columns "
            "FROM raw_transactions WHERE transaction_id % 97 = 0 OR transaction_id % 89 = 0")
