"""Small helpers for building typed test frames."""

from ledgerline import schemas as S


def raw_frame(spark, schema, rows: list[dict]):
    """Typed frame with the given schema; columns a row does not list are NULL
    (the convention of the reference's unit tests)."""
    names = [n for n, _ in schema]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, S.struct(schema))


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}
