"""Bulk load: each row is checked where it is parsed; files of one table only."""

import uuid

from ledgerline.plans import load_fixture
from ledgerline.session import path_exists, scratch_dir
from ledgerline.sources import loader
from ledgerline.sources.adapters import RawTables

SCHEMA = [("id", "BIGINT"), ("amount", "DECIMAL(10,2)"), ("label", "STRING"), ("_loaded_at", "TIMESTAMP_NTZ")]


def written(spark, files: int) -> str:
    path = scratch_dir(spark, f"load-{uuid.uuid4().hex}")
    for n in range(files):
        rows = [("id,amount,label",), (f" {n} ,1.50, a ",), (f"{n + 100},abc,null",), (f"{n + 200}",)]
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").option("compression", "gzip").text(path)
    return path


def test_checked_rows_do_not_move(spark):
    """Rejects and history come from the scan; the good rows are spread only
    where there are fewer files than tasks asked for."""
    for files, spread in ((2, True), (5, False)):
        got = loader.load_csv(spark, written(spark, files), SCHEMA, "2002-01-01 02:00:00", repartition=4)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan(got.rejects) and "RoundRobin" not in plan(got.history)
        assert ("RoundRobin" in plan(got.good)) == spread
        assert sorted((r["id"], r["label"]) for r in got.good.collect()) == sorted(
            [(n, "a") for n in range(files)] + [(n + 200, None) for n in range(files)])
        assert {(r["id"], r["amount"], r["_error_columns"]) for r in got.rejects.collect()} == {
            (f"{n + 100}", "abc", "amount") for n in range(files)}
        assert [tuple(r)[1:5] for r in got.history.collect()] == [("PARTIALLY_LOADED", 2, 3, 1)] * files


def test_fixture_writes_the_table_asked_for(spark, tmp_path):
    """One table's files, each with a header, without Python in the write."""
    for t in ("nation", "orders"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{tmp_path.name}/{t}.parquet")
    raw = RawTables(spark, f"{tmp_path}/{tmp_path.name}")
    path = load_fixture.build_load_fixture(raw, "raw_tenants")
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert sum(x.startswith("tenant_id,") for x in lines) == len(spark.read.text(path).inputFiles())
    assert len(lines) == raw.tenants().count() + len(spark.read.text(path).inputFiles())
    assert not path_exists(spark, path.replace("tenants", "transactions"))
