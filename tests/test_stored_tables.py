"""Stored tables: versions, null partitions, moved keys, new columns, deletes,
duplicate keys, emptied days, contracts; and the data checks' blind spots."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import fx, incremental as inc, quality as Q
from ledgerline.session import scratch_dir
from ledgerline.sources import tables

SCHEMA = "id int, part string, v string, at timestamp_ntz"


@pytest.fixture
def path(spark):
    return scratch_dir(spark, f"stored-{uuid.uuid4().hex}")


def frame(spark, rows, schema=SCHEMA):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(*r, day) if schema == SCHEMA else r for r in rows], schema)


def content(spark, path):
    return sorted((r["id"], r["part"], r["v"]) for r in tables.read_table(spark, path).collect())


def test_null_partition_keeps_its_rows(spark, path):
    tables.write_table(frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, None, "x")]), path, ["part"])
    touched = tables.upsert_table(spark, path, frame(spark, [(9, None, "y"), (2, "b", "y")]), "id", "part", ["v"])
    assert touched == [None, "b"] or touched == ["b", None]
    assert content(spark, path) == [(1, "a", "x"), (2, "b", "y"), (3, None, "x"), (9, None, "y")]


def test_known_key_in_another_partition_stays_one_row(spark, path):
    tables.write_table(frame(spark, [(1, "jan", "a"), (2, "feb", "a")]), path, ["part"])
    tables.upsert_table(spark, path, frame(spark, [(1, "feb", "b")]), "id", "part", ["v"])
    assert content(spark, path) == [(1, "jan", "b"), (2, "feb", "a")]
    tables.upsert_table(spark, path, frame(spark, [(1, "feb", "c")]), "id", "part")  # all columns: it moves
    assert content(spark, path) == [(1, "feb", "c"), (2, "feb", "a")]


def test_new_column_survives(spark, path):
    tables.write_table(frame(spark, [(1, "a", "x"), (2, "b", "x")]), path, ["part"])
    tables.upsert_table(spark, path, frame(spark, [(8, "a", "y")]).withColumn("extra", F.lit("Y")), "id", "part", ["v"])
    tables.upsert_table(spark, path, frame(spark, [(1, "a", "z")]), "id", "part", ["v"])
    rows = {r["id"]: r for r in tables.read_table(spark, path).collect()}
    assert rows[8]["extra"] == "Y" and rows[1]["extra"] is None and rows[2]["extra"] is None and rows[1]["v"] == "z"


def test_duplicate_keys_in_the_delta_raise(spark, path):
    tables.write_table(frame(spark, [(1, "a", "x")]), path, ["part"])
    twice = frame(spark, [(1, "a", "y"), (1, "a", "z")])
    with pytest.raises(inc.DuplicateKeyError):
        tables.upsert_table(spark, path, twice, "id", "part", ["v"])
    assert content(spark, path) == [(1, "a", "x")]
    for plan in ("left", "outer"):
        with pytest.raises(Exception, match="more than once"):
            inc.merge(tables.read_table(spark, path), twice, "id", ["v"], plan=plan).collect()


def test_delete_keys_and_empty_partition(spark, path):
    tables.write_table(frame(spark, [(1, "a", "x"), (2, "b", "x")]), path, ["part"])
    tables.upsert_table(spark, path, frame(spark, []), "id", "part", ["v"],
                        delete_keys=frame(spark, [(2, "b", "x")]).select("id"))
    assert content(spark, path) == [(1, "a", "x")]
    assert list(tables.table_state(spark, path)["live"]) == ["a"]


def test_emptied_day_goes(spark, path):
    days = [(1, "2024-01-01", "x"), (2, "2024-01-02", "x"), (3, "2024-01-03", "x"), (4, None, "x")]
    tables.write_table(frame(spark, days), path, ["part"])
    tables.replace_days(frame(spark, [(7, "2024-01-02", "y")]), path, "part", "2024-01-01", "2024-01-03")
    assert content(spark, path) == [(3, "2024-01-03", "x"), (4, None, "x"), (7, "2024-01-02", "y")]
    with pytest.raises(ValueError):
        tables.replace_days(frame(spark, [(7, "2024-02-02", "y")]), path, "part", "2024-01-01", "2024-01-03")


def test_failed_write_leaves_the_table(spark, path):
    """Files of a run that died before its record are not seen; the next
    write works; a sweep deletes what is replaced or in no record."""
    tables.write_table(frame(spark, [(1, "a", "x")]), path, ["part"])
    frame(spark, [(5, "a", "lost")]).withColumn("ver", F.lit("dead")).write.mode("append").partitionBy(
        "part", "ver").parquet(f"{path}/data")
    assert content(spark, path) == [(1, "a", "x")]
    tables.upsert_table(spark, path, frame(spark, [(2, "a", "y")]), "id", "part", ["v"])
    assert content(spark, path) == [(1, "a", "x"), (2, "a", "y")]
    live = tables.table_state(spark, path)["live"]["a"]
    found = lambda: {r["ver"] for r in spark.read.parquet(f"{path}/data").select("ver").distinct().collect()}
    assert len(found()) == 3 and {"dead", *live} < found()
    tables.sweep(spark, path, keep=0)
    assert found() == set(live) and content(spark, path) == [(1, "a", "x"), (2, "a", "y")]


def test_open_reader_finishes(spark, path):
    """A frame opened before a rebuild and an upsert reads its own version."""
    tables.write_table(frame(spark, [(1, "a", "x"), (2, "b", "x")]), path, ["part"])
    before = tables.read_table(spark, path)
    tables.write_table(frame(spark, [(7, "a", "n")]), path, ["part"])
    tables.upsert_table(spark, path, frame(spark, [(7, "a", "m")]), "id", "part", ["v"])
    assert sorted(r["id"] for r in before.collect()) == [1, 2]
    assert content(spark, path) == [(7, "a", "m")]
    tables.sweep(spark, path, keep=0)
    assert content(spark, path) == [(7, "a", "m")] and len(tables._state_files(spark, path)) == 1


def test_refused_write_leaves_nothing(spark, path):
    """Rows outside of the range: no commit, and no file after a sweep."""
    tables.write_table(frame(spark, [(1, "2024-01-01", "x")]), path, ["part"])
    files = lambda: len(spark.read.parquet(f"{path}/data").inputFiles())
    n, version = files(), tables.table_state(spark, path)["version"]
    for bad in ("2024-03-05", None):
        with pytest.raises(ValueError, match="rows outside of"):
            tables.replace_days(frame(spark, [(5, "2024-01-02", "y"), (6, bad, "y")]), path, "part", "2024-01-02", "2024-01-04")
    assert tables.table_state(spark, path)["version"] == version
    tables.sweep(spark, path, keep=0)
    assert files() == n and content(spark, path) == [(1, "2024-01-01", "x")]


def test_replaced_days_keep_new_columns_and_raise_the_watermark(spark, path):
    tables.write_table(frame(spark, [(1, "2024-01-01", "x"), (2, "2024-01-02", "x")]), path, ["part"], watermark_col="at")
    batch = frame(spark, [(3, "2024-01-02", "y")]).withColumn("extra", F.lit("new")).withColumn(
        "at", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    tables.replace_days(batch, path, "part", "2024-01-02", "2024-01-03")
    assert {r["id"]: r["extra"] for r in tables.read_table(spark, path).collect()} == {1: None, 3: "new"}
    assert tables.table_watermark(spark, path, "at") == dt.datetime(2024, 3, 1)
    tables.replace_days(frame(spark, [(4, "2024-01-01", "z")]), path, "part", "2024-01-01", "2024-01-02")
    assert {r["id"]: r["extra"] for r in tables.read_table(spark, path).collect()} == {4: None, 3: "new"}
    assert tables.table_watermark(spark, path, "at") == dt.datetime(2024, 3, 1)


def test_every_write_is_gated(spark, path):
    """The contract and the recorded schema hold for upserts, day
    batches and appended rows."""
    good = frame(spark, [(1, "2024-01-01", "x")])
    tables.write_table(good, path, ["part"], contract=good.schema)
    wider = good.withColumn("extra", F.lit(1))
    retyped = good.withColumn("v", F.lit(5))
    version = tables.table_state(spark, path)["version"]
    for write in (lambda d: tables.upsert_table(spark, path, d, "id", "part"),
                  lambda d: tables.replace_days(d, path, "part", "2024-01-01", "2024-01-02"),
                  lambda d: tables.append_rows(d, path, "part"), lambda d: tables.write_table(d, path, ["part"])):
        with pytest.raises(tables.ContractError, match="extra: unexpected"):
            write(wider)
    other = f"{path}-free"
    tables.write_table(good, other, ["part"])
    for write in (lambda d: tables.replace_days(d, other, "part", "2024-01-01", "2024-01-02"),
                  lambda d: tables.append_rows(d, other, "part"), lambda d: tables.write_table(d, other, ["part"])):
        with pytest.raises(tables.ContractError, match="breaking change: v: int"):
            write(retyped)
    tables.write_table(retyped, other, ["part"], breaking=True)
    assert tables.read_table(spark, other).schema["v"].dataType == T.IntegerType()
    assert tables.table_state(spark, path)["version"] == version and content(spark, path) == [(1, "2024-01-01", "x")]


def test_layout_stays(spark, path):
    """Upserts and day batches sort and filter as the first build did."""
    tables.write_table(frame(spark, [(k, "a", "x") for k in range(9)]), path, ["part"], ["id"], ["id"])
    tables.upsert_table(spark, path, frame(spark, [(k, "a", "y") for k in range(20, 2, -1)]), "id", "part", ["v"])
    assert tables.table_state(spark, path)["layout"] == {"sort_by": ["id"], "bloom_cols": ["id"]}
    ids = [r["id"] for r in tables.read_table(spark, path).collect()]
    assert ids == sorted(ids)


def entries(spark, path):
    index = tables.table_state(spark, path)["keys"]
    return sorted(map(tuple, tables._entries(spark, path, index, list(index["live"])).select("id", "_part").collect()))


def test_key_index(spark, path):
    """The index follows inserts, moves and deletions; ranges without a change
    are not written; lookups read the partition that it names."""
    rows = [(k, "abc"[k % 3], "x") for k in range(0, 64, 2)]
    tables.write_table(frame(spark, rows), path, ["part"], key="id", key_bits=4)
    first = tables.table_state(spark, path)["keys"]["live"]
    assert set(first) == {"0", "1", "2", "3"} and entries(spark, path) == sorted((i, p) for i, p, _ in rows)
    tables.upsert_table(spark, path, frame(spark, [(2, "z", "y"), (5, "z", "y"), (64, None, "y")]), "id", "part", ["v"],
                        delete_keys=frame(spark, [(20, "", ""), (77, "", "")]).select("id"))
    want = {i: (p, v) for i, p, v in rows if i != 20} | {2: ("c", "y"), 5: ("z", "y"), 64: (None, "y")}
    assert content(spark, path) == sorted((i, p, v) for i, (p, v) in want.items())
    assert entries(spark, path) == sorted((i, p or tables.NULL_PART) for i, (p, _) in want.items())
    state = tables.table_state(spark, path)
    now = state["keys"]["live"]
    assert {r for r in now if now[r] == first.get(r)} == {"2", "3"} and state["last"] == {"inserted": 2, "updated": 1, "deleted": 1}
    assert state["rows"] == len(want) == tables.read_table(spark, path).count()
    tables.upsert_table(spark, path, frame(spark, [(5, "a", "w")]), "id", "part")  # all columns: it moves
    tables.upsert_table(spark, path, frame(spark, [(8, "c", "w")]), "id", "part", ["v"])  # nothing moves
    want |= {5: ("a", "w"), 8: ("c", "w")}
    assert entries(spark, path) == sorted((i, p or tables.NULL_PART) for i, (p, _) in want.items())
    for i in (5, 8, 40, 64):
        found = tables.lookup(spark, path, i)
        assert [tuple(r)[:3] for r in found.collect()] == [(i, *want[i])] and len(found.inputFiles()) == 1
    assert tables.lookup(spark, path, 20).collect() == [] == tables.lookup(spark, path, 10**6).collect()
    with pytest.raises(ValueError):
        tables.append_rows(frame(spark, [(1, "a", "x")]), path, "part")


def test_key_index_of_texts_and_pairs(spark, path):
    rows = [(k, f"k{k % 5}", "x", dt.datetime(2024, 1, 1)) for k in range(40)]
    table = spark.createDataFrame(rows, SCHEMA.replace("id int", "n int").replace("part string", "leg string")).withColumn(
        "part", F.col("n") % 3)
    tables.write_table(table, path, ["part"], key=["leg", "n"])
    delta = table.where("n < 3").withColumn("v", F.lit("y")).unionByName(table.where("n = 39").withColumn("n", F.lit(99)))
    tables.upsert_table(spark, path, delta, ["leg", "n"], "part", ["v"])
    got = {(r["leg"], r["n"]): r["v"] for r in tables.read_table(spark, path).collect()}
    assert got == {(r[1], r[0]): "y" if r[0] < 3 else "x" for r in rows} | {("k4", 99): "x"}
    assert [r["v"] for r in tables.lookup(spark, path, "k4", 99).collect()] == ["x"]


def test_replayed_stream_batch_is_skipped(spark, path):
    """A crash between the table's commit and the checkpoint's: the last batch
    comes again, with its deletions, and changes nothing."""
    from ledgerline.streaming.stream_merge import stream_merge
    tables.write_table(frame(spark, [(1, "a", "x"), (2, "a", "x")]), f"{path}/t", ["part"], watermark_col="at")
    for rows in ([(3, "a", "n"), (1, "a", "u")], [(3, "a", "DELETE"), (2, "a", "u")]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{path}/in")
        run = lambda: stream_merge(spark, f"{path}/in", frame(spark, []).schema, f"{path}/t", "id", "part", ["v"], f"{path}/ckpt",
                                   prepare=lambda b: b.where("v <> 'DELETE'"),
                                   deletes=lambda b: b.where("v = 'DELETE'").select("id"), watermark_col="at")
        run()
    want, state = [(1, "a", "u"), (2, "a", "u")], tables.table_state(spark, f"{path}/t")
    assert content(spark, f"{path}/t") == want and list(state["streams"].values()) == [1]
    fs, done = tables._fs(spark, f"{path}/ckpt/commits/1")
    fs.delete(done, False)
    tables.upsert_table(spark, f"{path}/t", frame(spark, [(3, "a", "later")]), "id", "part", ["v"])  # another writer
    run()
    assert content(spark, f"{path}/t") == [*want, (3, "a", "later")]
    assert tables.table_state(spark, f"{path}/t")["version"] == state["version"] + 1


def test_contract_gates_the_write(spark, path):
    contract = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    good = spark.createDataFrame([(1, "x")], "id int, v string")
    tables.write_table(good, path, contract=contract)
    for bad in (good.withColumn("w", F.lit(1)), good.drop("v"), good.withColumn("id", F.col("id").cast("long"))):
        with pytest.raises(tables.ContractError):
            tables.write_table(bad, path, contract=contract)
    with pytest.raises(tables.ContractError):
        tables.check_compatible(contract, good.drop("v").schema)
    tables.check_compatible(contract, good.withColumn("w", F.lit(1)).schema)
    assert tables.read_table(spark, path).collect() == [(1, "x")]


def test_duplicate_quote_stays_on_its_day(spark):
    quotes = spark.createDataFrame([("USD", dt.date(2024, 1, 1), 1.0), ("USD", dt.date(2024, 1, 3), 2.0),
                                    ("USD", dt.date(2024, 1, 3), 3.0)], "c string, d date, v double")
    rows = sorted((r["d"].day, r["v"]) for r in fx.densify_ffill(quotes, ["c"], "d", "v", "2024-01-01", "2024-01-05").collect())
    assert [d for d, _ in rows] == [1, 2, 3, 3, 4] and rows[1] == (2, 1.0)
    daily = quotes.selectExpr("d as date_cotation", "c as devise_cible", "v as taux")
    with pytest.raises(Exception, match="more than one rate for 2024-01-03 USD"):
        fx.fx_for_join(daily).collect()


def test_outage_is_an_anomaly(spark):
    days = [d for d in range(40) if d != 36]
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d),) for d in days for _ in range(100 + d % 3)]
    found = Q.volume_anomaly(spark.createDataFrame(rows, "date_transaction timestamp_ntz")).collect()
    assert dt.date(2024, 2, 6) in {r["jour"] for r in found}


def test_wrong_fallback_rate_is_found(spark):
    fact = spark.createDataFrame(
        [(1, "USD", dt.date(2024, 1, 5), 100.0, 110.0), (2, "XXX", dt.date(2024, 1, 5), 100.0, 100.0),
         (3, "XXX", dt.date(2024, 1, 5), 100.0, 150.0), (4, "EUR", dt.date(2024, 1, 5), 7.0, 7.0),
         (5, "USD", dt.date(2024, 1, 5), 100.0, 100.0)],
        "transaction_id long, devise string, jour_transaction date, montant double, montant_eur double")
    fact = fact.withColumn("montant", F.col("montant").cast("decimal(15,2)")).withColumn(
        "montant_eur", F.col("montant_eur").cast("decimal(18,2)"))
    quotes = spark.createDataFrame([("USD", dt.date(2023, 12, 20), 1.2), ("USD", dt.date(2024, 1, 2), 1.1)],
                                   "devise_cible string, date_cotation date, taux double")
    source = spark.createDataFrame([(k, 1.5 if k == 3 else None) for k in range(1, 6)],
                                   "transaction_id long, taux_change_applique double")
    cast = lambda df, c: df.withColumn(c, F.col(c).cast("decimal(18,8)"))
    bad = Q.fx_recompute(fact, cast(quotes, "taux"), cast(source, "taux_change_applique"), "2023-12-01", "2024-02-01")
    assert [r["transaction_id"] for r in bad.collect()] == [5]


def test_building_a_query_starts_no_job(spark):
    """Plans are lazy: nothing is counted or probed while they are built (the
    staging frames are there already: opening a Parquet file reads its schema)."""
    from ledgerline.plans.warehouse import Warehouse
    from ledgerline.sources.adapters import RawTables
    w = Warehouse(RawTables(spark, "/root/testdata/sf0.001"))
    for name in ("transactions", "virements", "comptes", "categories", "fx_rates", "tenants"):
        getattr(w, f"stg_{name}")
    tracker = spark.sparkContext.statusTracker()
    group = f"build-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "building plans")
    try:
        for name in ("fct_transactions", "mart_tenant_kpis_daily", "mart_solde_journalier", "mart_reconciliation"):
            getattr(w, name)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_writes_of_no_rows(spark, path):
    """Empty builds, day batches, appended rows and upserts finish, and say so."""
    none = frame(spark, [])
    tables.write_table(none, path, ["part"], ["id"], watermark_col="at", key="id")
    assert content(spark, path) == [] and tables.table_watermark(spark, path, "at") is None
    tables.upsert_table(spark, path, none, "id", "part", ["v"])
    tables.upsert_table(spark, path, frame(spark, [(1, "a", "x")]), "id", "part", ["v"])
    assert content(spark, path) == [(1, "a", "x")] and tables.table_state(spark, path)["rows"] == 1
    tables.replace_days(none, f"{path}-days", "part", "2024-01-01", "2024-01-05", done=True)
    tables.append_rows(none, f"{path}-days", "part")
    state = tables.table_state(spark, f"{path}-days")
    assert content(spark, f"{path}-days") == [] and len(state["days"]) == 4
    tables.write_table(spark.createDataFrame([], "a int"), f"{path}-plain")
    assert tables.read_table(spark, f"{path}-plain").collect() == [] and tables.table_state(spark, f"{path}-plain")["rows"] == 0


def test_upsert_moves_rows_once(spark, path, monkeypatch):
    """The target's rows are dealt by partition and slice, joined there and
    written: no second shuffle of theirs, whatever the delta's size."""
    plans = []
    write = tables._write_version
    monkeypatch.setattr(tables, "_write_version", lambda df, folder, *a, **kw: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()) if kw.get("dealt") else None, write(df, folder, *a, **kw))[1])
    monkeypatch.setattr(tables, "SLICE_BYTES", 700)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables.write_table(frame(spark, [(k, "ab"[k % 2], "x") for k in range(40)] + [(None, "a", "x"), (7, "a", "x")]), path, ["part"])
        delta = frame(spark, [(k, "a", "y") for k in range(30, 50) if k != 33] + [(None, "a", "lost")])
        gone = frame(spark, [(k, "", "") for k in (2, 31, 45, 46, 99, None)]).select("id")
        tables.upsert_table(spark, path, delta, "id", "part", ["v"], delete_keys=gone)
        got = tables.read_table(spark, path).collect()
        assert spark.conf.get(inc.CO_PARTITION) == "true"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = {k: ("ab"[k % 2] if k < 40 else "a", "y" if k > 29 and k != 33 else "x") for k in range(50) if k not in (2, 31, 45, 46)}
    assert sorted((r["id"], r["part"], r["v"]) for r in got if r["id"] is not None) == sorted(
        [*((k, *x) for k, x in want.items()), (7, "a", "x")])
    assert [(r["part"], r["v"]) for r in got if r["id"] is None] == [("a", "x")]
    assert len(plans) == 1 and "FullOuter" in plans[0]
    wide = [line for line in plans[0].split("\n") if "Exchange" in line and "hashpartitioning(_at" in line]
    assert len([x for x in wide if "_slice" in x]) == 2 and "rebalance" not in plans[0].lower()


def test_key_index_has_few_ranges(spark, path, monkeypatch):
    """A range of the index is a directory: their number stays bounded however
    far the keys span."""
    monkeypatch.setattr(tables, "KEY_RANGES", 8)
    tables.write_table(frame(spark, [(k * 1000, "a", "x") for k in range(100)]), path, ["part"], key="id", key_bits=4)
    index = tables.table_state(spark, path)["keys"]
    assert len(index["live"]) <= 9 and len(entries(spark, path)) == 100
    tables.upsert_table(spark, path, frame(spark, [(5000, "a", "y")]), "id", "part", ["v"])
    assert [r["v"] for r in tables.lookup(spark, path, 5000).collect()] == ["y"]
