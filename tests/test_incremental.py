"""Merge, lookback and batch replacement: semantics and properties."""

import datetime as dt

import pytest

from ledgerline.operators import incremental as inc

SCHEMA = "id bigint, statut string, montant int, note string, ts timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def t0(d):
    return dt.datetime(2024, 1, d)


@pytest.fixture
def target(spark):
    return frame(spark, [(1, "en_attente", 10, "a", t0(1)), (2, "validee", 20, "b", t0(1)),
                         (3, "validee", 30, "c", t0(2))])


@pytest.fixture
def delta(spark):
    return frame(spark, [(1, "validee", 99, "changed", t0(5)), (4, "validee", 40, "d", t0(5))])


def collect(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("plan", ["left", "outer"])
def test_column_limited_update(target, delta, plan):
    out = {r.id: r for r in inc.merge(target, delta, "id", ["statut"],
                                      plan=plan).collect()}
    assert out[1].statut == "validee" and out[1].montant == 10 and out[1].note == "a"
    assert out[4].montant == 40  # inserted whole
    assert out[2].statut == "validee" and out[3].montant == 30  # kept
    assert len(out) == 4


def test_all_columns_update(target, delta):
    out = {r.id: r for r in inc.merge(target, delta, "id", None).collect()}
    assert out[1].montant == 99 and out[1].note == "changed"


def test_plans_agree_and_merge_is_idempotent(target, delta):
    a = inc.merge(target, delta, "id", ["statut", "ts"], plan="left")
    b = inc.merge(target, delta, "id", ["statut", "ts"], plan="outer")
    assert collect(a) == collect(b)
    assert collect(inc.merge(a, delta, "id", ["statut", "ts"])) == collect(a)


def test_new_column_appended(spark, target):
    d = spark.createDataFrame([(1, "validee", 1, "x", t0(5), "new"), (9, "validee", 9, "y", t0(5), "z")],
                              SCHEMA + ", extra string")
    out = {r.id: r for r in inc.merge(target, d, "id", ["statut"]).collect()}
    assert out[1].extra is None and out[9].extra == "z" and out[2].extra is None


def test_schema_change_fail(spark, target):
    d = spark.createDataFrame([(1, "v", 1, "x", t0(5), "n")], SCHEMA + ", extra string")
    with pytest.raises(inc.SchemaChangeError):
        inc.merge(target, d, "id", None, on_schema_change="fail")


def test_full_refresh_and_empty_target(spark, target, delta):
    assert collect(inc.merge(None, delta, "id")) == collect(delta)
    empty = target.limit(0)
    assert collect(inc.lookback(delta, empty, "ts", 7)) == collect(delta)
    assert collect(inc.lookback(delta, None, "ts", 7)) == collect(delta)


def test_lookback_bound(spark, target):
    src = frame(spark, [(1, "v", 1, "x", dt.datetime(2023, 12, 26)), (2, "v", 1, "x", dt.datetime(2023, 12, 25, 23))])
    kept = [r.id for r in inc.lookback(src, target, "ts", 7).collect()]
    assert kept == [1]  # max(target.ts) = Jan 2 -> bound Dec 26 00:00


def test_replace_batches(spark, target):
    src = frame(spark, [(7, "v", 7, "n", t0(2)), (8, "v", 8, "n", t0(9))])
    out = collect(inc.replace_batches(target, src, "ts", "2024-01-02", "2024-01-03"))
    ids = [r[0] for r in out]
    assert ids == [1, 2, 7]  # day 2 replaced whole (id 3 gone), day 9 outside the batches


def _table_path(spark, name):
    import uuid
    from ledgerline.session import scratch_dir
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def test_full_rewrite_replaces_every_partition(spark):
    """A full rebuild drops partitions the new data lacks, even though the
    session's default overwrite mode is dynamic."""
    from ledgerline.sources import tables
    path = _table_path(spark, "test-rebuild")
    tables.write_table(frame(spark, [(1, "a", 1, "x", t0(1)), (2, "b", 2, "y", t0(2))]), path, ["statut"])
    tables.write_table(frame(spark, [(3, "c", 3, "z", t0(3))]), path, ["statut"])
    assert sorted(r.id for r in tables.read_table(spark, path).collect()) == [3]


def test_watermark_recorded_and_raised_by_upsert(spark, target, delta):
    from pyspark.sql import functions as F
    from ledgerline.sources import tables
    path = _table_path(spark, "test-watermark")
    tables.write_table(target, path, ["statut"], watermark_col="ts")
    assert tables.table_watermark(spark, path, "ts") == t0(2)
    # the side table is invisible to readers of the table
    assert tables.read_table(spark, path).count() == 3
    tables.upsert_table(spark, path, delta.where(F.col("id") == 4), "id", "statut",
                        ["montant"], watermark_col="ts")
    table = tables.read_table(spark, path)
    assert table.count() == 4
    assert tables.table_watermark(spark, path, "ts") == inc.max_value(table, "ts") == t0(5)
    # lookback from the recorded value equals lookback from a scan
    src = frame(spark, [(9, "validee", 1, "n", t0(1)), (8, "validee", 1, "n", t0(4))])
    assert (sorted(r.id for r in inc.lookback(src, table, "ts", 2).collect())
            == sorted(r.id for r in inc.lookback(src, table, "ts", 2,
                                                 high=tables.table_watermark(spark, path, "ts")).collect())
            == [8])


def test_watermark_falls_back_to_a_scan(spark, target):
    from ledgerline.sources import tables
    path = _table_path(spark, "test-nowatermark")
    tables.write_table(target, path, ["statut"])
    assert tables.table_watermark(spark, path, "ts") == t0(2)
