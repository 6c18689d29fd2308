"""Day batches with a ledger, and the stored history that only grows."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.snapshot import snapshot_check
from ledgerline.plans import history, microbatch
from ledgerline.session import scratch_dir
from ledgerline.sources import tables


@pytest.fixture
def path(spark):
    return scratch_dir(spark, f"micro-{uuid.uuid4().hex}")


def events(spark, rows):
    """(id, day of January, value)"""
    return spark.createDataFrame([(i, None if d is None else dt.datetime(2024, 1, d, 5), v) for i, d, v in rows],
                                 "id int, at timestamp_ntz, v string")


def build(rows):
    return rows.withColumn("day", F.to_date("at"))


def run(spark, path, rows, through, **more):
    ran = microbatch.run_microbatch(spark, path, events(spark, rows), more.pop("build", build), "at", "day", f"2024-01-{through:02d}",
                                    "2024-01-03", **more)
    return [(b.start.day, b.end.day, bool(b.error)) for b in ran]


def stored(spark, path):
    return sorted((r["id"], r["day"].day) for r in tables.read_table(spark, path).collect())


def test_days_due():
    done = {f"2024-01-{d:02d}": "done" for d in range(3, 11)} | {"2024-01-05": "failed"}
    assert [d.day for d in microbatch.due_days(done, "2024-01-03", "2024-01-12")] == [5, 9, 10, 11, 12]
    assert [d.day for d in microbatch.due_days(done, "2024-01-03", "2024-01-10", lookback=0)] == [5, 10]
    days = [dt.date(2024, 1, d) for d in (3, 4, 5, 6, 9, 10)]
    assert [(b.start.day, b.end.day) for b in microbatch.batches(days, 3)] == [(3, 6), (6, 7), (9, 11)]


def test_runs_take_what_is_due(spark, path):
    """The lookback takes late rows in; older ones, rows before the first day
    and rows without a time stay out; removed rows of a redone day go."""
    first = [(1, 2, "x"), (2, 3, "x"), (3, 9, "x"), (4, 10, "x"), (5, None, "x")]
    assert run(spark, path, first, 10) == [(3, 11, False)]
    assert stored(spark, path) == [(2, 3), (3, 9), (4, 10)]
    second = [*first[:2], (4, 10, "x"), (6, 7, "late"), (7, 10, "late"), (8, 12, "x"), (9, 13, "x")]
    assert run(spark, path, second, 12) == [(9, 13, False)]
    assert stored(spark, path) == [(2, 3), (4, 10), (7, 10), (8, 12)]
    assert set(tables.table_state(spark, path)["days"]) == {f"2024-01-{d:02d}" for d in range(3, 13)}


def test_failed_days_alone_are_retried(spark, path):
    rows = [(k, d, "x") for k, d in enumerate(range(3, 21))]
    broken = lambda r: build(r).withColumn("v", F.when(F.col("id") == 4, F.raise_error("bad row")).otherwise(F.col("v")))
    assert run(spark, path, rows, 20, chunk=3, lookback=0, build=broken) == [
        (3, 6, False), (6, 9, True), (9, 12, False), (12, 15, False), (15, 18, False), (18, 21, False)]
    assert {d for d, s in tables.table_state(spark, path)["days"].items() if s == "failed"} == {f"2024-01-0{d}" for d in (6, 7, 8)}
    assert [i for i, _ in stored(spark, path)] == [0, 1, 2, *range(6, 18)]
    assert run(spark, path, rows, 20, chunk=3, lookback=0) == [(6, 9, False), (20, 21, False)]
    assert [i for i, _ in stored(spark, path)] == list(range(18))
    assert run(spark, path, rows, 20, lookback=0) == [(20, 21, False)]


VERSIONS = [[(1, "actif", 1), (2, "actif", 1), (3, "actif", 1), (4, "actif", 1)],
            [(1, "suspendu", 1), (2, "actif", 9), (4, "actif", 1), (5, "actif", 1)],
            [(1, "suspendu", 1), (2, "actif", 9), (3, "actif", 1), (5, None, 1)],
            [(1, "actif", 1), (3, "actif", 1), (5, None, 1)], [(1, "actif", 1), (3, "actif", 1), (5, "x", 1)]]


@pytest.mark.parametrize("settle_at", [0.0, 0.25, 10.0])
def test_history_grows_only(spark, path, settle_at):
    """As a history that is rewritten each time; files of earlier runs stay
    as they are, and settling moves versions without a change of content."""
    known, files = None, set()
    for k, rows in enumerate(VERSIONS):
        now = spark.createDataFrame(rows, "compte_id bigint, statut string, risk_score int")
        as_of = f"2024-0{k + 1}-01 00:00:00"
        known = spark.createDataFrame(snapshot_check(known, now, "compte_id", ["statut"], as_of).collect(),
                                      snapshot_check(known, now, "compte_id", ["statut"], as_of).schema)
        grown = history.run_snapshot(spark, path, now, "compte_id", ["statut"], as_of, settle_at=settle_at)
        assert grown.columns == known.columns
        assert sorted(map(str, grown.collect())) == sorted(map(str, known.collect()))
        held = set(tables.read_table(spark, path).inputFiles())
        if settle_at > 1:
            assert files <= held  # no file of an earlier run is replaced
        files = held
    history.settle(spark, path)
    assert sorted(map(str, history.read_history(spark, path).collect())) == sorted(map(str, known.collect()))
    assert tables.read_table(spark, path, only=["closing"]).count() == 0
