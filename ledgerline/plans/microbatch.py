"""Day batches with a ledger.

A run derives the days that are due from what the table's record says: every
day from ``begin`` to ``through`` that isn't done yet, and the last
``lookback`` days before ``through`` again, since late rows come in. Days that
failed are not done, so the next run retries them and nothing else.

Consecutive days are one batch of at most ``chunk`` days: one job that reads
the source's rows of those days (the bounds are literals, so the filter
reaches the scan) and one commit that also enters the days in the ledger. A
batch that fails is entered as failed; the others go on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import tables

BEGIN = "2023-01-01"
LOOKBACK = 3
CHUNK = 31


@dataclass
class Batch:
    """The days [start, end) and what became of them."""

    start: dt.date
    end: dt.date
    error: str | None = None


def _day(value) -> dt.date:
    return dt.date.fromisoformat(str(value)[:10])


def due_days(done: dict[str, str], begin, through, lookback: int = LOOKBACK) -> list[dt.date]:
    """Days to run, oldest first: not done yet, or within the lookback."""
    first, last = _day(begin), _day(through)
    again = last - dt.timedelta(days=lookback)
    days = (first + dt.timedelta(days=k) for k in range((last - first).days + 1))
    return [d for d in days if d >= again or done.get(d.isoformat()) != "done"]


def batches(days: list[dt.date], chunk: int = CHUNK) -> list[Batch]:
    """Consecutive days together, at most ``chunk`` of them."""
    out: list[Batch] = []
    for d in days:
        if out and out[-1].end == d and (d - out[-1].start).days < chunk:
            out[-1].end = d + dt.timedelta(days=1)
        else:
            out.append(Batch(d, d + dt.timedelta(days=1)))
    return out


def run_microbatch(spark: SparkSession, path: str, source: DataFrame, build: Callable[[DataFrame], DataFrame], event_time: str,
                   day_col: str, through, begin=BEGIN, lookback: int = LOOKBACK, chunk: int = CHUNK,
                   sort_by: list[str] | None = None, watermark_col: str | None = None) -> list[Batch]:
    """Run the due batches of ``source`` into the table at ``path``, one
    partition per day. ``build`` turns a batch's source rows into the table's;
    ``day_col`` is the day of ``event_time``. Rows without an event time, or
    outside of ``begin`` to ``through``, belong to no batch."""
    state = tables.table_state(spark, path)
    ran = batches(due_days((state or {}).get("days", {}), begin, through, lookback), chunk)
    for b in ran:
        low, high = (F.lit(f"{d} 00:00:00").cast(source.schema[event_time].dataType) for d in (b.start, b.end))
        rows = build(source.where((F.col(event_time) >= low) & (F.col(event_time) < high)))
        try:
            tables.replace_days(rows, path, day_col, b.start, b.end, sort_by, watermark_col=watermark_col, done=True)
        except Exception as error:  # noqa: BLE001  a batch's failure is its entry in the ledger
            b.error = str(error).splitlines()[0]
            tables.mark_days(spark, path, b.start, b.end, "failed")
    return ran
