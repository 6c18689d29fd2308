"""Stored Parquet tables: layout (A11), full rebuild (A9), upsert (F1-F5), day
replacement (F6), append (F8).

No lakehouse format is available, so a table keeps its own small record:

* data files live under ``data/<partition>=<value>/ver=<id>/``; every write
  goes to directories of a new ``ver``, never over live files;
* ``_state/<n>.json`` names, for each partition value, the ``ver``s that are
  live, and holds the table's schema, contract, layout, watermark, day ledger,
  stream positions and, while writes tell it, its number of rows. Readers take the newest record. A record appears by
  one rename, so a run that dies before it leaves the table as it was, and a
  second writer of the same number fails.

A read is one scan: the live (partition, ver) pairs are a filter on partition
columns, so files of other versions are pruned before anything is opened. The
record has an entry per partition value (months, days: bounded by the
calendar), never per row or file.

**Retention.** What a commit replaces stays for ``KEEP`` seconds, so a reader
that was opened before the commit finishes; ``sweep`` (run by each commit)
then deletes it, and every directory as old that no record names: the files
of writes that were refused or died.

**Schema.** Every write is checked before it is made: against the table's
contract, and against a breaking change of its recorded schema.

**Key index.** A table with ``key`` columns keeps a second set of files,
``_keys/``: (key, partition value) sorted by key, one directory per range of
keys, named by the same record. A point lookup reads one range and then the
partitions it names; an upsert looks its keys up in the ranges they fall into
and rewrites only the ranges whose entries change. Without an index the lookup
reads the key and partition columns of the whole table.

Upsert, one pass over what it touches:

1. the delta is written once to scratch, as Parquet;
2. its keys are looked up, so a known key is found in whatever partition it
   lies; they have to be unique;
3. the partitions that hold a matched or deleted key, or that new rows go to,
   are merged and written once, as a new ``ver``: their columns are read and
   shuffled once, together with the delta, by the partition that the lookup
   names (a large one in slices by key). Null partition values compare like
   any other.

Watermark: an incremental run needs the table's newest load time. The Parquet
reader does not answer ``max`` from footers, so the record keeps it, raised by
what each write observes of the rows it writes.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import incremental as inc
from ledgerline.session import input_bytes, scratch_dir

VER = "ver"
NULL_PART = "__null__"
#: Seconds that replaced versions and unnamed directories are kept.
KEEP = 24 * 3600
#: A range of the key index holds 2 ** KEY_BITS successive integer keys; keys
#: of other types are dealt to KEY_BUCKETS ranges by hash.
KEY_BITS = 20
KEY_BUCKETS = 256
#: Ranges that a table is built with at most: where the keys span more, each
#: holds more of them, as a range is a directory to write and to list.
KEY_RANGES = 1024
#: Files of a partition that one task of an upsert merges and writes.
SLICE_BYTES = 32 * 1024 * 1024


class ContractError(ValueError):
    pass


def check_contract(schema: T.StructType, contract: T.StructType) -> None:
    """Raise unless ``schema`` has the contract's columns and types, and
    no others."""
    have = {f.name: f.dataType.simpleString() for f in schema.fields}
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    wrong = [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in want.items() if have.get(c) != t]
    wrong += [f"{c}: unexpected" for c in have if c not in want]
    if wrong:
        raise ContractError("; ".join(wrong))


def check_compatible(old: T.StructType, new: T.StructType) -> None:
    """A removed column or a changed type breaks the table's readers."""
    have = {f.name: f.dataType for f in new.fields}
    wrong = [f"{f.name}: {'removed' if f.name not in have else have[f.name].simpleString()}"
             for f in old.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ContractError("breaking change: " + "; ".join(wrong))


# --- the record ------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _state_files(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _fs(spark, f"{path}/_state")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def table_state(spark: SparkSession, path: str) -> dict | None:
    """The table's newest record; None when there is no table."""
    numbers = _state_files(spark, path)
    return _read_state(spark, path, numbers[-1]) if numbers else None


def _read_state(spark: SparkSession, path: str, number: int) -> dict:
    fs, record = _fs(spark, f"{path}/_state/{number:08d}.json")
    stream = fs.open(record)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) | {"version": number}


def _commit(spark: SparkSession, path: str, state: dict, after: int) -> None:
    number = after + 1
    fs, temp = _fs(spark, f"{path}/_state/.{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    record = {k: v for k, v in state.items() if k != "version"} | {"at": time.time()}
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    target = _fs(spark, f"{path}/_state/{number:08d}.json")[1]
    if fs.exists(target) or not fs.rename(temp, target):
        raise RuntimeError(f"{path}: another writer has made version {number}")
    sweep(spark, path)


def sweep(spark: SparkSession, path: str, keep: float | None = None) -> list[str]:
    """Delete records replaced more than ``keep`` seconds ago (``KEEP``), and
    the directories as old that no remaining record names; returns those."""
    since = time.time() - (KEEP if keep is None else keep)
    numbers = _state_files(spark, path)
    states = [_read_state(spark, path, n) for n in numbers]
    for n, follower in zip(numbers, states[1:], strict=False):
        if follower["at"] <= since:
            fs, record = _fs(spark, f"{path}/_state/{n:08d}.json")
            fs.delete(record, False)
    states = [x for x, follower in zip(states, [*states[1:], None], strict=True) if not follower or follower["at"] > since]
    gone = []
    for folder, of in (("data", lambda x: x), ("_keys", lambda x: x.get("keys"))):
        named = {(part, ver) for x in states if of(x) for part, vers in of(x)["live"].items() for ver in vers}
        parts = any(of(x) and of(x)["partition_by"] for x in states)
        fs, pattern = _fs(spark, f"{path}/{folder}/{'*/' if parts else ''}{VER}=*")
        for s in fs.globStatus(pattern) or []:
            part = _unescaped(spark, s.getPath().getParent().getName().partition("=")[2]) if parts else ""
            if (part, s.getPath().getName()[len(VER) + 1:]) not in named and s.getModificationTime() / 1000 <= since:
                fs.delete(s.getPath(), True)
                gone.append(f"{folder}/{part}")
    return gone


def _part_name(column):
    """A partition value as the record's key (an empty string is stored as
    null, as in any Hive-style layout)."""
    return F.coalesce(F.nullif(column.cast("string"), F.lit("")), F.lit(NULL_PART))


def _unescaped(spark: SparkSession, name: str) -> str:
    """A partition directory's value as the record's key."""
    if name == "__HIVE_DEFAULT_PARTITION__":
        return NULL_PART
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


# --- write and read ----------------------------------------------------------------

def _write_version(df: DataFrame, folder: str, partition_by: list[str], layout: dict, watermark_col: str | None = None,
                   dealt: bool = False) -> tuple[dict, dict]:
    """Write ``df`` as a new ``ver`` under ``folder``; ({partition value:
    [ver]} of what it holds, what the write observed: ``rows``, and ``high``,
    the newest ``watermark_col``). ``dealt``: its rows lie by partition value
    already."""
    ver, spark, seen = uuid.uuid4().hex, df.sparkSession, Observation()
    # REBALANCE: AQE hashes rows on the partition column, coalesces small
    # partitions and splits a skewed one (a hot month) over several tasks.
    w = df.hint("rebalance", *partition_by) if not dealt and (partition_by or layout.get("sort_by")) else df
    keys = [*partition_by, *(layout.get("sort_by") or [])]
    if keys:
        w = w.sortWithinPartitions(*keys)
    # after the rebalance, so each row is observed once, in the task that writes it
    newest = [F.max(watermark_col).alias("high")] if watermark_col else []
    w = w.observe(seen, F.count(F.lit(1)).alias("rows"), *newest)
    writer = w.withColumn(VER, F.lit(ver)).write.mode("append")
    for c in layout.get("bloom_cols") or []:
        # adaptive: each file keeps the smallest filter that fits its keys
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
    writer.partitionBy(*partition_by, VER).parquet(folder)
    got = {"rows": seen.get.get("rows") or 0, "high": seen.get.get("high")}
    if not partition_by:
        return {"": [ver]}, got
    fs, pattern = _fs(spark, f"{folder}/*/{VER}={ver}")
    names = [s.getPath().getParent().getName().partition("=")[2] for s in fs.globStatus(pattern) or []]
    return {_unescaped(spark, n): [ver] for n in names}, got


def _raised(state: dict, got: dict) -> str | None:
    """The recorded watermark after a write that observed ``got``."""
    high = got["high"]
    before = dt.datetime.fromisoformat(state["high"]) if state.get("high") else None
    newest = max((h for h in (before, high) if h is not None), default=None)
    return None if newest is None else newest.isoformat()


def _checked(state: dict | None, schema: T.StructType, breaking: bool = False) -> T.StructType:
    """I10/I11 on every write: ``schema`` (all columns nullable), or an error."""
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    if state and state.get("contract"):
        check_contract(out, T.StructType.fromJson(state["contract"]))
    if state and not breaking:
        check_compatible(T.StructType.fromJson(state["schema"]), out)
    return out


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, bloom_cols: list[str] | None = None,
                watermark_col: str | None = None, contract: T.StructType | None = None, key: list[str] | str | None = None,
                key_bits: int = KEY_BITS, breaking: bool = False) -> str:
    """A full rebuild, as a new version of the table at ``path``.

    ``partition_by``: at most one column, one directory per value (month,
    never tenant x month); rows sorted by ``sort_by`` (tight row-group bounds);
    bloom filters serve point lookups; later writes keep this layout.
    ``contract``: refuse another schema, now and in later writes. ``key``: keep
    a key index. ``breaking``: allow removed columns and changed types."""
    spark = df.sparkSession
    before = table_state(spark, path)
    parts, keys = list(partition_by or []), [key] if isinstance(key, str) else list(key or [])
    gate = {"contract": contract.jsonValue() if contract is not None else (before or {}).get("contract"),
            "schema": (before or {}).get("schema", df.schema.jsonValue())}
    schema = _checked(gate, df.schema, breaking)
    layout = {"sort_by": sort_by, "bloom_cols": bloom_cols}
    live, got = _write_version(df, f"{path}/data", parts, layout, watermark_col)
    state = {"schema": schema.jsonValue(), "partition_by": parts, "live": live, "watermark_col": watermark_col,
             "rows": got["rows"], "high": _raised({}, got), "contract": gate["contract"], "layout": layout, "days": {}, "streams": {}, "keys": None}
    if keys:
        integral = isinstance(schema[keys[0]].dataType, (T.LongType, T.IntegerType))
        rows = _read(spark, path, state).select(*keys, _part_name(F.col(parts[0])).alias("_part"))
        bits = _range_bits(rows, keys[0], key_bits) if integral else None
        state["keys"] = {"columns": keys, "bits": bits, "partition_by": ["_range"], "live": {}}
        state["keys"] |= _write_index(state["keys"], path, rows)
    _commit(spark, path, state, before["version"] if before else 0)
    return path


def _folders(spark: SparkSession, base: str, by: str, live: dict, parts: Iterable[str]) -> list[str]:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name = lambda p: "__HIVE_DEFAULT_PARTITION__" if p == NULL_PART else escape(p)
    return [f"{base}/{by}={name(p)}/{VER}={v}" for p in parts for v in live[p]]


def _read(spark: SparkSession, path: str, state: dict, only: Iterable[str] | None = None) -> DataFrame:
    """The live rows; ``only``: those of some partition values."""
    schema, parts, live = T.StructType.fromJson(state["schema"]), state["partition_by"], state["live"]
    if only is not None:
        live = {k: live[k] for k in only if k in live}
    if not live:
        return spark.createDataFrame([], schema)
    stored = [f for f in schema.fields if f.name not in parts]
    tail = [schema[c] for c in parts] + [T.StructField(VER, T.StringType())]
    rows = spark.read.schema(T.StructType(stored + tail)).option("basePath", f"{path}/data")
    if not parts:
        return rows.parquet(f"{path}/data").where(F.col(VER).isin(live[""])).select(*schema.names)
    if only is not None and len(live) <= 32:  # more would be listed by a Spark job
        return rows.parquet(*_folders(spark, f"{path}/data", parts[0], live, live)).select(*schema.names)
    pairs = [f"{k}|{v}" for k, vers in live.items() for v in vers]
    named = F.concat(_part_name(F.col(parts[0])), F.lit("|"), F.col(VER)).isin(pairs)
    return rows.parquet(f"{path}/data").where(named).select(*schema.names)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, only: list[str] | None = None) -> DataFrame:
    """The table's live rows, with its recorded schema: columns that older
    files lack are null. ``only``: partition values to read."""
    state = table_state(spark, path)
    df = _read(spark, path, state, only) if state else spark.read.parquet(path)
    return df.select(*columns) if columns else df


def table_watermark(spark: SparkSession, path: str, col: str):
    """Newest value of ``col``: the recorded watermark when there is one for
    that column, else one max over the column. None for an empty table."""
    state = table_state(spark, path)
    if state and state["watermark_col"] == col:
        return dt.datetime.fromisoformat(state["high"]) if state["high"] else None
    return inc.max_value(read_table(spark, path), col)


# --- key index ---------------------------------------------------------------------

def _range(index: dict):
    """The range of the key index that a row's key falls into."""
    if index["bits"] is not None:
        return F.shiftright(index["columns"][0], index["bits"]).cast("string")
    return F.pmod(F.xxhash64(*index["columns"]), F.lit(KEY_BUCKETS)).cast("string")


def _range_bits(rows: DataFrame, key: str, bits: int) -> int:
    """``bits``, or as many more as keep the keys within ``KEY_RANGES``."""
    span = rows.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    while span["low"] is not None and (span["high"] >> bits) - (span["low"] >> bits) >= KEY_RANGES:
        bits += 1
    return bits


def _write_index(index: dict, path: str, rows: DataFrame) -> dict:
    """Entries (key columns, _part) as a new version of their ranges."""
    entries = rows.withColumn("_range", _range(index))
    live, _ = _write_version(entries, f"{path}/_keys", ["_range"], {"sort_by": index["columns"]})
    return {"live": live, "schema": entries.schema.jsonValue()}


def _entries(spark: SparkSession, path: str, index: dict, ranges: list[str]) -> DataFrame:
    """The entries of some ranges, read from their directories only."""
    schema = T.StructType.fromJson(index["schema"])
    kept = [r for r in ranges if r in index["live"]]
    if not kept:
        return spark.createDataFrame([], schema).drop("_range")
    fields = [f for f in schema.fields if f.name != "_range"]
    rows = spark.read.schema(T.StructType([*fields, schema["_range"], T.StructField(VER, T.StringType())]))
    return rows.option("basePath", f"{path}/_keys").parquet(
        *_folders(spark, f"{path}/_keys", "_range", index["live"], kept)).select(*[f.name for f in fields])


def _ranges(index: dict, *frames: DataFrame | None) -> list[str]:
    """The ranges that the frames' keys fall into: a value per range."""
    found: set[str] = set()
    for df in frames:
        if df is not None:
            found |= {r["r"] for r in df.select(_range(index).alias("r")).distinct().collect()}
    return sorted(r for r in found if r is not None)


def lookup(spark: SparkSession, path: str, *key) -> DataFrame:
    """H2: the row of one key. The index names its partition, and only that is
    read."""
    state = table_state(spark, path)
    index = state["keys"]
    if index is None:
        raise ValueError(f"{path} has no key index")
    schema = T.StructType.fromJson(state["schema"])
    asked = spark.createDataFrame([tuple(key)], T.StructType([schema[c] for c in index["columns"]]))
    is_key = F.lit(True)
    for c, v in zip(index["columns"], key, strict=True):
        is_key = is_key & (F.col(c) == F.lit(v).cast(schema[c].dataType))
    found = _entries(spark, path, index, _ranges(index, asked)).where(is_key).select("_part").distinct()
    return _read(spark, path, state, [r["_part"] for r in found.collect()]).where(is_key)


# --- changes -----------------------------------------------------------------------

def _layout(state: dict | None, sort_by, bloom_cols) -> dict:
    """What the call says, else the layout the table was built with."""
    known = (state or {}).get("layout") or {}
    return {"sort_by": sort_by or known.get("sort_by"), "bloom_cols": bloom_cols or known.get("bloom_cols")}


def _widened(df: DataFrame, state: dict | None) -> DataFrame:
    """``df`` with the recorded columns first (null where it lacks them), then
    its new ones (F5)."""
    if not state:
        return df
    known = T.StructType.fromJson(state["schema"])
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known.fields],
                     *[c for c in df.columns if c not in known.names])


def _fresh_state(schema: T.StructType, partition_col: str, watermark_col: str | None) -> dict:
    return {"schema": schema.jsonValue(), "partition_by": [partition_col], "watermark_col": watermark_col, "high": None,
            "live": {}, "contract": None, "layout": {}, "days": {}, "streams": {}, "keys": None, "rows": 0}


def replace_days(df: DataFrame, path: str, partition_col: str, start, end, sort_by: list[str] | None = None,
                 bloom_cols: list[str] | None = None, watermark_col: str | None = None, done: bool = False) -> list[str]:
    """F6 storage: the partitions of [start, end) become exactly ``df``'s
    rows; a day that ``df`` has no row of goes. Returns the days that hold
    rows. New columns are kept, the watermark is raised, and a row outside of
    the range fails the write before it is committed. ``done``: enter the days
    of the range in the table's ledger."""
    spark = df.sparkSession
    state = table_state(spark, path)
    if state and state["keys"]:
        raise ValueError("a table with a key index takes upserts, not replaced days")
    df = _widened(df, state)
    schema = _checked(state, df.schema)
    watermark_col = watermark_col or (state or {}).get("watermark_col")
    name = f"rows outside of [{start}, {end})"
    inside = (F.col(partition_col).cast("date") >= F.lit(start).cast("date")) & (F.col(partition_col).cast("date") < F.lit(end).cast("date"))
    guarded = df.where(F.when(inside, True).otherwise(F.raise_error(F.concat_ws(": ", F.lit(name), F.col(partition_col).cast("string"))).isNull()))
    try:
        live, got = _write_version(guarded, f"{path}/data", [partition_col], _layout(state, sort_by, bloom_cols), watermark_col)
    except Exception as error:
        if name in str(error):
            raise ValueError(f"{name}: nothing was written") from error
        raise
    state = state or _fresh_state(schema, partition_col, watermark_col) | {"layout": _layout(None, sort_by, bloom_cols)}
    kept = {k: v for k, v in state["live"].items() if k == NULL_PART or not str(start) <= k[:10] < str(end)}
    days = state["days"] | ({d: "done" for d in _days(start, end)} if done else {})
    _commit(spark, path, state | {"schema": schema.jsonValue(), "live": kept | live, "watermark_col": watermark_col,
                                  "high": _raised(state, got), "days": days, "rows": None}, state.get("version", 0))
    return sorted(live)


def _days(start, end) -> list[str]:
    first, last = (dt.date.fromisoformat(str(x)[:10]) for x in (start, end))
    return [(first + dt.timedelta(days=k)).isoformat() for k in range((last - first).days)]


def mark_days(spark: SparkSession, path: str, start, end, status: str) -> None:
    """Enter [start, end) in the ledger with ``status``; no table, no entry."""
    state = table_state(spark, path)
    if state:
        _commit(spark, path, state | {"days": state["days"] | {d: status for d in _days(start, end)}}, state["version"])


def append_rows(df: DataFrame, path: str, partition_col: str, sort_by: list[str] | None = None,
                replacing: Iterable[str] = ()) -> None:
    """Add rows as further versions of their partitions; no file is rewritten.
    ``replacing``: partition values whose rows up to now go."""
    spark = df.sparkSession
    state = table_state(spark, path)
    if state and state["keys"]:
        raise ValueError("a table with a key index takes upserts, not appended rows")
    df = _widened(df, state)
    schema = _checked(state, df.schema)
    state = state or _fresh_state(schema, partition_col, None)
    live, got = _write_version(df, f"{path}/data", [partition_col], _layout(state, sort_by, None), state["watermark_col"])
    rows = None if replacing or state.get("rows") is None else state["rows"] + got["rows"]
    before = {k: v for k, v in state["live"].items() if k not in set(replacing)}
    merged = {k: before.get(k, []) + live.get(k, []) for k in before | live}
    _commit(spark, path, state | {"schema": schema.jsonValue(), "live": merged, "high": _raised(state, got), "rows": rows},
            state.get("version", 0))


def upsert_table(spark: SparkSession, path: str, delta: DataFrame, key: list[str] | str, partition_col: str,
                 update_cols: list[str] | None = None, sort_by: list[str] | None = None,
                 bloom_cols: list[str] | None = None, watermark_col: str | None = None,
                 delete_keys: DataFrame | None = None, on_schema_change: str = "append",
                 stream: tuple[str, int] | None = None) -> list:
    """F1 storage: merge ``delta`` into the table at ``path``; returns the
    partition values rewritten. A matched row keeps its partition unless the
    partition column is updated too. ``delete_keys``: keys to remove.
    ``stream``: (query, batch number); a batch whose number the record already
    has for that query is skipped. The record's ``last`` counts the rows
    inserted, updated and deleted."""
    keys = [key] if isinstance(key, str) else list(key)
    state = table_state(spark, path)
    index = state["keys"] if state["keys"] and state["keys"]["columns"] == keys else None
    if state["keys"] and index is None:
        raise ValueError(f"the key index is over {state['keys']['columns']}")
    if stream and state["streams"].get(stream[0], -1) >= stream[1]:
        return []
    schema = inc.merged_schema(T.StructType.fromJson(state["schema"]), delta.schema, on_schema_change)
    schema = _checked(state, schema)
    work = scratch_dir(spark, f"upsert-{uuid.uuid4().hex}")
    try:
        # Used for the key lookup and the merge: written once in the shared
        # scratch folder, so its pipeline runs once and survives lost executors,
        # and the planner knows its size.
        delta = _held(delta, f"{work}/delta")
        if delete_keys is not None:
            delete_keys = _held(delete_keys.select(*keys).distinct(), f"{work}/deleted")
        if index:
            where = _entries(spark, path, index, _ranges(index, delta, delete_keys))
        else:
            where = _read(spark, path, state).select(*keys, _part_name(F.col(partition_col)).alias("_part"))
        moves = update_cols is None or partition_col in update_cols
        own = _part_name(F.col(partition_col)) if partition_col in delta.columns else F.lit(NULL_PART)
        incoming = delta.select(*keys, own.alias("_own"))
        placed = _held(incoming.join(where, keys, "left").select(
            *keys, "_part", "_own", F.when(F.col("_part").isNull() | F.lit(moves), F.col("_own")).otherwise(F.col("_part")).alias("_to")),
            f"{work}/placed")
        inc.check_unique(placed, keys)
        pairs = placed.groupBy("_part", "_own", "_to").agg(F.count(F.lit(1)).alias("n")).collect()  # by partition value
        touched = {p for r in pairs for p in (r["_part"], r["_to"]) if p is not None}
        deleted = []
        if delete_keys is not None:
            deleted = where.join(delete_keys, keys, "left_semi").groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()
            touched |= {r["_part"] for r in deleted}
        last = {"inserted": sum(r["n"] for r in pairs if r["_part"] is None),
                "updated": sum(r["n"] for r in pairs if r["_part"] is not None), "deleted": sum(r["n"] for r in deleted)}
        rows = None if state.get("rows") is None else state["rows"] + last["inserted"] - last["deleted"]
        done = state | {"last": last, "rows": rows, "streams": state["streams"] | ({stream[0]: stream[1]} if stream else {})}
        if not touched:
            if stream:
                _commit(spark, path, done, state["version"])
            return []
        # Delta rows meet the target's where those lie; few lie elsewhere than the row itself says.
        at = F.col("_own")
        routed = delta.withColumn("_own", own)
        if any(r["_part"] not in (None, r["_own"]) for r in pairs):
            away = _held(placed.where("_part <> _own").select(*keys, "_part"), f"{work}/away")
            routed, at = routed.join(away, keys, "left"), F.coalesce("_part", "_own")
        routed = routed.select(*delta.columns, at.alias("_at"))
        gone = None
        if delete_keys is not None:
            gone = where.select(*keys, F.col("_part").alias("_at")).unionByName(
                placed.where(F.col("_part").isNull()).select(*keys, F.col("_own").alias("_at"))).join(delete_keys, keys, "left_semi")
        target = _read(spark, path, state, touched).withColumn("_at", _part_name(F.col(partition_col)))
        merged = inc.merge_dealt(target, routed, keys, "_at", update_cols, on_schema_change, gone,
                                 _slices(spark, path, state, touched, f"{work}/delta", pairs))
        watermark_col = watermark_col or state["watermark_col"]
        before = spark.conf.get(inc.CO_PARTITION)
        spark.conf.set(inc.CO_PARTITION, "false")
        try:
            live, got = _write_version(merged, f"{path}/data", state["partition_by"], _layout(state, sort_by, bloom_cols),
                                       watermark_col, dealt=True)
        finally:
            spark.conf.set(inc.CO_PARTITION, before)
        done |= {"schema": schema.jsonValue(), "live": {k: v for k, v in state["live"].items() if k not in touched} | live}
        if watermark_col:
            known = state if state["watermark_col"] == watermark_col else {"high": None}
            if known is not state:
                got["high"] = inc.max_value(_read(spark, path, done), watermark_col)
            done |= {"watermark_col": watermark_col, "high": _raised(known, got)}
        if index:
            done["keys"] = _index_after(spark, path, index, placed, delete_keys, last["deleted"])
        _commit(spark, path, done, state["version"])
    finally:
        fs, folder = _fs(spark, work)
        fs.delete(folder, True)
    return [None if p == NULL_PART else p for p in sorted(touched)]


def _slices(spark: SparkSession, path: str, state: dict, touched: Iterable[str], delta: str, pairs: list) -> int:
    """Into how many slices the largest touched partition is dealt, so that
    none takes more than some ``SLICE_BYTES`` of files: from the sizes on
    storage, the delta's by its rows per partition value."""
    arriving: dict[str, int] = {}
    for r in pairs:
        arriving[r["_to"]] = arriving.get(r["_to"], 0) + r["n"]
    per_row = input_bytes(spark, [delta]) / max(1, sum(arriving.values()))
    by = state["partition_by"][0]
    sizes = [input_bytes(spark, _folders(spark, f"{path}/data", by, state["live"], [p] if p in state["live"] else []))
             + arriving.get(p, 0) * per_row for p in touched]
    return max(1, -(-int(max(sizes)) // SLICE_BYTES))


def _index_after(spark: SparkSession, path: str, index: dict, placed: DataFrame, delete_keys: DataFrame | None, n_deleted: int) -> dict:
    """The index once the keys of ``placed`` lie in ``_to``: only the ranges
    with new, moved or deleted keys are written."""
    keys = index["columns"]
    changed = placed.where(~F.col("_part").eqNullSafe(F.col("_to"))).select(*keys, F.col("_to").alias("_part"))
    gone = delete_keys if n_deleted else None
    ranges = _ranges(index, changed, gone)
    if not ranges:
        return index
    left = _entries(spark, path, index, ranges).join(changed.select(*keys), keys, "left_anti").unionByName(changed)
    if gone is not None:
        left = left.join(gone, keys, "left_anti")
    written = _write_index(index, path, left)
    return index | written | {"live": {k: v for k, v in index["live"].items() if k not in ranges} | written["live"]}


def _held(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to scratch and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
