"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import ensure_checkpoint_dir

#: A word of the whitespace-word operators: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python worker turns into objects at a time.
PIECE_BYTES = 1 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted when the
    driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later plan reads."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage so that a lost executor costs no recomputation, and gives the
    planner the real size of the table, so that it broadcasts a side only when
    it is under the session's threshold."""
    spark = df.sparkSession
    path = scratch_path(spark, name) + "/table"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it (any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(column: str) -> str:
    """A column name as an expression, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def pieces(batch: pa.RecordBatch, at: int, size: int | None = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of the texts in column
    ``at`` (one longer text is a slice of its own; None: the whole batch)."""
    if size is None:
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k in np.flatnonzero(sizes).tolist():
        if held and held + sizes[k] > size:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += int(sizes[k])
    yield batch.slice(start)


def append_struct(df: DataFrame, name: str, kind: T.StructType, text: str, make: Callable[..., dict[str, list]],
                  more: tuple[str, ...] = (), piece_bytes: int | None = PIECE_BYTES) -> DataFrame:
    """``df`` with one more struct column ``name``, made piece by piece from
    the UTF-8 bytes (None for null) of column ``text`` and the columns ``more``."""
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(kind)
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    at, others = df.columns.index(text), [df.columns.index(c) for c in more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, at, piece_bytes):
                made = make(piece.column(at).cast(pa.binary()).to_pylist(), *[piece.column(k).to_pylist() for k in others])
                parts = [pa.array(made[f.name], type=f.type) for f in arrow_kind]
                column = pa.StructArray.from_arrays(parts, fields=list(arrow_kind))
                yield pa.RecordBatch.from_arrays([*piece.columns, column], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text):
    """Number of whitespace words of a text (null: 0), as a long."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")
