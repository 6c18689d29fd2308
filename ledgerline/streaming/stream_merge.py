"""K1: stream files into a table with the column-limited merge, exactly once.

A file source is read as a stream; every micro-batch is upserted into the
partitioned Parquet table with ``tables.upsert_table`` (copy-on-write of the
touched partitions only). ``availableNow`` processes what is there and stops,
so the same code serves a scheduled catch-up run and a continuous one. The
stream's checkpoint lives in the shared checkpoint folder, so a restarted
driver resumes from the last committed batch.

A batch's rows, deletions, watermark and number are one commit of the table.
A driver that dies between that commit and the checkpoint's makes Spark replay
the batch under the same number; the record shows that it is in, and it is
skipped. ``query`` names the stream in the record (the checkpoint's path by
default): two streams into one table keep their own numbers, and a stream that
starts over with a new checkpoint takes a new name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.sources import tables


def stream_merge(spark: SparkSession, source_path: str, schema: StructType, table_path: str,
                 key, partition_col: str, update_cols, checkpoint: str,
                 max_files_per_trigger: int | None = None, prepare=None,
                 deletes: Callable[[DataFrame], DataFrame] | None = None, watermark_col: str | None = None,
                 query: str | None = None) -> None:
    """``prepare`` makes a batch's rows for the table, ``deletes`` the rows
    whose keys go; a key may not be in both."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        b = prepare(batch) if prepare else batch
        tables.upsert_table(batch.sparkSession, table_path, b, key, partition_col, update_cols, watermark_col=watermark_col,
                            delete_keys=deletes(batch) if deletes else None, stream=(query or checkpoint, batch_id))

    q = (stream.writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
