"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume. ANSI stays on (division by zero raises, so
# every ratio goes through nullif); NTZ timestamps are read as wall clock, so
# the session zone only matters for the anomaly frame, which orders by UTC
# micros.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "ledgerline") -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass nothing: master and shuffle width come from the
    submitting environment. Tests and the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Cluster sizing. Scan splits and shuffle partitions aim at ~256 MB each: large
# enough that a 100 TB stage is not millions of tiny tasks, small enough that
# a task's sort and hash buffers fit in executor memory without heavy spill.
PARTITION_BYTES = 256 * 1024 * 1024
# Parquet is compressed and columnar; a shuffled row is wider in memory.
SHUFFLE_EXPANSION = 3.0


def shuffle_partitions_for(input_bytes: int, parallelism: int,
                           partition_bytes: int = PARTITION_BYTES,
                           expansion: float = SHUFFLE_EXPANSION) -> int:
    """Shuffle width for the largest shuffle of a job over ``input_bytes``.

    At least two tasks per core, and no upper limit: a partition stays at
    ``partition_bytes`` however large the input. AQE then coalesces the small
    shuffles (post-aggregation) back down to the advisory size."""
    want = -(-int(input_bytes * expansion) // partition_bytes)
    return max(2 * parallelism, want)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size on storage of ``paths`` (one metadata call per path)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        total += hp.getFileSystem(conf).getContentSummary(hp).getLength()
    return total


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster's file system (HDFS, object
    stores, local), through Hadoop's FileSystem rather than the driver's
    local disk."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hp.getFileSystem(conf).exists(hp))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on the cluster's file system, if it is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(conf).delete(hp, True)


def size_for_input(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Set scan split, advisory and shuffle partition sizes from the input's
    size, for settings the cluster's own configuration leaves unset. Returns
    what was set. Local (test) sessions are left as they are."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return {}
    n = shuffle_partitions_for(input_bytes(spark, paths), sc.defaultParallelism)
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(n),
    }
    own = dict(spark.sparkContext.getConf().getAll())
    defaults = spark.newSession().conf  # the cluster's settings, before anyone changed this session's
    done = {}
    for k, v in wanted.items():
        if k not in own and spark.conf.get(k) == defaults.get(k):
            spark.conf.set(k, v)
            done[k] = v
    return done


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    and the master is local (a test run) is a scratch folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder "
                               "(a machine-local folder does not survive executor loss)")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = os.path.join(base, "ledgerline", name)
    return path
