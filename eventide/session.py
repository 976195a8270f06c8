"""Session helpers.

The library never assumes it owns the session: every operator takes the
DataFrames it is given.  These helpers build a session for tests, bench and
examples, and resolve the shared checkpoint folder a cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session built here gets.  Event times are compared against
# DuckDB and against fixture values, so the session zone is pinned to UTC;
# the operators themselves do their epoch arithmetic time-zone free.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # transformWithState needs the RocksDB state store; harmless otherwise.
    # The Python state API talks to the JVM per call; a Unix domain socket
    # avoids TCP round-trip latency on every state read/write.
    "spark.python.unix.domain.socket.enabled": "true",
    # RocksDB state: commit a change log instead of a snapshot per batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app: str = "eventide", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps its own values.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used as is.  Only when nothing is configured on a local master (tests)
    a fresh scratch folder is created; on a cluster that is an error, since a
    folder of the driver's own disk is not there for the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``"dir"``, ``"file"`` or None (not there), for any path Spark can read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return "dir" if fs.getFileStatus(p).isDirectory() else "file"


MB = 1 << 20


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of compressed input.

    Scan splits and shuffle partitions are sized so one task handles about
    ``target_partition_bytes`` (fits executor memory with room to spill);
    AQE starts from that partition count and coalesces small ones, splits
    skewed join partitions, and only broadcasts a side measured below the
    threshold at run time.  E.g. 100 TB on 8000 cores -> 409600 initial
    shuffle partitions, coalesced by AQE to what the data after partial
    aggregation needs.
    """
    parts = max(2 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
    }
