"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "cadence", master: str | None = None, cpus: int | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform hands out."""
    b = SparkSession.builder.appName(app)
    if master or cpus:
        b = b.master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (cpus or 8))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that a private folder serves both."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is left alone. Where
    it is unset, a local master gets a fresh private folder; any other master
    raises, because executors would not share one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cadence-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: dict[str, list[str]] = {}
#: Memos of stage tables, by keys that begin with the session's.
MEMOS: list[dict] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder; every call gets another one."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(session_key(spark), []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders that ``scratch_path`` named in this session, and forget the stage tables made of them; the number of
    folders deleted. Results that still read stage tables have to be written out before."""
    key, deleted = session_key(spark), 0
    for path in _SCRATCH.pop(key, []):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        deleted += bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
    for memo in MEMOS:
        for k in [k for k in memo if k[0] == key]:
            del memo[k]
    return deleted


PARTITION_BYTES = 16 << 20  # of a shuffle, at most, where AQE puts partitions together
INPUT_BYTES = 2 << 20       # of the input tables, for each partition a shuffle starts with
SCAN_BYTES = 16 << 20       # of files, at most, that a task reads: columns of small numbers take a few bytes a row there
MOST_PARTITIONS = 4096


def bound_partitions(spark: SparkSession, paths: list[str]) -> int:
    """Let the partitions of a shuffle grow in number with the input files ``paths``, not in size; the number they start with.

    A fixed number of partitions makes tasks that grow with the input, and AQE puts
    partitions together up to 64 MB of compressed rows, which is a GB or more in a
    sort or hash table. So are 128 MB of a file to the task that scans and combines
    them. Counts and sizes that the session sets finer are kept. Files of a shuffle are
    deleted when the execution that wrote them ends, not when the driver collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        size += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    first, advisory = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(first, None) or 0), min(MOST_PARTITIONS, -(-size // INPUT_BYTES)))
    spark.conf.set(first, str(n))
    for key, default, most in ((advisory, "64m", PARTITION_BYTES), ("spark.sql.files.maxPartitionBytes", "128m", SCAN_BYTES)):
        if jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, default)) > most:
            spark.conf.set(key, str(most))
    return n


def session_key(spark: SparkSession) -> str:
    """Stable key of a running session (application id), for per-session memos."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return str(id(spark))
