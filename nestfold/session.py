"""Session construction and the shared scratch folder.

Everything that writes intermediate data (round trips, landed stream input,
id-history versions) writes below the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared storage on a real cluster; a
machine-local temporary folder is only created when the setting is absent,
which happens in local tests.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local test or bench session uses. On a cluster the deployment
# provides its own; ``builder`` only fills in what is unset.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "12g",
    "spark.ui.showConsoleProgress": "false",
}


def builder(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "nestfold", extra: dict | None = None):
    """Session builder for local runs. ``extra`` adds settings, e.g. the SQL
    extension and catalog of a lake-table format when its package is on the
    class path."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    for k, v in LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    for k, v in QUERY_SETTINGS.items():
        b = b.config(k, v)
    return b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))


# Join and partition settings every query runs with. The static planner's size
# estimates come from compressed file sizes and shrink through projections and
# aggregates, so a multi-gigabyte side can look "small" and be broadcast. Static
# broadcasting is therefore off; AQE broadcasts a join side only once its
# shuffle output has been *measured* below the adaptive threshold, and
# otherwise keeps the shuffle join (splitting skewed partitions).
QUERY_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # groups of rows that are sorted by their key already are built one by one
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}

# A shuffle starts with one partition for so many bytes of input files, or with
# the session's number if that is more, and AQE joins small ones. A fixed number
# would let what a task sorts or groups grow with the tables until it spills.
PARTITION_INPUT_BYTES = 4 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tuned(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """A session beside ``spark`` (same context and tables, settings copied)
    with the query settings; those of ``spark`` stay as they are. ``folder``
    names the input whose size the number of shuffle partitions follows."""
    beside = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for k, v in QUERY_SETTINGS.items():
        beside.conf.set(k, v)
    if folder is not None:
        p, fs = _fs_path(spark, folder)
        by_size = math.ceil(fs.getContentSummary(p).getLength() / PARTITION_INPUT_BYTES)
        least = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
        beside.conf.set(INITIAL_PARTITIONS, str(max(least, by_size)))
    return beside


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a local session has none (a test) is a fresh temporary folder
    made and registered as the checkpoint folder. On a cluster a folder of the
    driver's disk would be of no use to the executors, so there the setting is
    required.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="nestfold-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs_path(spark, path)
    fs.delete(p, True)


def mark_done(spark: SparkSession, folder: str) -> None:
    p, fs = _fs_path(spark, folder.rstrip("/") + "/_LANDED")
    fs.create(p, True).close()


_LANDED: dict[tuple, str] = {}


def landed(spark: SparkSession, name: str, key: tuple, write) -> str:
    """A derived input written once per session below the shared folder and
    reused while it exists (``write(path)`` writes it). Stands in for a
    landing zone that external producers fill."""
    k = (spark.sparkContext.applicationId, checkpoint_root(spark), name) + tuple(key)
    path = _LANDED.get(k)
    if path is not None and path_exists(spark, path + "/_LANDED"):
        return path
    path = scratch_path(spark, name)
    write(path)
    mark_done(spark, path)
    _LANDED[k] = path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path in the session's own folder below the shared
    checkpoint folder. That folder is removed when the session's JVM ends."""
    folder = f"{checkpoint_root(spark)}/nestfold/{spark.sparkContext.applicationId}"
    p, fs = _fs_path(spark, folder)
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
