"""Session helpers: shared scratch location and a local session for tests and the bench."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or a directory already set on the context). Only
    when neither is set on a local-mode session (tests) a private temporary folder is
    created and registered; on a cluster a machine-local folder would not be shared by the
    executors, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: tillroll writes its intermediate tables to "
                "that shared folder; set it to a path every executor can reach."
            )
        root = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None where there is none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise on access
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


_SCOPES: list[list[str]] = []
_LIVE: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder. Inside a
    :func:`scratch_scope` it is deleted when the scope ends, else when the program ends."""
    path = f"{checkpoint_root(spark)}/tillroll/{name}-{uuid.uuid4().hex[:12]}"
    if not _LIVE:
        atexit.register(_drop_live)
    _LIVE.add(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_NAMES: dict[str, str] = {}


def scratch_table(path: str) -> str:
    """A catalog name for a scratch path; it is dropped together with the path."""
    _NAMES[path] = f"tillroll_{uuid.uuid4().hex}"
    return _NAMES[path]


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system it lies in."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table whose readers are done."""
    _LIVE.discard(path)
    if path in _NAMES:
        spark.sql(f"DROP TABLE IF EXISTS {_NAMES.pop(path)}")
    if _context(spark) is not None:
        at, fs = file_system(spark, path)
        fs.delete(at, True)


def _drop_live() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_LIVE):
        try:
            drop_scratch(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended; the folder is the cluster's to clean
            return


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch tables made inside are deleted at the end; frames that read them must have
    been used by then."""
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        for path in _SCOPES.pop():
            drop_scratch(spark, path)


# Rows of a shuffle partition that a task sorts or hashes in memory, whatever their width here.
ROWS_PER_PARTITION = 250_000


@contextmanager
def spread_for(spark: SparkSession, rows: int | None, per: int = ROWS_PER_PARTITION) -> Iterator[int]:
    """Raises the session's number of shuffle partitions for a job over ``rows`` rows, so that a
    partition holds at most about ``per`` of them, and sets it back at the end; adaptive
    execution merges those that turn out small. A number that is high enough stays."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = max(int(before), -(-(rows or 0) // per))
    if needed > int(before):
        spark.conf.set(key, str(needed))
    try:
        yield needed
    finally:
        if needed > int(before):
            spark.conf.set(key, before)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Results of independent Spark actions that are started at the same time, so that small
    ones fill the cores that the last tasks of others leave idle. The first error is raised
    once all have ended."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inherit(job)) for job in jobs]
    return [r.result() for r in running]


def input_state(spark: SparkSession, path: str) -> str:
    """Name, length and modification time of the files under a path, as one string."""
    at, fs = file_system(spark, path)
    if not fs.exists(at):
        return "missing"
    files, out = fs.listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return ",".join(sorted(out))


# Suggested settings for the full-scale job (~100 TB of raw transactions, ~1,000 executors of
# 4 cores). Input splits of 1 GB make 100,000 map tasks, 25 waves on 4,000 cores. 20,000
# shuffle partitions hold 5 GB of raw rows each before column pruning and compression, about
# 1 GB shuffled, and AQE merges small ones towards 1 GB. Map tasks times partitions is 2e9
# blocks of about 50 KB, which is what push-based shuffle is for: it merges them per
# partition on the way, so a reducer reads large chunks. Skewed join partitions are split at
# run time; broadcasts are limited to what the planner can prove small (derived lookups are
# additionally row-count checked in operators/joins.py).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1g",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


# To be given when the session is made: not settable at run time.
CLUSTER_STATIC_CONF = {
    "spark.shuffle.push.enabled": "true",
    "spark.shuffle.service.enabled": "true",
}


def apply_conf(spark: SparkSession, conf: dict[str, str] = CLUSTER_CONF) -> SparkSession:
    """Set runtime SQL settings on an existing session (only keys that are runtime-settable)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    """Local session for tests/bench (the library itself never creates sessions)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
