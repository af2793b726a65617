"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every finmart job relies on.  Timestamps in this data model are
# wall-clock (timestamp_ntz); the session zone is pinned so casts between
# date and timestamp are the same on every executor.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of data no longer referenced are removed (the shared
    # checkpoint folder does not grow with every run).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Long-lived sessions run many large plans; keep little per-query history.
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "200",
}


def get_spark(master: str | None = None, app: str = "finmart",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the finmart defaults.

    On a cluster leave ``master`` unset so spark-submit decides; locally the
    shuffle partition count should be close to the core count.
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


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used.  Only a local-mode session (tests, laptops) may fall back to
    a fresh temporary folder — a machine-local folder is useless on a cluster,
    so there we fail loudly instead.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage")
    path = tempfile.mkdtemp(prefix="finmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/finmart-scratch/{name}"


#: Rows of the largest table that one shuffle partition is meant for.
ROWS_PER_PARTITION = 100_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes that AQE joins small partitions to, and bytes of a file that one task reads, for
#: tables of so many rows (a small file counts as 1/32 of that, as by Spark's defaults).  A
#: row of ids takes a dozen bytes in a shuffle or a file and ten times that in a task's sort
#: or hash table, so Spark's 64 and 128 MB don't fit there.
_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
          "spark.sql.files.maxPartitionBytes": "32m", "spark.sql.files.openCostInBytes": "1m"}


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Lets shuffles begin with as many partitions as a table of ``rows`` rows needs,
    so that a task's sort fits its memory at any size; AQE joins those that turn out
    small, and tasks read pieces of files that fit as well.  A session that names its
    own numbers keeps them."""
    need = -(-rows // ROWS_PER_PARTITION)
    named = spark.conf.getAll  # without Spark's defaults
    large = need > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in {_INITIAL: str(need), **_BYTES}.items():
        mark = f"spark.finmart.{key}"  # what was set here, not by the session's owner
        given = named.get(key)
        if given is not None and given != spark.conf.get(mark, None):
            continue
        if large:
            spark.conf.set(key, value)
            spark.conf.set(mark, value)
        elif given is not None:
            spark.conf.unset(key)
            spark.conf.unset(mark)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """In this block, the shuffle files of a query go when it is done, not when the driver
    collects its garbage.  For queries that run once, such as writes: frames made in the block
    that run again make their shuffles again.  A session that has its own choice keeps it."""
    given = spark.conf.get(_FREED, None)
    if given is None:
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(_FREED)
