"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.session import ensure_checkpoint_dir

#: Text handled at once inside a Python task (code points); bounds the word
#: lists that live at a time, whatever the Arrow batch holds.
SLICE_CHARS = 2_000_000
#: Bytes of the batches that Python tasks are sent.  Executor and worker hold a batch several
#: times over, in each task.
BATCH_BYTES = "8m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, unless
    it is installed for them (as it should be on a cluster)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def small_batches(spark: SparkSession) -> None:
    """Python tasks get their rows in batches of ``BATCH_BYTES`` (a longer row comes alone).
    A session that names its own size keeps it."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, BATCH_BYTES)


_TURN: list = []


def worker_turns_to(operator: str, forget: Callable[[], None] | None = None) -> None:
    """Called where an operator begins in a Python worker.  Workers serve all operators of a
    session in turn: what the one before keeps there (its ``forget`` drops it) goes first, and
    the memory that it leaves goes back to the system."""
    if _TURN and _TURN[0] != operator:
        if _TURN[1]:
            _TURN[1]()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # glibc alone has it
            ctypes.CDLL(None).malloc_trim(0)
    _TURN[:] = operator, forget


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows written once to the cluster's shared checkpoint folder; what is
    built on them never recomputes the Python or shuffle work before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder, read back
    (keeps column pruning, unlike a checkpoint)."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_slices(texts: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """``(first row, texts)`` pieces of an Arrow string column, null as empty,
    each of about ``limit`` characters (one longer text stands alone)."""
    start, size, out = 0, 0, []
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        if out and size + len(text) > limit:
            yield start, out
            start, size, out = i, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield start, out


def only_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, as a fresh selection, so extra columns of the
    caller can neither clash nor travel."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(extra)) for b in range(256)]
