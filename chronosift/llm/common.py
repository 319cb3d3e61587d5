"""What the corpus operators share: the cluster's folder, written stages, Arrow helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LIBC = ctypes.CDLL(None)

#: ASCII white space, as the contracts list it: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local master may go without the setting; it then gets a temporary folder, one for each application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="chronosift-")
    return _OWN[sc.applicationId]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing needs any more."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended; the folder then stays for the cluster's own cleaning
        return


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is written to the shared folder inside goes at the end; for work whose result has then been written elsewhere."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed at the end of the scratch scope, or when the driver exits."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    else:
        atexit.register(remove, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it again.

    Unlike an executor-local cache the files outlive any executor.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "snappy").parquet(path)  # mostly hashes; zstd's buffers would stay with the executor
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def collector_off():
    """No walks of Python's cycle collector over large tables without cycles; it is as before afterwards, since workers are used again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def give_back() -> None:
    """Return freed memory of large arrays to the system, where the C library can; workers are used again and would hold it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def bounded_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """From now on the session's Arrow batches have ``most`` bytes at most, or one row; a lower bound stays. A batch is held by the JVM, the worker and in what the worker
    returns, so that each task holds some of them at once, of 64 MB with Spark's own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > most:
        spark.conf.set(key, str(most))


def crc_mod(col: str | Column, n: int) -> Column:
    """crc32 of the column as text, modulo n."""
    return F.crc32(F.col(col).cast("string").cast("binary") if isinstance(col, str) else col.cast("string").cast("binary")) % F.lit(n)


def by_bytes(sizes: list[int], limit: int):
    """Yield (start, end) over consecutive rows of about ``limit`` bytes, one row at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batches, limit: int = 4 << 20):
    """Cut Arrow batches with columns (doc_id, text) into (ids, texts) lists of bounded bytes; null text is empty."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        if texts.offset == 0 and batch.num_rows and texts.nbytes <= limit:
            yield ids.to_pylist(), [x or "" for x in texts.to_pylist()]
            continue
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for a, b in by_bytes(sizes, limit):
            yield ids.slice(a, b - a).to_pylist(), [x or "" for x in texts.slice(a, b - a).to_pylist()]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until the table has no such column."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        out.append(n)
    return out


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns that a text operator reads, whatever else the table has."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
