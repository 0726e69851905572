"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the plans rely on: adaptive joins with skew splitting.

    The JVM never compiles methods over 8,000 bytes, which long chains of text steps
    exceed when fused into one; such stages run faster unfused.
    """
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }.items():
        if not _set_by_user(spark, key):
            spark.conf.set(key, value)
    return spark


def _set_by_user(spark: SparkSession, key: str) -> bool:
    """Whether the caller's configuration names this setting."""
    return spark.sparkContext.getConf().contains(key)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by spark.checkpoint.dir.

    Only a local master, which has no other machines, may fall back to a
    temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = sc._jsc.sc().getCheckpointDir()
        configured = current.get() if current.isDefined() else None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="narrakin-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(configured)
    return configured


_given_out: ContextVar[list | None] = ContextVar("scratch paths and broadcasts of a run", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _given_out.get() is not None:
        _given_out.get().append(path)
    return path


def send(spark: SparkSession, value):
    """A broadcast, which goes with the scratch tables of its block."""
    sent = spark.sparkContext.broadcast(value)
    if _given_out.get() is not None:
        _given_out.get().append(sent)
    return sent


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made within this block when it ends."""
    token = _given_out.set([])
    try:
        yield
    finally:
        for made in _given_out.get():
            if isinstance(made, str):
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
            else:
                made.destroy()
        _given_out.reset(token)


#: Whether Spark deletes the shuffle files of an execution when it ends. Otherwise they stay until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: dict[int, int] = {}
_writing_lock = threading.Lock()


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of tables written within this block are deleted with each; the setting is then as it was.

    What is written is read back from its files, so its shuffles are not needed again.
    """
    if str(spark.conf.get(_CLEANUP, "false")).lower() == "true" and id(spark) not in _writing or _set_by_user(spark, _CLEANUP):
        yield
        return
    with _writing_lock:
        _writing[id(spark)] = _writing.get(id(spark), 0) + 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing_lock:
            _writing[id(spark)] -= 1
            if not _writing[id(spark)]:
                del _writing[id(spark)]
                spark.conf.unset(_CLEANUP)


def settle(df, name: str, path: str | None = None, mode: str = "overwrite"):
    """Write a table that several later steps read, and read it back.

    The table lies in the shared folder, so losing executors does not lose it.
    """
    path = path or scratch_path(df.sparkSession, name)
    with _shuffles_deleted(df.sparkSession):
        df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_turn(spark: SparkSession, name: str, steps: Iterable[Callable], path: str | None = None):
    """Rows of several steps, done one after another, in one stored table.

    Scratch tables of a step are deleted when its rows are stored, so that steps need no more disk than the largest of them.
    """
    path, done = path or scratch_path(spark, name), None
    for step in steps:
        with temporary_tables(spark):
            done = settle(step(), name, path, "append")
    return done


#: Rows of one slice of a table that is worked on in slices, if there are not more cores than these keep busy.
SLICE_ROWS, SLICE_ROWS_PER_CORE = 1 << 21, 1 << 18


def slice_rows(spark: SparkSession) -> int:
    return max(SLICE_ROWS, SLICE_ROWS_PER_CORE * spark.sparkContext.defaultParallelism)


def in_slices(rows, key: str, step: Callable, name: str, most: int | None = None):
    """step(cut) for slices of a table, one after another, put together.

    rows is a stored table; there are so many slices, by a hash of the key, that each has about ``most`` of its rows. cut
    leaves those rows of any table with that key which belong to the slice. A table of one slice is worked on as a whole.
    Slices of a slice must have another name, which the hash takes in.
    """
    n = max(1, -(-rows.count() // (most or slice_rows(rows.sparkSession))))
    if n == 1:
        return step(lambda df: df)
    own = F.pmod(F.xxhash64(key, F.lit(name)), F.lit(n))
    return in_turn(rows.sparkSession, name, [lambda i=i: step(lambda df: df.where(own == i)) for i in range(n)])


def together(*steps):
    """Results of steps that do not need each other, which submit their Spark jobs at the same time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(copy_context().run, step) for step in steps]]


#: Rows that one task works on where rows are small to move but slow to work on.
TASK_ROWS = 100_000


def spread(df, key: str, rows: int = 0, hashed: bool = False):
    """Hash rows over at least as many partitions as there are cores, and one for every TASK_ROWS.

    For rows that are small to move but slow to work on, where a size-based number
    of partitions would leave cores idle or tasks long. ``rows`` is how many there are, if they may be many.
    ``hashed`` rows may be hashed by the key already: their number of partitions then differs from that of other shuffles,
    because Spark leaves out a repartition into as many and merges what is there by size.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")) + hashed, spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(n, key)


def spread_scan(df, key: str):
    """As spread, for a plain file scan: its partitions follow bytes and row groups, whatever the work on a row."""
    return spread(df, key, df.count())


def slot_keys(spark: SparkSession, n: int) -> Column:
    """Array of n keys that repartition(n, key) puts in a partition of their own each, so that no task gets two large groups."""
    tried = 32 * n
    while True:
        keys = spark.range(tried).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("slot")).agg(F.min("id").alias("key")).collect()
        if len(keys) == n:
            return F.array(*[F.lit(row["key"]) for row in keys]).cast("array<long>")  # a key's hash depends on its type
        tried *= 4


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once."""
    sc = spark.sparkContext
    if getattr(sc, "_narrakin_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="narrakin-zip-")) / "narrakin.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._narrakin_shipped = True
