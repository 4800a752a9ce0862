"""Intermediate tables in the shared folder, and size-checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no folder, as in tests on one machine.
LOCAL_FOLDER = "/tmp/checkpoints/inkmill"

#: Most bytes of a batch that goes to a Python worker while an intermediate table is written; a batch is held several times over.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Stored size of a row group of an intermediate table. A writer holds a row group and a reader's column vectors never span two, so this bounds both.
ROW_GROUP_BYTES = 2 << 20

_scopes = threading.local()
_left: list[DataFrame] = []  # tables that results handed out still read


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; LOCAL_FOLDER where unset, on one machine only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(named or LOCAL_FOLDER).rstrip('/')}/inkmill-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str = "step", buckets: int | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` into the shared folder and return a scan of what was written.

    This cuts the lineage of iterative plans; a lost executor loses no finished
    round. With ``buckets`` the table is bucketed and sorted by the column
    ``by``. Inside a ``scoped`` function the table is deleted at its end,
    unless the result reads it.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    writer = df.write.option("parquet.block.size", ROW_GROUP_BYTES)
    held = getattr(_scopes, "stack", None) or [_left]
    if buckets:
        mark = _Written(path, f"inkmill_{name}", spark)
        held[-1].append(mark)
        with _small_batches(spark):
            writer.option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(mark._inkmill_name)
        table = spark.table(mark._inkmill_name)
        table._inkmill_name = mark._inkmill_name
    else:
        held[-1].append(_Written(path, None, spark))
        with _small_batches(spark):
            writer.parquet(path)
        table = spark.read.schema(df.schema).parquet(path)
    table._inkmill_path = path
    return table


@contextlib.contextmanager
def _small_batches(spark: SparkSession):
    """Batches of at most BATCH_BYTES, or as few as the session asks for; the session's own setting comes back."""
    before = spark.conf.get(_BATCH_CONF, None)
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) if before else 0
    spark.conf.set(_BATCH_CONF, str(min(own, BATCH_BYTES) if own > 0 else BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before) if before is not None else spark.conf.unset(_BATCH_CONF)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder for files that a writer leaves; it goes as a written table does."""
    path = f"{shared_folder(spark)}/{label}_{uuid.uuid4().hex}"
    (getattr(_scopes, "stack", None) or [_left])[-1].append(_Written(path, None, spark))
    return path


class _Written:
    """Place of a written table, known before the job that writes it starts."""

    def __init__(self, path: str, name: str | None, spark: SparkSession) -> None:
        self._inkmill_path, self._inkmill_name, self.sparkSession = path, name, spark


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no plan reads any more."""
    for table in tables:
        spark = table.sparkSession
        if getattr(table, "_inkmill_name", None):
            spark.sql(f"drop table if exists {table._inkmill_name}")
        _delete(spark, table._inkmill_path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _read_by(result) -> set[str]:
    """The parts of all paths that a result's plan scans; a scan may lie below a scratch folder."""
    if not isinstance(result, DataFrame):
        return set().union(*map(_read_by, result)) if isinstance(result, tuple | list) else set()
    leaves, found = result._jdf.queryExecution().analyzed().collectLeaves(), set()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            paths = leaf.relation().location().rootPaths()
            found |= {part for i in range(paths.size()) for part in paths.apply(i).toString().split("/")}
    return found


def scoped(f: Callable) -> Callable:
    """Delete the tables that a call of ``f`` wrote when it ends, also by an error; those its result reads pass to the caller's scope.

    What the results of outermost calls read is deleted when the program ends,
    or by ``release``.
    """

    @functools.wraps(f)
    def run(*args, **named):
        stack = _scopes.__dict__.setdefault("stack", [])
        stack.append([])
        read: set[str] = set()
        try:
            out = f(*args, **named)
            read = _read_by(out)
            return out
        finally:
            mine = stack.pop()
            after = stack[-1] if stack else _left
            kept = [t for t in mine if t._inkmill_path.rsplit("/", 1)[-1] in read]
            after += kept
            discard(*[t for t in mine if t not in kept])

    return run


def release() -> None:
    """Delete all tables that earlier results read; call it when those results have been used."""
    while _left:
        discard(_left.pop())


@atexit.register
def _at_end() -> None:
    spark = SparkSession._instantiatedSession
    if _left and spark and spark.sparkContext._jsc:
        folder = shared_folder(spark)
        _left.clear()
        _delete(spark, folder)


def broadcast_if_small(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, which are counted first; unmarked beyond."""
    rows = df.limit(limit + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= limit else df


def rows_in(df: DataFrame, keys: DataFrame, on: list[str], keep: bool = True, limit: int = 200_000) -> DataFrame:
    """The rows of ``df`` whose columns ``on`` are in ``keys`` (``keep``), or are not.

    ``keys`` is a written table of narrow keys. Up to ``limit`` of them, counted
    first, are sent to the scan and ``df`` is not shuffled; more meet ``df`` in a
    join by key. A null in a key is in no table.
    """
    keys = keys.select(*on)
    small = keys.limit(limit + 1).count() <= limit
    found = df.join(F.broadcast(keys) if small else keys.hint("merge"), on, "left_semi" if keep else "left_anti")
    return found.select(*[F.col(f"`{c}`") for c in df.columns])
