"""Session settings and the shared scratch folder every job writes through."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times are UTC, so the session zone must be too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Change one session setting for the length of a write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine and its contents die with it.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="newslake-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/newslake/{app}/{name}-{uuid.uuid4().hex[:12]}"


_SETTLED: ContextVar[tuple[list[str], ...]] = ContextVar("settled", default=())


@contextmanager
def released(spark: SparkSession) -> Iterator[list[str]]:
    """Tables settled within go at the end, but for those taken off the list. Nothing that is still to be computed may refer to them."""
    tables: list[str] = []
    token = _SETTLED.set((*_SETTLED.get(), tables))
    try:
        yield tables
    finally:
        _SETTLED.reset(token)
        conf = spark._jsc.hadoopConfiguration()
        for path in tables:
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(conf).delete(path, True)


DENSE = "zstd"  # for tables of whole texts: half the size, and copies near each other cost next to nothing


def settle(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    This cuts lineage in a way that survives losing executors. It also gives the
    planner the real size of the table, so a join broadcasts it only when it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = scratch_path(df.sparkSession, name)
    for tables in _SETTLED.get():
        tables.append(path)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame as the planner estimates it from its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Wide rows less those whose key is in a settled narrow table. Neither way sorts the wide rows: a small table is broadcast by the
    planner, a larger one is hashed by partition."""
    least = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return rows.join(gone if estimated_bytes(gone) <= least else gone.hint("shuffle_hash"), key, "left_anti")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a small input out to all cores before heavy work per row.

    One small file is one task, however costly its rows are. Only an input below
    one read split per core is moved; a larger one has splits enough and stays
    where it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores, key) if estimated_bytes(df) < split * cores else df


RANGE_BYTES = 128 * 1024 * 1024
UNKNOWN_BYTES = 2**62
MOST_RANGES = 100_000  # beyond this, tasks cost more than smaller ranges save


def in_ranges(df: DataFrame, *columns: str) -> DataFrame:
    """Range partition by columns, into ranges that a task can sort in memory.

    Adaptive execution merges ranges that are too small but never splits one, so a
    frame that is large for the configured number of partitions gets more. A frame
    of unknown size, which the planner takes for endless, gets the configured ones.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    needed = min(-(-size // RANGE_BYTES), MOST_RANGES)
    if size < UNKNOWN_BYTES and needed > configured:
        return df.repartitionByRange(needed, *columns)
    return df.repartitionByRange(*columns)
