"""Where intermediate tables go and when a side is small enough to broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000

#: Whether a job's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Tables written so far by each ``leaving_result`` or ``scratch`` that has not ended, the innermost last.
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (action).

    The result has no lineage to recompute, survives lost executors and, unlike a checkpoint,
    is columnar, so later readers prune columns. ``codec`` compresses it otherwise than the session says: zstd
    halves hex text and letters, which the default leaves as they are.
    """
    path = f"{shared_dir(df.sparkSession)}/seqframe-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    with freeing_shuffles(df.sparkSession):
        (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes made within leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` within go at its end; nothing that is used later may read them."""
    _open.append([])
    try:
        yield
    except BaseException:
        _open.pop()  # what stands is left for whoever looks into the failure
        raise
    for path in _open.pop():
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def leaving_result(spark: SparkSession, work: Callable[[], DataFrame]) -> DataFrame:
    """What ``work`` returns; of the tables it wrote on the way only those stay that the result reads (action).

    The result must be lazy over written tables and sources alone, as anything ``written`` is.
    """
    _open.append([])
    try:
        out = work()
        read = "\n".join(out.inputFiles()) if _open[-1] else ""
    except BaseException:
        _open.pop()  # what stands is left for whoever looks into the failure
        raise
    for path in _open.pop():
        if path.rsplit("/", 1)[-1] in read:
            if _open:
                _open[-1].append(path)
        else:
            _delete(spark, path)
    return out


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a bounded count (action) proves ``df`` has few rows."""
    return F.broadcast(df) if df.select(F.lit(1)).limit(rows + 1).count() <= rows else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition a source over all cores when it has fewer splits than cores, else leave it alone.

    A file with one row group is one task however much work each row needs. Large inputs have more
    splits than cores and are not touched, so they are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
