"""Shared-folder tables that cut lineage, and the session settings they rely on.

Operators that need a narrow intermediate result more than once (keys, group
sizes, edges) write it to the shared folder of the cluster and read it back.
The written table survives lost executors, and its real size is known to the
planner, which then broadcasts it only when it is below
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context_folder = spark.sparkContext.getCheckpointDir()
    if context_folder:
        return context_folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="run-")
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_id(df: DataFrame, label: str, id_col: str, buckets: int) -> str:
    """Write ``df`` in buckets by id and return the name of the table.

    ``df`` must be partitioned by id into ``buckets`` partitions already, as it is after
    ``repartition(buckets, id_col)`` and after joins by id of such a table; then no row
    moves. Joins by id read the table without an exchange on its side.
    """
    path = new_path(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(buckets, id_col).option("path", path).saveAsTable(name)
    return name


# A plan that reads more than this does not know what it reads.
UNKNOWN_BYTES = 1 << 50


def buckets_for(df: DataFrame) -> int | None:
    """Buckets of about one split each for a table too large for joins by id to be broadcast joins.

    An id is less than 1/200 of a document, so below 200 times the broadcast limit the ids
    of any share of the rows are broadcast, texts stay where they are, and no buckets are
    needed. The size is that of the tables that the plan reads; where that is not known,
    there are no buckets either.
    """
    session = df.sparkSession
    conf = session._jsparkSession.sessionState().conf()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size()))
    if size > UNKNOWN_BYTES or 0 <= size <= 200 * conf.autoBroadcastJoinThreshold():
        return None
    return max(session.sparkContext.defaultParallelism, -(-size // conf.filesMaxPartitionBytes()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition when the input has fewer splits than the cluster has cores.

    A small single file is read by one task. Large inputs already have more splits than
    cores and are returned unchanged, so nothing is shuffled there. Splits are told from
    the number of files and the planner's size estimate; no job is started.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if len(df.inputFiles()) >= cores or size >= split * cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)
