"""Session settings and durable intermediate tables."""

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Bytes of input per shuffle task, and the most tasks: beyond, map outputs cost
# more than larger tasks do.
_BYTES_PER_TASK = 256 * 1024 * 1024
_MAX_SHUFFLE_TASKS = 50_000

# Paths written by ``durable`` in the open ``temporary_tables`` block of this thread's job.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session for the jobs; resource sizes stay with the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Hash instead of sort where the smaller side fits in memory task by task.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def wide_shuffles(*inputs: DataFrame) -> Iterator[None]:
    """Shuffle width for the size of ``inputs`` in this block; AQE may merge tasks again.

    Uses the planner's size of the input files and runs no job. Name each table
    once: the size of a filtered table is that of the whole. The session's own
    width is back when the block ends.
    """
    spark = inputs[0].sparkSession
    own = spark.conf.get("spark.sql.shuffle.partitions")
    plans = [df._jdf.queryExecution().optimizedPlan() for df in inputs]
    size = sum(int(str(plan.stats().sizeInBytes())) for plan in plans)
    wanted = min(math.ceil(size / _BYTES_PER_TASK), _MAX_SHUFFLE_TASKS)
    try:
        if wanted > int(own):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, since there driver and executors share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="ratingloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    The result survives lost executors without recomputing its lineage, and its
    file sizes give the planner true statistics, so a small table is broadcast
    and a large one is shuffled without any hint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    written = _written.get()
    if written is not None:
        written.append(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``durable`` writes in this block when it ends.

    For jobs: results must be written before the end of the block. Jobs in other
    threads keep theirs.
    """
    written: list[str] = []
    token = _written.set(written)
    try:
        yield
    finally:
        _written.reset(token)
        for name in written:
            remove(spark, name)


def remove(spark: SparkSession, name: str) -> None:
    """Delete a stored table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
