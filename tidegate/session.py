"""Session helpers: where shared files go, and how small tables are settled."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A lookup side is broadcast up to this size; beyond it Spark joins by shuffle.
BROADCAST_BYTES = 1 << 26

# Bytes that a value takes in a lookup side: a number, and any other beside its text.
NUMBER_BYTES, TEXT_BYTES = 8, 64

# Bytes of input per shuffle partition, and the most partitions a load asks for.
PARTITION_BYTES = 1 << 27
MOST_PARTITIONS = 50_000

_local_dir: str | None = None


# Settings that results or speed rely on. Dates are read and printed
# in UTC. Generated methods beyond 8000 bytes of bytecode are never compiled by
# the JVM, so a stage that would need one is better run operator by operator.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Settings that stand unless a session has its own. Spark looks up each path of a long
# list in a task of its own, up to 10,000 of them: a scan of a batch's files would cost a
# task, and its metrics sent to the driver, per file.
LISTING_TASKS = 100
DEFAULTS = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS)}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    for name, value in DEFAULTS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def steady_splits(spark: SparkSession) -> None:
    """Have files cut alike by every scan of the session, whatever executors come and go.

    Rows are placed by their split, and later scans of a file must find the same places.
    Spark sizes splits by the cores that are up when a scan is planned, unless it is told
    a number.
    """
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(name, str(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))))


@contextmanager
def shuffle_sized_for(spark: SparkSession, size: int):
    """Enough shuffle partitions for ``size`` bytes while a job runs.

    Adaptive execution merges partitions that turn out small, but cannot split
    the number it starts with.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    wanted = min(-(-size // PARTITION_BYTES), MOST_PARTITIONS)
    spark.conf.set(name, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session that names none (tests on one machine) gets a private one.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if _local_dir is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_dir = tempfile.mkdtemp(prefix="tidegate-")
    return _local_dir


def scratch_path(spark: SparkSession, label: str, below: str | None = None) -> str:
    """A fresh path below the shared folder, or below another."""
    return f"{(below or shared_dir(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def together(*jobs: Callable[[], object]) -> list:
    """Run independent small jobs side by side, so that each fills the gaps of the others; all end before it returns."""
    results: list = [None] * len(jobs)
    errors: list[BaseException] = []

    def run(i: int) -> None:
        try:
            results[i] = jobs[i]()
        except BaseException as error:
            errors.append(error)

    threads = [InheritableThread(target=run, args=(i,)) for i in range(1, len(jobs))]
    for thread in threads:
        thread.start()
    run(0)
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]
    return results


def settle(df: DataFrame) -> DataFrame:
    """Compute a small table once, durably, and read it from there afterwards."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def lookup(df: DataFrame, sized_by: DataFrame | None = None) -> DataFrame:
    """Mark a table for broadcast if it is small enough to send around.

    Rows are counted, not guessed, on the table itself or on a settled one with as
    many, and weighed by the table's columns, texts by their length; a larger table is
    left to a shuffled join.
    """
    measured = df if sized_by is None else sized_by
    texts = [f"`{f.name}`" for f in measured.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    wide = sum(NUMBER_BYTES if isinstance(f.dataType, T.NumericType) else TEXT_BYTES for f in df.schema)
    most = BROADCAST_BYTES // wide
    long = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in texts), F.lit(0).cast("long"))
    found = measured.select(long.alias("bytes")).limit(most + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if found.rows <= most and found.rows * wide + found.bytes <= BROADCAST_BYTES else df


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few known rows, planned as a local relation without a Python job."""
    fields = T.StructType.fromDDL(schema)
    records = [dict(zip(fields.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(fields)), fields)
