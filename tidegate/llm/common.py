"""What the operators share: tables written once to the shared folder, names, sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import lookup, scratch_path

# Bytes of text that a task works on at a time, unless one text is longer, and of the
# batches in which rows come to it.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The folder for tables that only the operator at work reads, and those around it.
_folders: ContextVar[tuple[str, ...]] = ContextVar("folders", default=())


@contextmanager
def working(spark: SparkSession):
    """A folder of its own for what is ``written`` inside, removed at the end.

    What is returned from inside must not read those tables; it is ``kept``, which puts
    it beside the folder, where it belongs to whoever called: an outer ``working``, which
    removes it in turn, or the shared folder.
    """
    folder = scratch_path(spark, "work", _folder())
    token = _folders.set((*_folders.get(), folder))
    try:
        yield
    finally:
        _folders.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _folder(outer: int = 0) -> str | None:
    held = _folders.get()
    return held[-1 - outer] if len(held) > outer else None


def written(df: DataFrame, label: str, outer: int = 0) -> DataFrame:
    """Write a table once to the shared folder and read it from there.

    What reads it later neither computes it again nor depends on an executor that
    may be lost, and columns such as row numbers are fixed by it.
    """
    path = scratch_path(df.sparkSession, label, _folder(outer))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, label: str) -> DataFrame:
    """The same for a table that outlives the ``working`` folder around it."""
    return written(df, label, 1)


def thrifty(run):
    """A task's function that gives its memory back at its end, as a Python worker waits for more tasks."""

    def bounded(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
            if trim is not None:
                trim(0)

    return bounded


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, id_col: str, text_col: str, **extra) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and columns asked for, whatever else the table holds."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[c.alias(n) for n, c in extra.items()]
    )


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold ``limit`` bytes at most, or are one text."""
    import numpy as np

    _, offsets = flat(batch.column(text))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array):
    """Bytes of a text column in one array, and where each text begins (and the last ends); null is empty."""
    import numpy as np

    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(data, dtype=np.uint8), offsets


def only_kept(docs: DataFrame, decisions: DataFrame, id_col: str, key: str) -> DataFrame:
    """The rows that ``decisions`` (``doc_id, key, kept``) keeps, with all their columns.

    Rows are found by their id and the column ``key``, a hash of the text. Rows that
    agree in both are copies; of those that are kept only in part, one stays.
    """
    verdicts = kept(decisions.groupBy("doc_id", "key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("NOT kept OR n > 1"), "verdicts")
    gone, repeated = (verdicts.filter(c).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")) for c in ("NOT kept", "kept"))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col(key) == F.col("_key"))
    out = docs.join(lookup(gone), same, "left_anti")
    if not repeated.isEmpty():
        once = out.join(lookup(repeated), same, "left_semi").dropDuplicates([id_col, key])
        out = out.join(lookup(repeated), same, "left_anti").unionByName(once)
    return out


# Rows with one key from which the key is hot: its rows stay where they are and meet the
# other side by broadcast.
HOT_ROWS = 1 << 17


def join_keyed(rows: DataFrame, side: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """Join with a side that has each key once and says in ``count`` how many rows do.

    Keys of very many rows would each be one task's work in a shuffled join. There are at
    most as many of them as ``HOT_ROWS`` goes into the rows.
    """
    hot = side.filter(F.col(count) >= HOT_ROWS)
    if hot.isEmpty():
        return rows.join(side, keys, how)
    few = lookup(hot)
    cold = rows.join(lookup(hot.select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(cold.join(side.filter(F.col(count) < HOT_ROWS), keys, how))
