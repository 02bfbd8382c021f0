"""Row numbers within files and surrogate ids across files, without a global sort.

Every row has a position, a long that grows through its file (byte offset plus
line number for scanned files). Rows are cut into chunks of a fixed span of
positions, so a chunk is bounded however large the file is. Ranks are computed
inside chunks; the table of chunk sizes is tiny, and its running totals shift
the ranks into file-wide row numbers and ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.session import lookup, settle

CHUNK = "_chunk"
RANK = "_rank"
ORDINAL = "ordinal"
CHUNK_SPAN = 2**20
GROUP_OF_CHUNKS = 1024


def rank_in_chunks(df: DataFrame, file: str, pos: str, span: int = CHUNK_SPAN) -> DataFrame:
    window = W.partitionBy(file, CHUNK).orderBy(pos)
    return df.withColumn(CHUNK, F.floor(F.col(pos) / F.lit(span)).cast("long")).withColumn(
        RANK, F.row_number().over(window).cast("long")
    )


def tally_chunks(ranked: DataFrame, file: str, good: Column, *extras: Column) -> DataFrame:
    """Rows per chunk and the rank of its last good row, with other sums on demand."""
    return ranked.groupBy(file, CHUNK).agg(
        F.count(F.lit(1)).alias("chunk_rows"),
        F.max(F.when(good, F.col(RANK))).alias("last_good"),
        *extras,
    )


def _before(value: str, window) -> Column:
    earlier = window.rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0)).cast("long")


def chunk_offsets(tallies: DataFrame, file: str, base: int = 0) -> DataFrame:
    """``(file, chunk, rows_before, id_base, last_good)`` from a settled table of tallies.

    Running totals go in two steps, within groups of neighbouring chunks and
    over the groups, so that no task orders all chunks of one huge file. The
    last step orders files: one row each, as many as the file listing holds.

    Ids are given to all rows of a file before they are judged, and the next
    file continues after the last *good* id, so ids of bad rows at the end of a
    file are used again.
    """
    grouped = tallies.withColumn("_group", F.floor(F.col(CHUNK) / GROUP_OF_CHUNKS))
    in_group = grouped.withColumn(
        "_in_group", _before("chunk_rows", W.partitionBy(file, "_group").orderBy(CHUNK))
    )
    groups = (
        grouped.groupBy(file, "_group")
        .agg(F.sum("chunk_rows").alias("_group_rows"))
        .withColumn("_group_before", _before("_group_rows", W.partitionBy(file).orderBy("_group")))
    )
    chunks = in_group.join(groups, [file, "_group"]).select(
        file, CHUNK, "last_good", (F.col("_in_group") + F.col("_group_before")).alias("rows_before")
    )
    files = (
        chunks.groupBy(file)
        .agg(F.coalesce(F.max(F.col("rows_before") + F.col("last_good")), F.lit(0)).alias("_reach"))
        .withColumn("id_base", _before("_reach", W.orderBy(file)) + F.lit(base))
    )
    return chunks.join(files, file).select(file, CHUNK, "rows_before", "id_base", "last_good")


def apply_offsets(ranked: DataFrame, offsets: DataFrame, file: str) -> DataFrame:
    """Turn ranks inside chunks into ``ordinal`` (1-based, per file) and ``id``."""
    ordinal = F.col("rows_before") + F.col(RANK)
    return (
        ranked.join(offsets, [file, CHUNK])
        .withColumn(ORDINAL, ordinal)
        .withColumn("id", F.col("id_base") + ordinal)
        .drop(CHUNK, RANK, "rows_before", "id_base", "last_good")
    )


def number_rows(df: DataFrame, file: str, pos: str, good: Column | None = None, base: int = 0, span: int = CHUNK_SPAN) -> DataFrame:
    """Add ``ordinal`` and ``id`` (continuing from ``base``) in one call."""
    ranked = rank_in_chunks(df, file, pos, span)
    tallies = settle(tally_chunks(ranked, file, F.lit(True) if good is None else good))
    return apply_offsets(ranked, lookup(chunk_offsets(tallies, file, base), tallies), file)


def max_id(table: DataFrame) -> DataFrame:
    return table.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("max_id"))
