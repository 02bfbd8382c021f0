"""Sharding by jump consistent hashing.

A row's key is hashed to 64 bits; the key then jumps forward through the shard
numbers by its own pseudo-random sequence, and the last number below the shard
count is its shard. There is no table of shards to keep. With one shard more, a key
either stays or moves to the new shard, so only the necessary share of rows moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import kept, working, written
from tidegate.session import lookup

# Rows that one task numbers together.
BLOCK_ROWS = 1 << 16


def jump(keys, shards: int):
    """Shard of each unsigned 64-bit key, as numpy."""
    import numpy as np

    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    reach = np.zeros(len(state), np.float64)
    while len(active):
        shard[active] = reach[active].astype(np.int64)
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        reach[active] = np.floor((shard[active] + 1) * (2.0**31 / draw))
        active = active[reach[active] < shards]
    return shard.astype(np.int32)


def _jumper(counts: tuple[int, ...]):
    def run(keys):
        import numpy as np
        import pandas as pd

        raw = keys.to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({f"in_{n}": jump(raw, n) for n in counts})

    return F.pandas_udf(run, ", ".join(f"in_{n} int" for n in counts))


def _print(columns: list[str]) -> Column:
    """MD5 of columns written out, null as nothing, in hexadecimal digits."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).cast("binary"))


def _number(digits: Column, length: int) -> Column:
    """The first of some hexadecimal digits as a long, 16 of them as its bits."""
    return F.conv(F.substring(digits, 1, length), 16, -10).cast("long")


def assign(df: DataFrame, key_cols: list[str], counts: tuple[int, ...], into: str = "shards") -> DataFrame:
    """Add a struct with the shard of each row for every shard count, as ``in_<count>``.

    Any columns that can be written as text may be the key; null is a key like the empty
    text, and rows with equal keys share a shard. Nothing is shuffled.
    """
    return df.withColumn(into, _jumper(counts)(_number(_print(key_cols), 16)))


def place(df: DataFrame, shard: str, order: list[str], slot: str = "slot", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the rows of every shard from 0 without gaps, the same way whenever it is done.

    Rows are dealt into blocks by a hash of the columns ``order`` and numbered within a
    block by these columns, so a shard, or a key that holds a third of all rows, is the
    work of many tasks; block sizes summed up shift the numbers. Rows that agree in all of
    these columns, ``block_rows`` of them or more, come last in their shard; they are dealt
    at random, as any of them may have any of their numbers.
    """
    fixed = written(df.withColumn("_uid", F.monotonically_increasing_id()), "shard-rows")
    blocks = max(64, -(-fixed.count() // block_rows))
    dealt = fixed.withColumn("_print", _print(order)).withColumn("_block", F.pmod(_number(F.col("_print"), 15), F.lit(blocks)))
    sizes = _block_sizes(dealt.withColumn("_group", F.lit("")), shard)
    crowded = sizes.filter(F.col("_rows") >= block_rows).select(shard, "_block")
    if crowded.isEmpty():
        dealt = dealt.withColumn("_group", F.lit(""))
    else:
        inside = dealt.join(lookup(crowded), [shard, "_block"], "left_semi")
        alike = written(inside.groupBy("_print").agg(F.count(F.lit(1)).alias("_alike")).filter(F.col("_alike") >= block_rows), "shard-alike")
        dealt = dealt.join(lookup(alike), "_print", "left").withColumn("_group", F.when(F.col("_alike").isNull(), "").otherwise(F.col("_print")))
        anywhere = F.pmod(F.xxhash64("_uid"), F.ceil(F.col("_alike") / block_rows))
        dealt = dealt.withColumn("_block", F.when(F.col("_alike").isNull(), F.col("_block")).otherwise(anywhere)).drop("_alike")
        sizes = _block_sizes(dealt, shard)
    within = W.partitionBy(shard, "_group", "_block").orderBy(*[F.asc_nulls_first(c) for c in order], "_uid")
    before = W.partitionBy(shard).orderBy("_group", "_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_group", "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        dealt.withColumn("_rank", F.row_number().over(within) - 1)
        .join(lookup(offsets, sizes), [shard, "_group", "_block"])
        .withColumn(slot, F.col("_before") + F.col("_rank"))
        .drop("_uid", "_print", "_group", "_block", "_rank", "_before")
    )


def _block_sizes(dealt: DataFrame, shard: str) -> DataFrame:
    return written(dealt.groupBy(shard, "_group", "_block").agg(F.count(F.lit(1)).alias("_rows")), "shard-blocks")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row.

    ``size`` is the UTF-8 bytes of the text plus 8. A null text has no bytes, so its
    size is 8 and its checksum that of nothing, 0. Rows with equal ``doc_id`` (null
    too) go to the same shard and get slots of their own, which their size and checksum
    decide. ``grown_shard`` is the shard with one shard more. An empty table gives an empty
    result; further columns, of any names, do not matter.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = assign(rows, ["doc_id"], (shards, shards + 1))
    rows = rows.withColumn("shard", F.col(f"shards.in_{shards}")).withColumn("grown_shard", F.col(f"shards.in_{shards + 1}"))
    columns = ["doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"]
    with working(docs.sparkSession):
        return kept(place(rows.drop("shards"), "shard", ["doc_id", "size", "text_crc32"]).select(*columns), "shards")
