"""Exact top-k search by three-phase uniform threshold.

Vectors lie in blocks, and a block keeps one list of partial scores per query for each
part of the dimensions. A score is the sum of a vector's entries in the lists.

1. Each block names the first k of each list, with their whole scores. The k-th best of
   all whole scores named for a query is a score that k vectors reach: a safe cutoff.
2. The cutoff goes back to the blocks. A vector that reaches it must, in some list, lie
   at least an even share of the gap between the cutoff and the lists' lowest entries
   above that list's lowest entry. Entries that do are collected.
3. Whole scores are resolved exactly for the collected vectors only.

Queries are held in blocks too; a task sees one block of either kind, whatever the
number of rows. A block answers with k rows per query at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import kept, working, written

VECTOR_BLOCK = 2048
QUERY_BLOCK = 512
LISTS = 2
BROADCAST_BYTES = 32 << 20
# Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


def usable(vector: str) -> Column:
    """True where no component is missing, infinite or not a number, and the vector is there."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def _blocks(scale: float, rows: int):
    """Rows packed into blocks of whole-numbered vectors, all of the longest length in the block."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                vectors = part.column("vector")
                sizes = np.diff(np.asarray(vectors.offsets, np.int64))
                values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                matrix = np.zeros((len(sizes), sizes.max(initial=0)))
                matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = values
                ids = part.column("id").to_numpy().astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.tobytes()], pa.binary()), pa.array([matrix.astype("<f8").tobytes()], pa.binary()), pa.array([matrix.shape[1]], pa.int32())],
                    ["ids", "matrix", "width"],
                )

    return run


def _product(left, right):
    """Exact inner products of whole-numbered rows, as 64-bit numbers."""
    import numpy as np

    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if bound < EXACT:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


class _Pair:
    """The lists of one block of vectors for one block of queries."""

    def __init__(self, row, lists: int):
        import numpy as np

        self.ids, self.query_ids = (np.frombuffer(row[c], "<i8") for c in ("ids", "query_ids"))
        vectors = np.frombuffer(row["matrix"], "<f8").reshape(len(self.ids), -1)
        queries = np.frombuffer(row["query_matrix"], "<f8").reshape(len(self.query_ids), -1)
        width = min(vectors.shape[1], queries.shape[1])  # what a shorter vector lacks counts as 0
        cuts = np.linspace(0, width, lists + 1).astype(int)
        self.entries = [_product(queries[:, a:b], vectors[:, a:b]) for a, b in zip(cuts, cuts[1:])]
        self.own = self.query_ids[:, None] == self.ids[None, :]
        self.lowest = [e.min(axis=1, keepdims=True) for e in self.entries]

    def resolve(self, query, vector):
        return sum(e[query, vector] for e in self.entries)

    def best(self, chosen, k: int, floor=None):
        """Up to k chosen vectors of each query: ``(query, vector, score)``, ties to the smaller id."""
        import numpy as np

        query, vector = np.nonzero(chosen & ~self.own)
        score = self.resolve(query, vector)
        if floor is not None:
            enough = score >= floor[query]
            query, vector, score = query[enough], vector[enough], score[enough]
        order = np.lexsort((self.ids[vector], -score, query))
        query, vector, score = query[order], vector[order], score[order]
        first = np.searchsorted(query, query)
        kept = np.arange(len(query)) - first < k
        return query[kept], vector[kept], score[kept]


def _named(k: int, lists: int):
    """Phase 1: whole scores of the first k entries of each list."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                pair = _Pair(row, lists)
                chosen = np.zeros(pair.own.shape, bool)
                most = min(k + 1, len(pair.ids))  # one more: a query's own vector may be among them
                for entries in pair.entries:
                    top = np.argpartition(entries, len(pair.ids) - most, axis=1)[:, len(pair.ids) - most :]
                    np.put_along_axis(chosen, top, True, axis=1)
                query, _, score = pair.best(chosen, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(query), row["query_block"]), pa.int64()), pa.array(query.astype(np.int32)), pa.array(score)],
                    ["query_block", "query", "score"],
                )

    return run


def _resolved(k: int, lists: int):
    """Phases 2 and 3: vectors with a sufficient entry, their scores resolved."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                pair = _Pair(row, lists)
                lowest = sum(pair.lowest)
                cutoff = np.full(len(pair.query_ids), np.iinfo(np.int64).min)
                for entry in row["cutoffs"] or []:
                    cutoff[entry["query"]] = entry["cutoff"]
                bounded = (cutoff > np.iinfo(np.int64).min)[:, None]
                share = np.where(bounded, (np.where(bounded, cutoff[:, None], lowest) - lowest) / lists, 0.0)
                chosen = ~np.broadcast_to(bounded, pair.own.shape)
                for entries, low in zip(pair.entries, pair.lowest):
                    chosen = chosen | (entries - low >= np.floor(share))
                query, vector, score = pair.best(chosen, k, cutoff)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(query), row["query_block"]), pa.int64()),
                        pa.array(query.astype(np.int32)),
                        pa.array(pair.query_ids[query]),
                        pa.array(pair.ids[vector]),
                        pa.array(score),
                    ],
                    ["query_block", "query", "query_id", "id", "score"],
                )

    return run


def _packed(df: DataFrame, id_col: str, vector_col: str, scale: float, rows: int, name: str) -> DataFrame:
    """Blocks of the usable rows, numbered from 1."""
    sound = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = sound.filter(F.col("id").isNotNull() & usable("vector"))
    blocks = sound.mapInArrow(_blocks(scale, rows), "ids binary, matrix binary, width int").withColumn("uid", F.monotonically_increasing_id())
    blocks = written(blocks, "blocks")
    numbers = blocks.select("uid", F.row_number().over(W.orderBy("uid")).cast("long").alias(name))  # two numbers per block
    return written(blocks.join(numbers, "uid").drop("uid", "width"), name)


def _met(blocks: DataFrame, asked: DataFrame, counts: tuple[int, int], size: int) -> DataFrame:
    """Every block of vectors beside every block of queries.

    Queries of a checked size are broadcast and vectors stay where they are; more of
    them are dealt out by pair of blocks, so that each pair is a key of its own.
    """

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(1).cast("long"), F.lit(count).cast("long")) if count else F.array().cast("array<long>"))

    beside = blocks.withColumn("query_block", numbers(counts[0]))
    if size <= BROADCAST_BYTES:
        return beside.join(F.broadcast(asked), "query_block")
    return beside.join(asked.withColumn("vector_block", numbers(counts[1])), ["query_block", "vector_block"])


def search(
    vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", lists: int = LISTS
) -> DataFrame:
    """``query_id, rank, <id_col>, score``: each query's k best vectors by inner product.

    Components become ``floor(scale * x)``; scores are whole and must fit 64 bits. A
    vector's own row is no candidate: rows with the query's id are left out. Rows whose
    id or vector is null, or that hold a null or non-finite component, take no part.
    Ties go to the smaller id. Fewer candidates than k are all returned. Vectors of
    unlike length are compared as if the shorter ended in zeros; an empty vector scores
    0. Rows that repeat an id are candidates each; a query that repeats is answered each
    time. No queries or no candidates give an empty result.
    """
    with working(vectors.sparkSession):
        return kept(_found(vectors, queries, k, scale, id_col, vector_col, lists), "nearest")


def _found(vectors: DataFrame, queries: DataFrame, k: int, scale: float, id_col: str, vector_col: str, lists: int) -> DataFrame:
    asked = _packed(queries, id_col, vector_col, scale, QUERY_BLOCK, "query_block").select(
        "query_block", F.col("ids").alias("query_ids"), F.col("matrix").alias("query_matrix")
    )
    blocks = _packed(vectors, id_col, vector_col, scale, VECTOR_BLOCK, "vector_block")
    counts = asked.count(), blocks.count()
    bytes_asked = asked.agg(F.sum(F.length("query_matrix"))).first()[0] or 0
    named = _met(blocks, asked, counts, bytes_asked).mapInArrow(_named(k, lists), "query_block long, query int, score long")
    leading = F.row_number().over(W.partitionBy("query_block", "query").orderBy(F.desc("score")))
    cutoffs = (
        named.withColumn("place", leading)
        .filter(F.col("place") <= k)
        .groupBy("query_block", "query")
        .agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == k)
        .groupBy("query_block")
        .agg(F.collect_list(F.struct("query", "cutoff")).alias("cutoffs"))
    )
    informed = written(asked.join(written(cutoffs, "cutoffs"), "query_block", "left"), "informed-queries")
    found = _met(blocks, informed, counts, bytes_asked).mapInArrow(_resolved(k, lists), "query_block long, query int, query_id long, id long, score long")
    rank = F.row_number().over(W.partitionBy("query_block", "query").orderBy(F.desc("score"), F.asc("id")))
    return (
        found.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )
