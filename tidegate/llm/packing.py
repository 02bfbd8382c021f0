"""Packing documents into token sequences by hierarchical best-fit.

Pieces that fill a sequence alone need no packing. The rest are dealt over partitions
of bounded size and packed best-fit, longest first. Bins that come out nearly full
are final. Underfull bins become items themselves, a bin's fill being its size, and
meet in fewer partitions in the next round, until one partition holds them all or a
round no longer joins any. No task ever sees more than ``PARTITION_ITEMS`` items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.bpe import Codec
from tidegate.llm.common import kept, keyed, slices, thrifty, working, written

PARTITION_ITEMS = 1 << 16
# A bin with fewer free places than this share of a sequence is final.
NEARLY_FULL = 0.004
# Another round is worth it if the last one brought the open bins down by this share.
WORTH = 0.02


def best_fit(sizes, capacity: int) -> list[list[int]]:
    """Bins, as lists of places in ``sizes``; each item goes where the least room is left."""
    import numpy as np

    sizes = np.asarray(sizes)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    some = 0  # bit r: there are bins with room r
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            into = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
            bins[into].append(item)
        else:
            room, into = capacity, len(bins)
            bins.append([item])
        room -= size
        if not rooms[room]:
            some |= 1 << room
        rooms[room].append(into)
    return bins


def _pack(capacity: int):
    """One partition's items, each a list of pieces, into bins."""

    def run(batches):
        import pyarrow as pa

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        items = pa.Table.from_batches(held)
        pieces, sizes, fill = (items.column(c).to_pylist() for c in ("pieces", "sizes", "fill"))
        bins = best_fit(fill, capacity)
        out = [
            ([p for i in b for p in pieces[i]], [s for i in b for s in sizes[i]], sum(fill[i] for i in b)) for b in bins
        ]
        for at in range(0, len(out), 4096):
            rows = out[at : at + 4096]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.int32()),
                ],
                ["pieces", "sizes", "fill"],
            )

    return run


def pack(pieces: DataFrame, capacity: int, partition_items: int = PARTITION_ITEMS) -> DataFrame:
    """``piece_id, sequence_id, offset`` for ``piece_id long, length int`` (1 to ``capacity``).

    A sequence's number is that of its first piece. Pieces of a sequence lie one after
    the other from 0. ``piece_id`` must be unique; lengths may tie in any way.
    """
    whole = pieces.filter(F.col("length") == capacity).select(
        "piece_id", F.col("piece_id").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    items = pieces.filter(F.col("length") < capacity).select(
        F.array("piece_id").alias("pieces"), F.array(F.col("length").cast("int")).alias("sizes"), F.col("length").cast("int").alias("fill")
    )
    schema = "pieces array<long>, sizes array<int>, fill int"
    final, left = [], items.count()
    while left:
        parts = -(-left // partition_items)
        bins = written(items.repartition(parts).mapInArrow(_pack(capacity), schema), "bins")
        full = F.col("fill") >= capacity * (1 - NEARLY_FULL)
        if parts == 1:
            final.append(bins)
            break
        items = bins.filter(~full)
        before, left = left, items.count()
        if left > (1 - WORTH) * before:
            final.append(bins)
            break
        final.append(bins.filter(full))
    if not final:
        return whole
    size_before = F.aggregate(F.slice("sizes", 1, F.col("at")), F.lit(0).cast("long"), lambda total, size: total + size)
    placed = (
        reduce(DataFrame.unionByName, final)
        .select("sizes", F.element_at("pieces", 1).alias("sequence_id"), F.posexplode("pieces").alias("at", "piece_id"))
        .select("piece_id", "sequence_id", size_before.alias("offset"))
    )
    return whole.unionByName(placed)


def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        codec = Codec(path)
        for batch in batches:
            for part in slices(batch):
                rows, raw = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = np.append(codec.encode(text), end_id).astype("<u4")
                    first = len(ids) % capacity or min(capacity, len(ids))
                    begin = 0
                    for k, end in enumerate(range(first, len(ids) + 1, capacity)):
                        data = ids[begin:end].tobytes()
                        rows.append((i, k, begin, end - begin, zlib.crc32(data)))
                        if keep_ids:
                            raw.append(data)
                        begin = end
                owner, *numbers = np.array(rows, np.int64).reshape(-1, 5).T
                arrays = [part.column("doc_id").take(pa.array(owner)), *(pa.array(np.ascontiguousarray(n)) for n in numbers)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays, names = [*arrays, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece of each row.

    A document is the ids of its whole text and then ``end_id``, so an empty or null
    text is one id. Only a document longer than ``capacity`` is cut; its first piece
    may be shorter, the others are full. ``keep_ids`` adds ``ids``, the piece as
    little-endian 32-bit numbers. Rows that repeat are packed each; an empty table
    gives an empty result.
    """
    with working(docs.sparkSession):
        source = keyed(docs, id_col, text_col)
        id_type = source.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {id_type}, piece long, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
        cut = source.mapInArrow(thrifty(_pieces(path, capacity, end_id, keep_ids)), schema)
        pieces = written(cut.withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
        placed = pack(pieces.select("piece_id", "length"), capacity)
        return kept(pieces.withColumn("piece", F.col("piece").cast("int")).join(placed, "piece_id").drop("piece_id"), "packed")
