"""Exact deduplication by recipes of content-defined chunks.

A text is normalised and cut where a rolling hash of its last 16 bytes says so, so
equal texts are cut alike. Chunks are deduplicated by content: one shuffle brings the
distinct chunks of a hash together, and the few hashes that stand for several
contents (a collision) get one number per content. After this check a hash, or a hash
with its number, identifies a content. Texts are equal when their ordered lists of
identifiers are, so later steps move lists of 8-byte numbers and never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import join_keyed, kept, keyed, slices, working, written
from tidegate.llm.words import normalised

# A chunk ends where this many leading bits of the rolling hash are 0: 4 KiB on average.
CUT_BITS = 12
# A longer stretch without such a place is cut here.
LONGEST = 1 << 16
HEAD = 64


def _gear():
    import numpy as np

    return np.random.Generator(np.random.PCG64(7)).integers(0, 2**32 - 1, 256, dtype=np.uint32, endpoint=True)


def chunks_of(texts: list[bytes], gear, cut_bits: int = CUT_BITS, longest: int = LONGEST) -> list[list[bytes]]:
    """Cut each text into chunks; where depends on the text alone."""
    import numpy as np

    data = b"".join(texts)
    rolling = gear[np.frombuffer(data, np.uint8)]
    for width in (1, 2, 4, 8):
        grown = rolling.copy()
        grown[width:] += rolling[:-width] << np.uint32(width)
        rolling = grown
    places = np.flatnonzero(rolling >> np.uint32(32 - cut_bits) == 0) + 1
    out, begin = [], 0
    for text in texts:
        end = begin + len(text)
        low, high = np.searchsorted(places, [begin + HEAD, end])
        cuts = [begin, *places[low:high].tolist(), end]
        out.append([data[a : min(a + longest, b)] for s, b in zip(cuts, cuts[1:]) for a in range(s, b, longest)])
        begin = end
    return out


def _hashed(bits: int):
    import xxhash

    def of(chunk: bytes) -> int:
        return (xxhash.xxh3_64_intdigest(chunk) >> (64 - bits)) - (1 << 63 if bits == 64 else 0)

    return of


def _recipes(bits: int):
    """Per row: its list of chunk hashes and the SHA-256 of the normalised text."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        gear, of = _gear(), _hashed(bits)
        for batch in batches:
            for part in slices(batch):
                texts = [normalised(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                recipes = [[of(c) for c in chunks] for chunks in chunks_of(texts, gear)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row_id"),
                        part.column("doc_id"),
                        part.column("key"),
                        pa.array(recipes, pa.list_(pa.int64())),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    ],
                    ["row_id", "doc_id", "key", "recipe", "text_sha256"],
                )

    return run


def _contents(bits: int, places: bool):
    """Chunks with their contents: distinct within a slice, or with row and place."""

    def run(batches):
        import pyarrow as pa

        gear, of = _gear(), _hashed(bits)
        for batch in batches:
            for part in slices(batch):
                texts = [normalised(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                cut = chunks_of(texts, gear)
                if places:
                    rows = [(of(c), c, i, k) for i, chunks in zip(part.column("row_id").to_pylist(), cut) for k, c in enumerate(chunks)]
                else:
                    rows = list({(of(c), c): None for chunks in cut for c in chunks})
                kinds = [("hash", pa.int64()), ("content", pa.binary()), ("row_id", pa.int64()), ("place", pa.int64())][: 4 if places else 2]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], [n for n, _ in kinds])

    return run


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, hash_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, key`` for each row.

    Texts are equal when identical after each run of ASCII white space became one
    space; null counts as empty, and empty texts equal each other. Of equal texts the
    row with the smallest ``doc_id`` stays, null ids last; of rows that repeat a
    ``doc_id`` as well, exactly one is kept. ``key`` is any 64-bit column to return with
    its row. ``hash_bits`` is less than 64 only in tests of collisions. An empty table
    gives an empty result.
    """
    with working(docs.sparkSession):
        return kept(_groups(docs, id_col, text_col, F.lit(0).cast("long") if key is None else key, hash_bits), "exact-groups")


def _groups(docs: DataFrame, id_col: str, text_col: str, key: Column, hash_bits: int) -> DataFrame:
    source = keyed(docs, id_col, text_col, key=key, row_id=F.monotonically_increasing_id())
    id_type = source.schema["doc_id"].dataType.simpleString()
    recipes = written(
        source.mapInArrow(_recipes(hash_bits), f"row_id long, doc_id {id_type}, key long, recipe array<long>, text_sha256 string"), "recipes"
    )
    contents = source.select("text").mapInArrow(_contents(hash_bits, False), "hash long, content binary")
    collided = written(
        contents.groupBy("hash")
        .agg(F.min("content").alias("low"), F.max("content").alias("high"))
        .filter("low != high")
        .select("hash"),
        "collisions",
    )
    same = ["recipe"]
    if not collided.isEmpty():
        source = written(source, "rows")  # the numbers given above hold for the rows written then
        recipes = written(source.mapInArrow(_recipes(hash_bits), recipes.schema), "recipes")
        numbered = (
            contents.join(collided, "hash", "left_semi")
            .distinct()
            .withColumn("number", F.row_number().over(W.partitionBy("hash").orderBy("content")))
        )
        placed = source.select("row_id", "text").mapInArrow(_contents(hash_bits, True), "hash long, content binary, row_id long, place long")
        numbers = (
            placed.join(collided, "hash", "left_semi")
            .join(numbered, ["hash", "content"])
            .groupBy("row_id")
            .agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("numbers"))
        )
        none = F.array().cast("array<struct<place:long,number:int>>")
        recipes = written(recipes.join(numbers, "row_id", "left").withColumn("numbers", F.coalesce("numbers", none)), "verified-recipes")
        same.append("numbers")
    groups = recipes.groupBy(*same).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("size")
    )
    joined = join_keyed(recipes, written(groups.filter("size > 1"), "copies"), same, "size", "left")
    alone = F.col("size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep.row_id") == F.col("row_id"))).alias("kept"),
        "text_sha256",
        "key",
    )
