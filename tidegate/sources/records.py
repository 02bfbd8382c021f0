"""Records that go on over line ends, read by as many tasks as their file has splits.

A line end inside quotes does not end a record, so where a split's first record begins
depends on all text before it. Whether a line begins inside quotes is one bit; what a
split does to that bit is a function of it, which a task finds without knowing it:

1. Each split says, for either value of the bit, its value at the split's end, and where
   the last record and the first filled one begin. One row per split.
2. Running over the splits of a file, these functions give the bit at the beginning of
   each split, and the record that is open there.
3. Each split is read from its first true record start. A record that reaches over the
   end of a split is put together from its pieces, one per split.

Lines end with a line feed; a carriage return before it belongs to the line end. Only a
quote at the beginning of a field opens one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.session import lookup, settle

SPLIT_FACTS = "file string, block long, end_0 boolean, end_1 boolean, start_0 long, start_1 long, head_0 long, head_1 long"


def open_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted field goes on after a line that begins outside or inside of one."""
    if b'"' not in line:
        return inside
    at, begins = 0, not inside
    while True:
        if inside:
            at = line.find(b'"', at) + 1
            if not at:
                return True
            if line[at : at + 1] == b'"':
                at += 1
            else:
                inside = begins = False
        elif begins and line[at : at + 1] == b'"':
            inside, at = True, at + 1
        else:
            at = line.find(b",", at) + 1
            if not at:
                return False
            begins = True


def _splits(batches: Iterator[pa.RecordBatch], others: Sequence[str] = ()) -> Iterator[tuple]:
    """``(key, lines)`` per stretch of lines of one split in a batch; a split's lines come one after another."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("file", "block", "pos", "line", *others)))
        held, key = [], None
        for file, block, pos, line, *more in rows:
            if (file, block) != key:
                if held:
                    yield key, held
                held, key = [], (file, block)
            held.append((pos, line or b"", *more))
        if held:
            yield key, held


def _facts(batches):
    """The facts of each split, for either beginning."""
    found: dict[tuple, list] = {}
    for key, lines in _splits(batches):
        # per beginning: open now, last record start, first filled record start
        sides = found.setdefault(key, [[False, None, None], [True, None, None]])
        for pos, line in lines:
            filled = bool(line.strip())
            for side in sides:
                if not side[0]:
                    if filled:
                        side[1] = pos
                        if side[2] is None:
                            side[2] = pos
                if b'"' in line:
                    side[0] = open_after(line, side[0])
    rows = [(*key, a[0], b[0], a[1], b[1], a[2], b[2]) for key, (a, b) in found.items()]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 4]
    names = ["file", "block", "end_0", "end_1", "start_0", "start_1", "head_0", "head_1"]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def split_states(lines: DataFrame) -> DataFrame:
    """``file, block, inside, ends_open, carry, head`` for each split, settled.

    ``inside`` tells whether the split begins inside quotes, ``carry`` where the record
    that is open there began, ``head`` where the file's first filled record did.
    """
    facts = settle(lines.mapInArrow(_facts, SPLIT_FACTS))
    by_file = W.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(W.unboundedPreceding, -1)
    fixed, turned = F.col("end_0") == F.col("end_1"), (F.col("end_0") & ~F.col("end_1")).cast("long")
    # a split that ends alike whatever came before sets the bit, one that turns it adds to it
    turns = facts.withColumn("turns", F.sum(turned).over(by_file.rowsBetween(W.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct(F.col("end_0").cast("long").alias("bit"), "turns")), True).over(before)
    turns = turns.withColumn("last", last).withColumn("done", F.coalesce(F.last("turns").over(before), F.lit(0)))
    bit = F.coalesce(F.col("last.bit"), F.lit(0)) + F.col("done") - F.coalesce(F.col("last.turns"), F.lit(0))
    known = turns.withColumn("inside", bit % 2 == 1)
    chosen = {n: F.when(F.col("inside"), F.col(f"{n}_1")).otherwise(F.col(f"{n}_0")) for n in ("end", "start", "head")}
    known = known.select("file", "block", "inside", *[c.alias(n) for n, c in chosen.items()])
    return settle(
        known.select(
            "file", "block", "inside", F.col("end").alias("ends_open"), F.last("start", True).over(before).alias("carry"),
            F.min("head").over(W.partitionBy("file")).alias("head"),
        )
    )


def _records(whole: bool):
    """Whole records of splits, or the pieces of those that reach over a split's end: ``file, pos, piece, record``."""

    def run(batches):
        key, inside, at, held, starts_here = None, False, None, [], True
        last = None

        def batch_of(rows):
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["file", "pos", "piece", "record"])

        def piece(of):
            return (of[0], at, last, b"\n".join(held))

        for found, lines in _splits(batches, ("inside", "carry")):
            out = []
            if found != key:
                if held and not whole:
                    out.append(piece(key))
                key, inside, at, held = found, lines[0][2], lines[0][3], []
                starts_here, last = not inside, lines[0][0]
            for pos, line, _, _ in lines:
                if not inside and not held:
                    if not line.strip():
                        continue
                    at, last, starts_here = pos, pos, True
                held.append(line)
                inside = open_after(line, inside)
                if not inside:
                    if starts_here == whole:
                        out.append(piece(key))
                    held, starts_here = [], True
            if out:
                yield batch_of(out)
        if held and not whole:
            yield batch_of([piece(key)])

    return run


def read_lines(spark: SparkSession, paths: Sequence[str], file, pos) -> DataFrame:
    """``file, block, pos, line`` of all lines, as bytes; ``file`` and ``pos`` are columns of a file scan."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(file.alias("file"), F.col("_metadata.file_block_start").alias("block"), pos.alias("pos"), F.col("value").cast("binary").alias("line"))


def _placed(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with the states of their splits, each split's one after another in its order.

    A broadcast leaves lines as they are read; more splits than that are joined by
    shuffle, which promises no order.
    """
    side = lookup(states)
    joined = lines.join(side, ["file", "block"])
    return joined.sortWithinPartitions("file", "block", "pos") if side is states else joined


def read_records(lines: DataFrame) -> DataFrame:
    """``file, pos, record`` of every filled record but each file's first, its header.

    ``pos`` is where the record begins; a last record whose quote never closes reaches to
    the end of its file.
    """
    states = split_states(lines)
    known = states.select("file", "block", "inside", "carry", "ends_open", "head")
    schema = "file string, pos long, piece long, record binary"
    whole = _placed(lines, known).mapInArrow(_records(True), schema)
    out = whole.select("file", "pos", "record")
    torn = states.filter("inside OR ends_open").select("file", "block", "inside", "carry")
    if not torn.isEmpty():
        pieces = _placed(lines, torn).mapInArrow(_records(False), schema)
        parts = F.transform(F.array_sort(F.collect_list(F.struct("piece", "record"))), lambda p: p["record"].cast("string"))
        # as many pieces as the record has splits
        joined_up = pieces.groupBy("file", "pos").agg(F.array_join(parts, "\n").cast("binary").alias("record"))
        out = out.unionByName(joined_up)
    heads = states.groupBy("file").agg(F.min("head").alias("head"))
    out = out.join(lookup(heads), "file").filter("pos <> head").drop("head")
    text = F.col("record").cast("string")
    return out.select("file", "pos", F.when(text.endswith("\r"), F.expr("substr(cast(record as string), 1, length(cast(record as string)) - 1)")).otherwise(text).alias("record"))
