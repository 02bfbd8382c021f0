from collections import Counter, defaultdict

import numpy as np
import zlib
from helpers import awkward, docs

from tidegate.llm import sharding as S


def jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_follows_its_definition():
    keys = np.random.default_rng(1).integers(0, 2**64 - 1, 2000, dtype=np.uint64)
    for shards in (1, 2, 24, 25, 1000):
        assert S.jump(keys, shards).tolist() == [jump(int(k), shards) for k in keys]


def test_growth_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(2).integers(0, 2**64 - 1, 50_000, dtype=np.uint64)
    small, grown = S.jump(keys, 24), S.jump(keys, 25)
    moved = small != grown
    assert (grown[moved] == 24).all() and abs(moved.mean() - 1 / 25) < 0.005
    assert max(Counter(small.tolist()).values()) < 1.1 * 50_000 / 24


def check(rows, found):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, of = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        of[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())


def test_documents(spark):
    rows = awkward() + [(i, f"text {i}") for i in range(500)] + [(77, "hot")] * 400
    check(rows, S.shard_documents(docs(spark, rows)).collect())


def test_slots_are_in_one_order_however_rows_come(spark):
    """Small blocks, nulls, and rows that agree often enough to be dealt at random."""
    order = ["doc_id", "size"]
    rows = [(i, i % 7, i % 3) for i in range(900)] + [(None, None, 1)] * 3 + [(5, 5, 2)] * 400 + [(6, 6, 2)] * 300
    found = []
    for seed in (1, 2):
        np.random.default_rng(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, size long, shard int").repartition(5)
        found.append(Counter(map(tuple, S.place(df, "shard", order, block_rows=25).select("doc_id", "size", "shard", "slot").collect())))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    for shard in range(3):
        assert sorted(r[3] for r in found[0] if r[2] == shard) == list(range(sum(r[2] == shard for r in rows)))
    crowd = [{r[3] for r in found[0] if r[:2] == (k, k) and r[2] == 2} for k in (5, 6)]
    assert all(max(s) - min(s) + 1 == len(s) for s in crowd) and max(map(max, crowd)) + 1 == sum(r[2] == 2 for r in rows)


def test_empty_table(spark):
    assert S.shard_documents(docs(spark, [])).count() == 0
