import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, docs, rows_of, words
from tokenizers import Tokenizer

from tidegate.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = ["a", "b", "é", "ing", "the", "!", "!!", "''", "'s", "1", "23", " ", "  ", "\n", bpe.SPECIAL, "ß", "中", "​", "'", "😀", "ll", "x"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS)


def ids_of(reference, text):
    return reference.encode(text or "", add_special_tokens=False).ids


def test_tree_concatenation_is_exact(reference, codec):
    draw = random.Random(3)
    for _ in range(1500):
        some = draw.sample(PIECES, draw.randint(1, len(PIECES)))
        text = "".join(draw.choice(some) for _ in range(draw.choice([5, 40, 200])))
        parts = bpe.halves(text, draw.choice([3, 8, 20]))
        assert "".join(p for p, _ in parts) == text
        ids = bpe.tree([codec.encode(p) for p, _ in parts], [c for _, c in parts], codec)
        assert ids.tolist() == ids_of(reference, text)
        assert codec.raw(ids).decode() == text


@pytest.mark.parametrize("limit", [bpe.LONG_CHARS, 50])
def test_encode_and_decode(spark, reference, limit):
    draw = random.Random(limit)
    rows = awkward() + [(50 + i, "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 400)))) for i in range(60)]
    found = rows_of(bpe.digests(bpe.decode(bpe.encode(docs(spark, rows), RANKS, long_chars=limit), RANKS)))
    want = Counter()
    for i, text in rows:
        ids = ids_of(reference, text)
        decoded = reference.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert found == want


def test_decode_bytes_that_are_no_text(spark, reference):
    ids = [[0, 250, 100], [230], [], None, [50256, 13]]
    found = bpe.decode(spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "doc_id long, ids array<int>"), RANKS).collect()
    assert {r.doc_id: r.text for r in found} == {i: reference.decode(x or [], skip_special_tokens=False) for i, x in enumerate(ids)}


def test_empty_tables(spark):
    assert bpe.decode(bpe.encode(docs(spark, []), RANKS), RANKS).count() == 0
    assert packing.pack_documents(docs(spark, []), RANKS).count() == 0


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= capacity
    return len(held)


def test_packed_documents(spark, reference):
    draw = random.Random(8)
    rows = awkward() + [(100 + i, " ".join(words(draw, draw.choice([3, 50, 300, 900])))) for i in range(150)]
    capacity = 256
    found = packing.pack_documents(docs(spark, rows), RANKS, capacity=capacity, keep_ids=True).collect()
    sequences = check_sequences(found, capacity)
    total = sum(r.length for r in found)
    assert sequences <= 1.03 * -(-total // capacity) + 1
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    want = Counter()
    for i, text in rows:
        ids = [*ids_of(reference, text), 2]
        first = len(ids) % capacity or min(capacity, len(ids))
        for k, end in enumerate(range(first, len(ids) + 1, capacity)):
            start = 0 if k == 0 else end - capacity
            want[i, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want


@pytest.mark.parametrize("lengths", [[600] * 500, [1] * 3000, [1023] * 40 + [1] * 40, list(range(1, 1024))])
def test_rounds_over_small_partitions(spark, lengths):
    pieces = spark.createDataFrame(list(enumerate(lengths)), "piece_id long, length int")
    placed = packing.pack(pieces, 1024, partition_items=64).join(pieces, "piece_id").collect()
    assert sorted(r.piece_id for r in placed) == list(range(len(lengths)))
    fewest = len(lengths) if min(lengths) > 512 else -(-sum(lengths) // 1024)
    assert check_sequences(placed, 1024) <= 1.05 * fewest + 1


def test_best_fit_takes_the_tightest_bin():
    bins = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert sorted(sorted(b) for b in bins) == [[0, 2], [1, 3, 4]]
