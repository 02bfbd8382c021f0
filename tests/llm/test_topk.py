import math
import random
from collections import Counter

import pytest
from helpers import rows_of

from tidegate.llm import topk as K


def model(rows, k):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, v in sound:
        if q % 5 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in sound if i != q)[:k]
            out.update((q, rank, i, -score) for rank, (score, i) in enumerate(best, 1))
    return out


@pytest.mark.parametrize(("n", "d", "vectors", "queries", "broadcast"), [(3, 1, 2048, 512, 1 << 20), (300, 7, 7, 4, 0), (300, 3, 11, 512, 1 << 20), (200, 40, 50, 9, 0)])
def test_search(spark, monkeypatch, n, d, vectors, queries, broadcast):
    monkeypatch.setattr(K, "VECTOR_BLOCK", vectors)
    monkeypatch.setattr(K, "QUERY_BLOCK", queries)
    monkeypatch.setattr(K, "BROADCAST_BYTES", broadcast)
    draw = random.Random(n + d)

    def vector():
        if draw.random() < 0.05:
            return draw.choice([None, [None] * d, [float("nan")] * d, [float("inf")] * d, []])
        return [draw.choice([draw.gauss(0, 1), 0.5]) for _ in range(draw.choice([d, d, d, max(1, d - 1)]))]

    frame = spark.createDataFrame([(draw.choice([i, i, i, i // 2, None]), vector()) for i in range(n)], "vec_id long, embedding array<float>")
    frame = frame.selectExpr("*", "1 AS id", "'q' AS query_block", "2.0 AS score", "3 AS uid")
    found = K.search(frame, frame.filter("vec_id % 5 = 0"), 5)
    assert rows_of(found) == model([(r.vec_id, r.embedding) for r in frame.collect()], 5)


def test_large_components_are_exact(spark):
    rows = [(i, [1.0e7 + i, 3.0 - i]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(K.search(frame, frame.filter("vec_id % 5 = 0"), 5)) == model(rows, 5)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    some = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert K.search(none, none, 5).count() == K.search(some, none, 5).count() == K.search(some, some, 5).count() == 0
