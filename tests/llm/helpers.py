"""Small tables and plain models that the operators are compared with."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

WORDS = [f"w{i}" for i in range(400)]


def words(draw: random.Random, n: int) -> list[str]:
    return [draw.choice(WORDS) for _ in range(n)]


def docs(spark, rows):
    """Documents with further columns whose names clash with those the operators use inside."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("doc_id", "text", "'x' AS `order`", "1 AS row_id", "'k' AS `key`", "0.5 AS score", "2 AS kept", "'s' AS spans", "1 AS Place")


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties and rows that repeat."""
    long = " ".join(f"t{i % 977}" for i in range(20_000))
    return [
        (None, None), (None, ""), (None, "some text of null ids"), (None, "some text of null ids"),
        (1, None), (2, ""), (3, " "), (4, "\t\n "), (5, "a  b"), (6, "a\tb"), (6, "a\tb"), (6, "other text"),
        (7, " a b"), (8, "a b "), (9, long), (10, long + " end"), (11, long), (12, "é中😀 <|endoftext|> x"),
        (13, "unsplit" * 4000), (14, "x"), (14, "x"),
    ]


def classes(n: int, linked) -> dict[int, list[int]]:
    """Members of each class of ``range(n)`` under the links."""
    above = list(range(n))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for a, b in linked:
        above[root(a)] = root(b)
    out = defaultdict(list)
    for i in range(n):
        out[root(i)].append(i)
    return out


def rows_of(frame) -> Counter:
    return Counter(map(tuple, frame.collect()))
