"""Spans and labels against a plain Viterbi search, scripts, and texts of made-up languages."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from helpers import awkward
from tidegate.llm.language import Letters, identify, labels, lowered
from tidegate.llm.labelled import fold

SYLLABLES = {"aa": "ka lo mi pe".split(), "bb": "schu zen ber gau".split(), "cc": "жи шо ба ну".split(), "dd": "да во ле ки".split()}


def text(draw, lang, n):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randrange(2, 5))) for _ in range(n))


def corpus(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.selectExpr("*", "'x' AS language", "'y' AS mark", "1 AS bytes", "2 AS place", "true AS train", "0.1D AS score")


def test_labels_are_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.integers(0, 6, rng.integers(1, 6))
        k, switch = int(rng.integers(1, 4)), 1.5
        scores = -rng.integers(0, 12, (sizes.sum(), k)) / 4
        scores[rng.random(scores.shape) < 0.1] = -8.0
        first = np.concatenate([[0], np.cumsum(sizes)])
        found = labels(scores, first, switch)
        for a, b in zip(first, first[1:]):
            worth = lambda path: sum(scores[a + i, c] for i, c in enumerate(path)) - switch * sum(x != y for x, y in zip(path, path[1:]))  # noqa: B023, E731
            best = max((worth(p) for p in itertools.product(range(k), repeat=b - a)), default=0)
            assert abs(worth(found[a:b].tolist()) - best) < 1e-9


def test_scripts_narrow():
    """A word of a script that its language was not learned with never has its label."""
    scores = np.array([[0.0, -np.inf], [-8.0, 0.0], [-8.0, 0.0], [0.0, -np.inf]])
    assert labels(scores, np.array([0, 4]), 3.0).tolist() == [0, 1, 1, 0] and labels(scores, np.array([0, 4]), 9.0).tolist() == [0, 0, 0, 0]


def test_words():
    texts = ["Ab cd-ef 12x", "", "ÉtéЖук東京タワー", "…😀 7", "naïve éa"]
    data, offsets = lowered(pa.array(texts))
    starts, ends, first, _ = Letters().spans(data, offsets)
    found = [[bytes(data[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert found[0] == ["ab", "cd", "ef", "x"] and found[1] == [] and found[2] == ["été", "жук", "東京", "タワー"]
    assert found[3] == [] and found[4][0] == "naïve"


def test_held_out_and_spans(spark):
    draw = random.Random(4)
    rows = [(i, text(draw, lang, draw.randrange(4, 60)), lang) for i, lang in enumerate(draw.choices(list(SYLLABLES), k=600))]
    frame = corpus(spark, rows)
    found = identify(frame, detail=True)
    held = {r.doc_id for r in frame.filter(fold("doc_id", 4, 2)).collect()}
    right = 0
    for r in found.collect():
        assert r.held_out == (r.doc_id in held) and 0 <= r.score <= 1
        right += r.held_out and r.lang_pred == rows[r.doc_id][2]
        assert all(a["end"] <= b["start"] and a["lang"] != b["lang"] for a, b in zip(r.spans, r.spans[1:]))
    assert right >= 0.99 * len(held)
    # labels of held-out rows play no part
    other = frame.withColumn("lang", F.when(fold("doc_id", 4, 2), F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(identify(other, detail=True).collect()) == sorted(found.collect())
    # mixed texts come apart where they were joined
    left, right = text(draw, "aa", 30), text(draw, "bb", 20)
    mixed = corpus(spark, rows + [(601, left + ". " + right, None), (602, text(draw, "cc", 9) + " " + left, None)])
    (row, other) = identify(mixed, detail=True).filter("doc_id > 600").orderBy("doc_id").collect()
    assert [s["lang"] for s in row.spans] == ["aa", "bb"] and abs(row.spans[1]["start"] - len(left) - 2) <= 12
    assert [s["lang"] for s in other.spans] == ["cc", "aa"] and other.spans[1]["start"] == other.spans[0]["end"] + 1


def test_awkward_rows(spark):
    draw = random.Random(8)
    rows = [(100 + i, text(draw, "aa", 8), "aa") for i in range(40)] + [(200 + i, text(draw, "cc", 8), "cc") for i in range(40)]
    odd = [(i, t, lang) for (i, t), lang in zip(awkward(), itertools.cycle(["aa", None, "qq"]))] + [(300, "ქართული 𐐨", None), (301, "123 …", "aa")]
    found = identify(corpus(spark, rows + odd)).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    texts = {i: t for i, t, _ in odd}
    for i in (1, 2, 3, 4, 301):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert all((by_id[i].lang_pred != "und") == bool(re.search(r"[^\W\d_]", t or "")) for i, t in texts.items() if i is not None)
    assert identify(corpus(spark, [])).collect() == []
    nothing = identify(corpus(spark, [(1, "some words", None), (None, "more", "aa")])).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
