"""Runs against a model that tries every period, and against appending word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import awkward, docs
from tidegate.llm.runs import Catchers, periodic_runs, runs_of


def model(words, exponent=4, least=6):
    """Every maximal stretch of every period, of which the smallest period counts."""
    found = {}
    n = len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, exponent * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, m, p) for (s, m), p in found.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@given(st.lists(st.sampled_from("abc"), max_size=80), st.integers(2, 5), st.integers(1, 8))
@settings(max_examples=400, deadline=None)
def test_short(words, exponent, least):
    assert runs_of(words, exponent, least) == model(words, exponent, least)


@given(st.data())
@settings(max_examples=150, deadline=None)
def test_planted(data):
    words = []
    for _ in range(data.draw(st.integers(1, 5))):
        unit = data.draw(st.lists(st.sampled_from("ab"), min_size=1, max_size=20))
        length = data.draw(st.integers(0, 6 * len(unit) + 3))
        words += (unit * 7)[:length] + data.draw(st.lists(st.sampled_from("abcd"), max_size=6))
    assert runs_of(words, 4, 6) == model(words) and runs_of(words, 2, 2) == model(words, 2, 2)


@pytest.mark.parametrize("words", [fibonacci(600), ["x"] * 700, list("ab") * 350, (list("aab") * 40 + list("aabaab")) * 5, list(range(500)) * 5])
def test_regular(words):
    for exponent in (2, 3, 4):
        assert runs_of(words, exponent, 6) == model(words, exponent, 6)


def test_word_by_word():
    draw = random.Random(5)
    for _ in range(20):
        words = []
        while len(words) < 400:
            unit = [draw.randrange(1, 4) for _ in range(draw.randrange(1, 40))]
            words += unit * draw.choice((1, 1, 4, 7))
        codes = np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        whole, pieces = Catchers(len(words) // 2), Catchers(len(words) // 2)
        whole.append(codes)
        at = 0
        while at < len(codes):
            step = draw.choice((1, 1, 1, 7, 64))
            pieces.append(codes[at : at + step])
            at += step
        a, b = whole.runs(2, 2), pieces.runs(2, 2)
        assert all((x == y).all() for x, y in zip(a, b))
        assert list(zip(*(x.tolist() for x in a))) == model(words, 2, 2)


def answer(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = model(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{p}\n" for s, m, p in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_operator(spark):
    draw = random.Random(9)
    rows = [r for r in awkward() if len(r[1] or "") < 20_000]
    for i in range(20, 220):
        unit = [draw.choice("abcdefgh") for _ in range(draw.randrange(1, 12))]
        words = [draw.choice("xyz") for _ in range(draw.randrange(30))] + unit * draw.randrange(7) + [draw.choice("xyz") for _ in range(draw.randrange(60))]
        rows.append((i, draw.choice((" ", "\n", " \t ")).join(words)))
    for plant in (True, False):
        found = periodic_runs(docs(spark, rows), plant=plant)
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(answer(*r, plant)) for r in rows)
    detailed = periodic_runs(docs(spark, rows[-40:]), detail=True).collect()
    assert all(hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 and len(r.runs) == r.n_runs for r in detailed)
    assert periodic_runs(docs(spark, [])).collect() == []


def test_very_long_text(spark):
    text = "start " + "a b c d e f g " * 30_000 + "end"
    (row,) = periodic_runs(docs(spark, [(1, text)])).collect()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 1, 210_000, 7)
