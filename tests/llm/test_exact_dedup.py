import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import awkward, docs, rows_of, words

from tidegate.llm import common
from tidegate.llm import exact_dedup as E
from tidegate.llm.words import normalised


def model(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), n in zip(rows, norm):
        groups[n].append(i)
    least = {n: min(ids, key=lambda i: (i is None, i or 0)) for n, ids in groups.items()}
    return Counter((i, least[n], len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm))


@pytest.mark.parametrize("bits", [64, 3])
def test_groups(spark, bits):
    draw = random.Random(bits)
    rows = awkward()
    for i in range(120):
        rows.append((100 + i, draw.choice(["", " "]) + draw.choice([" ", "\n", "  "]).join(words(draw, draw.choice([1, 1, 2, 3000])))))
        rows.append((draw.randint(0, 400), (draw.choice(rows)[1] or "").replace(" ", " \t")))
    found = E.exact_groups(docs(spark, rows), hash_bits=bits).cache()
    assert rows_of(found.select("doc_id", "keep_id", "group_size", "text_sha256")) == model(rows)
    kept = found.filter("kept").select("text_sha256").collect()
    assert len(kept) == len(set(kept)) == found.select("text_sha256").distinct().count()
    assert found.filter("kept AND NOT doc_id <=> keep_id").isEmpty()


def test_a_text_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    rows = [(i, " " * (i % 3)) for i in range(30)] + [(i, f"text {i % 50}") for i in range(30, 100)] + [(None, "text 1")]
    assert rows_of(E.exact_groups(docs(spark, rows)).select("doc_id", "keep_id", "group_size", "text_sha256")) == model(rows)


def test_empty_table(spark):
    found = E.exact_groups(docs(spark, []))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "key"] and found.count() == 0


def test_cuts_follow_content():
    draw = random.Random(4)
    tail = " ".join(words(draw, 20_000)).encode()
    gear = E._gear()
    a, b = E.chunks_of([tail, b"a few words before " + tail], gear)
    assert b"".join(a) == tail and len(a) > 10
    assert a[1:] == b[-len(a) + 1 :]
    assert max(map(len, E.chunks_of([b"x" * 300_000], gear)[0])) <= E.LONGEST


def test_normalised():
    draw = random.Random(1)
    for _ in range(500):
        text = "".join(draw.choice(" \t\n\x0b\x0c\rab\x1c\x85é") for _ in range(draw.randint(0, 9))).encode()
        assert normalised(text) == re.sub(rb"[\x20\x09-\x0D]+", b" ", text)
