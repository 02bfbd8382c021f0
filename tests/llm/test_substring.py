import hashlib
import random
from collections import Counter

import pytest
from helpers import awkward, docs, rows_of, words

from tidegate.llm import common
from tidegate.llm import substring as S


def model(rows, window):
    owner = {}
    split = [((i if i is not None else S.LAST), (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            owner[run] = min(owner.get(run, S.LAST), i)
    out = Counter()
    for (i, w), (doc, _) in zip(split, rows):
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if owner[tuple(w[k : k + window])] < i:
                keep[k : k + window] = [False] * window
        kept = b" ".join(x for x, y in zip(w, keep) if y)
        out[doc, len(w), keep.count(False), hashlib.sha256(kept).hexdigest()] += 1
    return out


def some_rows(seed):
    draw = random.Random(seed)
    passages = [words(draw, 40) for _ in range(4)]
    rows = awkward() + [(None, "a " * 40), (None, "a " * 30), (90, "a " * 500)]
    for _ in range(200):
        kind = draw.random()
        if kind < 0.3:
            text = " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 60)))
        elif kind < 0.7:
            text = " ".join(words(draw, draw.randint(0, 50))) + "\n" + " ".join(draw.choice(passages)) + "\t " + " ".join(words(draw, draw.randint(0, 50)))
        else:
            text = " ".join(draw.choice(passages)) + "  " + "a b " * draw.randint(0, 60)
        rows.append((draw.randint(0, 250), text))
    return rows


@pytest.mark.parametrize(("window", "crowd", "filtered", "broadcast", "hot"), [(13, 1 << 17, 1 << 24, 1 << 20, 1 << 17), (13, 50, 0, 0, 3), (9, 1 << 17, 1 << 24, 0, 3)])
def test_removed_words(spark, monkeypatch, window, crowd, filtered, broadcast, hot):
    monkeypatch.setattr(S, "ANCHOR_WORDS_MOST", crowd)
    monkeypatch.setattr(S, "HOT_ROWS", hot)
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    monkeypatch.setattr(S, "FILTER_ANCHORS", filtered)
    monkeypatch.setattr(S, "BROADCAST_BYTES", broadcast)
    rows = some_rows(window)
    assert rows_of(S.remove_repeats(docs(spark, rows), window)) == model(rows, window)


def test_kept_text_has_its_own_white_space(spark):
    run = " ".join(f"p{i}" for i in range(15))
    rows = [(1, f"x {run}"), (2, f"a\n\tb  {run}\n\nc  d"), (3, "  as it  is ")]
    found = {r.doc_id: r.kept_text for r in S.remove_repeats(docs(spark, rows), with_text=True, carry=("order", "kept")).collect()}
    assert found == {1: f"x {run}", 2: "a\n\tb  c  d", 3: "  as it  is "}


def test_rows_that_agree_in_id_and_text(spark):
    """Thousands of copies under one id, and a third of all rows one text."""
    text = " ".join(words(random.Random(1), 80))
    rows = [(5, text)] * 2000 + [(None, text)] * 500 + [(i, f"{text} x{i}") for i in range(6, 60)] + [(1, text[100:])]
    assert rows_of(S.remove_repeats(docs(spark, rows))) == model(rows, 13)


def test_empty_table(spark):
    assert S.remove_repeats(docs(spark, [])).count() == 0


def test_automaton_knows_least_owners():
    draw = random.Random(2)
    for _ in range(60):
        texts = [([draw.choice("ab") for _ in range(draw.randint(1, 14))], draw.randint(0, 9)) for _ in range(5)]
        automaton = S.Automaton()
        for w, owner in texts:
            automaton.add(w, owner)
        automaton.settle()
        probe = [draw.choice("abc") for _ in range(20)]
        for window in (1, 3, 5):
            want = []
            for k in range(len(probe) - window + 1):
                run = probe[k : k + window]
                want.append(min((o for w, o in texts for j in range(len(w)) if w[j : j + window] == run), default=S.LAST))
            assert automaton.least_owners(probe, window) == want


def pairs_of_documents(seed):
    """Each passage is in two documents, with other words around it."""
    draw = random.Random(seed)
    rows = []
    for i in range(0, 400, 2):
        passage = words(draw, 40)
        rows += [(j, " ".join([*words(draw, 60), *passage, *words(draw, 60)])) for j in (i, i + 1)]
    return rows


def test_no_list_of_anchors_is_looked_up(spark, monkeypatch):
    """A table with a row per anchor grows with the documents, and the driver would hold it."""
    held = []
    lookup = S.lookup
    monkeypatch.setattr(S, "lookup", lambda df: held.append(df.count()) or lookup(df))
    rows = pairs_of_documents(4)
    assert rows_of(S.remove_repeats(docs(spark, rows))) == model(rows, 13)
    assert sum(held) == 0


@pytest.mark.parametrize("filtered", [1 << 24, 0])
def test_few_segments_pass_whose_anchor_is_not_shared(spark, monkeypatch, filtered):
    monkeypatch.setattr(S, "FILTER_ANCHORS", filtered)
    held, kept = {}, S.written

    def written(df, label):
        out = held[label] = kept(df, label)
        if label == "segments":
            held["passed"], held["shared"] = out.count(), out.join(held["anchors"], "anchor", "left_semi").count()
        return out

    monkeypatch.setattr(S, "written", written)
    rows = pairs_of_documents(5)
    assert rows_of(S.remove_repeats(docs(spark, rows))) == model(rows, 13)
    assert 0 < held["shared"] <= held["passed"] <= 1.05 * held["shared"]


def test_filter_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(S, "FILTER_BITS_MOST", 16)
    rows = pairs_of_documents(6)
    shared = spark.range(1 << 14).selectExpr("xxhash64(id) AS anchor")
    table, bits = S._bit_filter(shared, 1 << 14)
    assert bits == 16 and len(table) == 1 << 13
    assert rows_of(S.remove_repeats(docs(spark, rows))) == model(rows, 13)


@pytest.mark.parametrize("crowd", [1 << 17, 50])
def test_anchors_of_many_occurrences(spark, monkeypatch, crowd):
    """They are folded by segment, so that no task has all occurrences of one."""
    monkeypatch.setattr(S, "ANCHOR_ROWS_MOST", 3)
    monkeypatch.setattr(S, "ANCHOR_WORDS_MOST", crowd)
    held, kept = {}, S.written

    def written(df, label):
        out = held[label] = kept(df, label)
        if label == "references":
            held["hot"], held["folded"] = held["hot-anchors"].count(), held["hot-references"].count()
        return out

    monkeypatch.setattr(S, "written", written)
    rows = some_rows(8)
    assert rows_of(S.remove_repeats(docs(spark, rows))) == model(rows, 13)
    assert held["folded"] >= held["hot"] > 0
