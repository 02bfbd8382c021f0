import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, classes, docs, rows_of, words

from tidegate.llm import common
from tidegate.llm import near_dedup as N
from tidegate.llm.words import Words


def weighed(text):
    """Weights of a text's shingles."""
    w = (text or "").split()
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return {g: 1 + math.log2(n) / N.DOUBLINGS for g, n in count.items()}


def probability_jaccard(x, y):
    both = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in both) for i in x if i in y)


def edited(draw, tokens, edits):
    out = list(tokens)
    for _ in range(edits):
        out[draw.randrange(len(out))] = draw.choice(words(draw, 1))
    return out


@pytest.mark.parametrize("doublings", [N.DOUBLINGS, 0.5])
def test_registers_estimate_probability_jaccard(monkeypatch, doublings):
    monkeypatch.setattr(N, "DOUBLINGS", doublings)
    draw = random.Random(4)
    texts = []
    for _ in range(50):
        base = words(draw, draw.choice([6, 30, 120, 300]))
        if draw.random() < 0.4:
            base = base + base[:10] * draw.randint(1, 20)
        texts += [" ".join(base), " ".join(edited(draw, base, draw.randint(0, len(base) // 25 + 1)))]
    owner, gram, weight = N.shingles(Words(), pa.array(texts))
    found = N.registers(owner, gram, weight, len(texts))
    off = []
    for i in range(0, len(texts), 2):
        off.append((found[i] == found[i + 1]).mean() - probability_jaccard(weighed(texts[i]), weighed(texts[i + 1])))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.05


def test_similarity_is_of_sets():
    assert N.similarity(np.array([1, 2, 3, 9]), np.array([2, 3, 4])) == 0.4
    assert N.similarity(np.array([], np.uint64), np.array([1])) == 0


def model(rows, threshold=0.8):
    split = [(t or "").split() for _, t in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in split]
    linked = []
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if split[i] == split[j] or (common and common >= threshold * (len(sets[i]) + len(sets[j]) - common)):
                linked.append((i, j))
    out = Counter()
    for members in classes(len(rows), linked).values():
        least = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        out.update((rows[i][0], least, len(members)) for i in members)
    return out


@pytest.mark.parametrize(("most", "hot"), [(N.BUCKET_MEMBERS, common.HOT_ROWS), (12, 3)])
def test_classes(spark, monkeypatch, most, hot):
    monkeypatch.setattr(N, "BUCKET_MEMBERS", most)
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    draw = random.Random(9)
    rows = awkward()
    hot = words(draw, 150)
    for i in range(200):
        kind = draw.random()
        if kind < 0.5:
            tokens = hot
        elif kind < 0.7:
            tokens = words(draw, draw.randint(3, 80))
        else:
            tokens = (draw.choice(rows[len(awkward()) :] or [(0, "a b c d e f g")])[1]).split()
        rows.append((draw.choice([100 + i, 100 + i // 2]), draw.choice([" ", "\n"]).join(edited(draw, tokens, draw.randint(0, 4)))))
    found = N.near_classes(docs(spark, rows)).cache()
    assert rows_of(found.select("doc_id", "class_id", "class_size")) == model(rows)
    by_class = found.groupBy("class_id", "class_size").agg({"kept": "count"}).count()
    kept = found.filter("kept").collect()
    assert len(kept) >= by_class and all(r.doc_id == r.class_id for r in kept)


def at_the_threshold(kind, times, pairs):
    """Pairs of texts with 800 shared shingles and 100 of their own, by hashes: ``(owner, gram, weight)``.

    ``kind`` says which shingles occur ``times`` times: none, each text's own, or another
    half of the shared ones in each text.
    """
    rng = np.random.default_rng(times + len(kind))
    heavy = 1 + math.log2(times) / N.DOUBLINGS
    owner, gram, weight = [], [], []
    for i in range(pairs):
        shared = rng.integers(1, 2**63, 800, dtype=np.uint64)
        for side in (0, 1):
            w = np.ones(900)
            if kind == "own":
                w[800:] = heavy
            elif kind == "halves":
                w[400 * side : 400 * side + 400] = heavy
            g = np.concatenate([shared, rng.integers(1, 2**63, 100, dtype=np.uint64)])
            order = np.argsort(g)
            owner.append(np.full(900, 2 * i + side))
            gram.append(g[order])
            weight.append(w[order])
    return np.concatenate(owner), np.concatenate(gram), np.concatenate(weight)


@pytest.mark.parametrize(("kind", "times"), [("none", 1), ("own", 100), ("own", 1000), ("halves", 100), ("halves", 1000)])
def test_links_of_texts_with_repeats_are_not_lost(monkeypatch, kind, times):
    """Every pair at a set similarity of 0.8 shares a bucket and passes the gate, by the module's own steps."""
    pairs = 1200
    monkeypatch.setattr(N, "shingles", lambda words, texts: at_the_threshold(kind, times, pairs))
    texts = pa.array([f"text {i}" for i in range(2 * pairs)])
    monkeypatch.setattr(N, "slices", lambda batch: [batch])
    number = pa.array(range(2 * pairs))
    (signed,) = N._signatures([pa.RecordBatch.from_arrays([number, number, number, texts], ["row_id", "doc_id", "key", "text"])])
    (packed,) = N._packed([pa.RecordBatch.from_arrays([texts], ["text"])])
    keys, table = signed.column("keys").to_pylist(), [np.frombuffer(r, "<u2") for r in packed.column("registers").to_pylist()]
    lost = 0
    for a, b in zip(range(0, 2 * pairs, 2), range(1, 2 * pairs, 2)):
        met = {(i % N.BANDS, k) for i, k in enumerate(keys[a]) if k is not None} & {(i % N.BANDS, k) for i, k in enumerate(keys[b]) if k is not None}
        lost += not met or (table[a] == table[b]).mean() < N.PROMISING
    assert lost <= 0.001 * pairs


def test_weighted_bands_come_second():
    """A text without repeats has its even signature only, one with repeats both, without those that agree."""
    plain, repeated = " ".join(f"a{i}" for i in range(300)), " ".join(f"a{i}" for i in range(300)) + " a0 a1 a2 a3 a4 a5" * 50
    batch = pa.RecordBatch.from_pydict({"row_id": [0, 1, 2], "doc_id": [0, 1, 2], "key": [0, 0, 0], "text": [plain, repeated, ""]})
    (signed,) = N._signatures([batch])
    first, second, none = signed.column("keys").to_pylist()
    assert len(first) == N.BANDS and len(second) == 2 * N.BANDS and none == []
    even, weighted = second[: N.BANDS], second[N.BANDS :]
    assert None not in even and any(k is None for k in weighted) and all(k is None or k != e for k, e in zip(weighted, even))


def test_empty_table(spark):
    assert N.near_classes(docs(spark, [])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.label for r in N.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
