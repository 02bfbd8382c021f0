import random
import zlib

import numpy as np
import pytest
from helpers import awkward, docs, words

from tidegate.llm import labelled, quality, toxicity

INSULTS = ["vexling", "dolt", "clodpate"]


def corpus(n=2000, seed=3, both=lambda insult, group: insult and group):
    """Toxic by insult and group together; junk where words repeat or end in signs."""
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        tokens = words(draw, draw.randint(10, 80))
        insult, group = draw.random() < 0.4, draw.random() < 0.4
        if insult:
            tokens.insert(draw.randrange(len(tokens)), draw.choice(INSULTS))
        if group:
            tokens.insert(draw.randrange(len(tokens)), draw.choice(["northers", "southers"]))
        good = draw.random() < 0.7
        if not good:
            tokens = [t + draw.choice(["!!", "***"]) for t in tokens] if draw.random() < 0.5 else [t for t in tokens[:8] for _ in range(9)]
        rows.append((i, " ".join(tokens)))
        labels.append((i, int(good), int(both(insult, group))))
    return rows, labels


def held_out(i, parts, part):
    return zlib.crc32(str(i).encode()) % parts == part


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize(("score", "column", "parts", "part", "least"), [(toxicity.score_toxicity, 2, 5, 0, 0.95), (quality.score_quality, 1, 3, 1, 0.97)])
def test_held_out_accuracy(tables, score, column, parts, part, least):
    documents, labels, rows = tables
    found = {r.doc_id: r for r in score(documents, labels).collect()}
    assert len(found) == len(rows)
    assert all(r.held_out == held_out(i, parts, part) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in found.items())
    right = [found[r[0]].predicted == r[column] for r in rows if found[r[0]].held_out]
    assert np.mean(right) >= least


def test_pairs_beat_weights(spark):
    """Weights alone cannot say that two terms together mean the opposite of each alone."""
    rows, labels = corpus(both=lambda insult, group: insult != group)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = labelled.sample(docs(spark, rows), labels, "toxic", ~labelled.fold("doc_id", 5, 0), toxicity._terms, toxicity.BITS, 3, 5.0)

    def misses(machine):
        owner = np.repeat(np.arange(len(found.y)), np.diff(found.ends))
        return ((machine.sums(owner, found.columns, len(found.y)) >= 0) != found.y).sum()

    assert misses(toxicity.fit(found)) < 0.5 * misses(toxicity.fit(found, factors=0))


def test_terms_that_tell_only_in_pairs(spark):
    """By the operator as it is: no insult gains enough alone."""
    rows, labels = corpus(both=lambda insult, group: insult != group)
    scores = toxicity.score_toxicity(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    toxic = {i: y for i, _, y in labels}
    assert np.mean([r.predicted == toxic[r.doc_id] for r in scores if r.held_out]) >= 0.9


@pytest.mark.parametrize("shares", [1, 3])
def test_paired_features_of_all_pairs(shares):
    draw = np.random.default_rng(5)
    has = draw.random((300, 25)) < draw.random(25)
    y = (has[:, 3] ^ has[:, 7]) & (draw.random(300) < 0.9)
    ends, columns = np.cumsum([0, *has.sum(axis=1)]), np.nonzero(has)[1]
    gain = lambda x: labelled._gains(np.array([(x & y).sum()]), np.array([x.sum()]), y.sum(), 300)[0]
    want = set()
    for a in range(25):
        for b in range(a):
            if gain(has[:, a] & has[:, b]) - max(gain(has[:, a]), gain(has[:, b])) >= 4.0:
                want |= {a, b}
    counts = (has & y[:, None]).sum(axis=0), has.sum(axis=0)
    with_1, with_any = (has & y[:, None]).sum(axis=0), has.sum(axis=0)
    order = np.lexsort((np.arange(25), with_any))
    ranks = np.nonzero(has[:, order])[1]
    found = [labelled.paired(y.astype(np.int32), ends, ranks, with_1[order], with_any[order], 4.0, share, shares) for share in range(shares)]
    assert want and set(order[np.concatenate([place for place, _ in found])].tolist()) == want
    best = {order[p]: m for place, more in found for p, m in zip(place, more)}
    assert min(best.values()) >= 4.0


def test_sums_are_those_over_all_pairs():
    draw = np.random.default_rng(2)
    machine = toxicity.Machine(0.3, draw.normal(size=30), draw.normal(size=(30, 4)))
    texts = [sorted(draw.choice(30, draw.integers(0, 9), replace=False).tolist()) for _ in range(50)]
    owner, column = np.repeat(np.arange(50), [len(t) for t in texts]), np.array([c for t in texts for c in t], int)
    naive = [
        machine.bias + sum(machine.weights[c] for c in t) + sum(machine.factors[a] @ machine.factors[b] for i, a in enumerate(t) for b in t[:i]) for t in texts
    ]
    assert np.allclose(machine.sums(owner, column, 50), naive)


def test_updates_follow_the_regularised_leader():
    """One coordinate after another, by the formula written out."""
    draw = np.random.default_rng(3)
    leader = quality.Leader(6, rate=0.4, l1=0.3, l2=0.01)
    z, n = [0.0] * 7, [0.0] * 7
    for _ in range(60):
        at = np.append(np.sort(draw.choice(6, draw.integers(1, 6), replace=False)), 6)
        x, y = np.append(draw.random(len(at) - 1) * 3, 1.0), float(draw.integers(0, 2))
        w = {}
        for i in at.tolist():
            l1 = 0.0 if i == 6 else 0.3
            w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((1.0 + np.sqrt(n[i])) / 0.4 + 0.01)
        assert np.allclose(leader.weights(at), [w[i] for i in at.tolist()])
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(at.tolist(), x))))
        for i, v in zip(at.tolist(), x):
            g = (p - y) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / 0.4
            z[i] += g - sigma * w[i]
            n[i] += g * g
        leader.learn(at, x, y)


def test_the_sample_stays_at_its_bound(spark):
    """However often ids, and whole rows, repeat; by rows and by bytes."""
    rows = [(i % 20, f"word{i % 7} and word{i % 400}") for i in range(4000)] + [(3, "one row that repeats")] * 500
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    every = labelled.fold("doc_id", 1, 0)
    for rows_most, bytes_most, least in ((20, 1 << 20, 20), (300, 1000, 40), (5, 1, 1)):
        found = labelled.sample(docs(spark, rows), labels, "quality", every, quality._ngrams, quality.BITS, 1, 0.0, rows=rows_most, size=bytes_most)
        assert least <= len(found.y) <= rows_most


def test_no_more_features_than_asked_for(spark):
    rows, labels = corpus(600, both=lambda insult, group: insult != group)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = labelled.sample(docs(spark, rows), labels, "toxic", labelled.fold("doc_id", 1, 0), toxicity._terms, toxicity.BITS, 3, 2.0, most_features=10, least_pair_gain=4.0)
    assert 10 <= len(found.features) <= 20


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality.score_quality])
def test_awkward_rows(spark, tables, score):
    _, labels, _ = tables
    rows = awkward()
    found = score(docs(spark, rows + corpus(220)[0][20:]), labels).collect()
    assert len(found) == len(rows) + 200 and all(r.score is not None and r.held_out is not None for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
    assert score(docs(spark, []), labels).count() == 0


@pytest.mark.parametrize(("label", "want"), [(None, 0.0), (0, 0.0), (1, 1.0)])
@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality.score_quality])
def test_one_sided_labels(spark, score, label, want):
    labels = spark.createDataFrame([(i, label, label) for i in range(20)] + [(None, 1 - (label or 0), 1 - (label or 0))], "doc_id long, quality int, toxic int")
    found = score(docs(spark, [(i, "some text") for i in range(20)]), labels).collect()
    assert {r.score for r in found} == {want} and {r.predicted for r in found} == {int(want)}


def test_only_the_sample_is_learned_from(tables):
    documents, labels, _ = tables
    found = labelled.sample(documents, labels, "quality", ~labelled.fold("doc_id", 3, 1), quality._ngrams, quality.BITS, 5, 8.0, rows=50)
    assert len(found.y) == 50 and len(found.ends) == 51 and found.ends[-1] == len(found.columns) == len(found.values)


def test_thousands_of_features_are_kept(spark):
    """Each of 6,000 words belongs to one label."""
    draw = random.Random(6)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{draw.randrange(3000)}" for _ in range(300))) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    every = labelled.fold("doc_id", 1, 0)
    found = labelled.sample(docs(spark, rows), labels, "quality", every, quality._ngrams, quality.BITS, quality.LEAST_DOCS, quality.LEAST_GAIN)
    assert len(found.features) > 5500
