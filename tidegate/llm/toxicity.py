"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: words without case, and the beginnings of longer words,
hashed. The score adds to a bias the weight of each term and, for each pair of terms,
the inner product of their factors, so that a pair may weigh more or less than its two
terms do. The sum over pairs takes one pass: half of the squared sum less the sum of
squares, per factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.llm.common import flat
from tidegate.llm.labelled import SAMPLE_ROWS, Sample, fold, sample, scored
from tidegate.llm.words import Words, owners, term_table

BITS = 20
# Bytes of the beginnings that are terms of their own.
BEGINNINGS = (4, 6)
LEAST_DOCS = 3
# G² of a term against the label from which it counts; or of a pair of terms, beyond that
# of the better of the two, for terms that tell little or nothing alone.
LEAST_GAIN = 15.0
LEAST_PAIR_GAIN = 20.0
FACTORS = 8


def _terms():
    import numpy as np

    words = Words(term_table(), fold_case=True)
    shift = np.uint64(64 - BITS)

    def run(texts):
        data, offsets = flat(texts)
        starts, ends, first = words.spans(data, offsets)
        owner = owners(first)
        hashed, of = [words.hashes(data, starts, ends)], [owner]
        for size in BEGINNINGS:
            longer = ends - starts > size
            hashed.append(words.hashes(data, starts[longer], starts[longer] + size) * np.uint64(2 * size + 1))
            of.append(owner[longer])
        feature = (np.concatenate(hashed) >> shift).astype(np.int64)
        return np.concatenate(of), feature, np.ones(len(feature))

    return run


class Machine:
    """Bias, weights and factors; presence of a term counts, not how often."""

    def __init__(self, bias: float, weights, factors):
        self.bias, self.weights, self.factors = bias, weights, factors

    def sums(self, owner, column, rows: int):
        import numpy as np

        factor = self.factors[column]
        out = self.bias + np.bincount(owner, weights=self.weights[column] - 0.5 * (factor**2).sum(axis=1), minlength=rows)
        for k in range(factor.shape[1]):
            out += 0.5 * np.bincount(owner, weights=factor[:, k], minlength=rows) ** 2
        return out


def fit(found: Sample, factors: int = FACTORS, rounds: int = 12, rate: float = 0.1, decay: float = 1e-4, batch: int = 256, seed: int = 1) -> Machine:
    """Adaptive gradient steps on the logistic loss, in small batches."""
    import numpy as np

    draw = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(len(found.features)), draw.normal(0, 0.01, (len(found.features), factors)))
    if found.one_sided:
        return machine
    seen_weights, seen_factors, seen_bias = np.full(len(found.features), 0.01), np.full((len(found.features), factors), 0.01), 1.0
    for _ in range(rounds):
        order = draw.permutation(len(found.y))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = found.ends[rows + 1] - found.ends[rows]
            owner = np.repeat(np.arange(len(rows)), sizes)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            column = found.columns[np.repeat(found.ends[rows], sizes) + inside]
            sums = machine.sums(owner, column, len(rows))
            error = 1 / (1 + np.exp(-np.clip(sums, -40, 40))) - found.y[rows]
            weight = error[owner] * (16.0 / len(rows))
            used, where = np.unique(column, return_inverse=True)
            factor = machine.factors[column]
            slope = np.bincount(where, weights=weight, minlength=len(used)) + decay * machine.weights[used]
            seen_weights[used] += slope**2
            machine.weights[used] -= rate * slope / np.sqrt(seen_weights[used])
            for k in range(factors):
                others = np.bincount(owner, weights=factor[:, k], minlength=len(rows))[owner] - factor[:, k]
                slope = np.bincount(where, weights=weight * others, minlength=len(used)) + decay * machine.factors[used, k]
                seen_factors[used, k] += slope**2
                machine.factors[used, k] -= rate * slope / np.sqrt(seen_factors[used, k])
            slope = 16.0 * error.mean()
            seen_bias += slope**2
            machine.bias -= rate * slope / np.sqrt(seen_bias)
    return machine


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 5, part: int = 0, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    ``score`` (0 to 1) is the chance that the text's label is 1, by a machine fitted on at
    most ``sample_rows`` labelled rows outside the held-out part; only the text decides.
    Null counts as empty, and an empty text gets the score of the bias. Rows that repeat
    are scored each. Where the sample holds no label 1 (or no rows) every score is 0, and
    1 where it holds nothing else. An empty table gives an empty result. ``carry`` names
    further columns of ``docs`` to return.
    """
    found = sample(docs, labels, label, ~fold("doc_id", parts, part), _terms, BITS, LEAST_DOCS, LEAST_GAIN, sample_rows, id_col, text_col, least_pair_gain=LEAST_PAIR_GAIN)
    machine = fit(found)

    def sums(owner, column, value, rows):
        return machine.sums(owner, column, rows)

    return scored(docs, fold("doc_id", parts, part), _terms, BITS, found, sums, id_col, text_col, carry)
