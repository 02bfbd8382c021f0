"""Quality by logistic regression over hashed word n-grams, fitted with FTRL-proximal.

Words are runs of letters and digits, or of other signs. N-grams are taken of the words
and of their shapes (case, length, digits, whether a word repeats the one before), so
that junk of unseen words still shows. A feature's value is its share of the text's
n-grams. Fitting follows the regularised leader: each weight is a function of its summed
gradients and stays 0 until they exceed the L1 threshold, so a score is a sparse dot
product with the few hundred weights that remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.llm.common import flat
from tidegate.llm.labelled import SAMPLE_ROWS, Sample, fold, sample, scored
from tidegate.llm.words import BASE, Words, _mix, grams, owners, space_table, term_table

BITS = 20
WORD_GRAMS = (1, 2)
SHAPE_GRAMS = (1, 2, 3)
# Shares are multiplied by this, so that common features are near 1.
SCALE = 10.0
LEAST_DOCS = 5
LEAST_GAIN = 8.0


def _ngrams():
    import numpy as np

    letters = term_table()
    words, signs = Words(letters), Words(~letters | space_table())
    shift = np.uint64(64 - BITS)

    def shapes(data, starts, ends, hashed):
        upper = lambda at: (data[at] >= 65) & (data[at] <= 90)
        digit = (data[starts] >= 48) & (data[starts] <= 57)
        again = np.zeros(len(hashed), bool)
        again[1:] = hashed[1:] == hashed[:-1]
        code = upper(starts) + 2 * upper(ends - 1) + 4 * digit + 8 * again + 16 * np.minimum((ends - starts) // 4, 5)
        return _mix((code + 1000).astype(np.uint64) * np.uint64(BASE))

    def run(texts):
        data, offsets = flat(texts)
        spans = [w.spans(data, offsets) for w in (words, signs)]
        hashed = [w.hashes(data, s, e) for w, (s, e, _) in zip((words, signs), spans)]
        starts = np.concatenate([s for s, _, _ in spans])
        order = np.argsort(starts, kind="stable")
        first = np.searchsorted(starts[order], offsets)
        owner, end = owners(first), np.repeat(first[1:], np.diff(first))
        shape = shapes(data, spans[0][0], spans[0][1], hashed[0]) if len(hashed[0]) else hashed[0]
        of, feature = [], []
        for sequence, sizes, salt in ((hashed, WORD_GRAMS, 1), ([shape, hashed[1]], SHAPE_GRAMS, 9)):
            ordered = np.concatenate(sequence)[order]
            for size in sizes:
                gram = grams(ordered, size, salt + size)
                whole = np.arange(len(gram)) + size <= end[: len(gram)]
                feature.append((gram[whole] >> shift).astype(np.int64))
                of.append(owner[: len(gram)][whole])
        of = np.concatenate(of)
        return of, np.concatenate(feature), SCALE / np.bincount(of, minlength=len(texts))[of]

    return run


class Leader:
    """FTRL-proximal state of one coordinate per feature, and of a bias."""

    def __init__(self, size: int, rate: float = 0.5, l1: float = 0.5, l2: float = 1e-3):
        import numpy as np

        self.sums, self.squares = np.zeros(size + 1), np.zeros(size + 1)
        self.rate, self.l1, self.l2 = rate, np.full(size + 1, l1), l2
        self.l1[size] = 0.0

    def weights(self, at):
        import numpy as np

        sums = self.sums[at]
        over = np.maximum(np.abs(sums) - self.l1[at], 0.0)
        return -np.sign(sums) * over / ((1 + np.sqrt(self.squares[at])) / self.rate + self.l2)

    def learn(self, at, values, y: float) -> None:
        import numpy as np

        weights = self.weights(at)
        slope = (1 / (1 + np.exp(-np.clip(weights @ values, -40, 40))) - y) * values
        grown = self.squares[at] + slope**2
        self.sums[at] += slope - (np.sqrt(grown) - np.sqrt(self.squares[at])) / self.rate * weights
        self.squares[at] = grown


def fit(found: Sample, rounds: int = 2, seed: int = 1):
    """Weight of each selected feature, and the bias last."""
    import numpy as np

    size = len(found.features)
    leader = Leader(size)
    draw = np.random.default_rng(seed)
    for _ in range(0 if found.one_sided else rounds):
        for row in draw.permutation(len(found.y)):
            low, high = found.ends[row], found.ends[row + 1]
            leader.learn(np.append(found.columns[low:high], size), np.append(found.values[low:high], 1.0), found.y[row])
    return leader.weights(np.arange(size + 1))


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 3, part: int = 1, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    ``score`` (0 to 1) is the chance that the text's label is 1, by a model fitted on at
    most ``sample_rows`` labelled rows outside the held-out part; only the text decides.
    Null counts as empty, and an empty text gets the score of the bias. Rows that repeat
    are scored each. Where the sample holds no label 1 (or no rows) every score is 0, and
    1 where it holds nothing else. An empty table gives an empty result.
    """
    found = sample(docs, labels, label, ~fold("doc_id", parts, part), _ngrams, BITS, LEAST_DOCS, LEAST_GAIN, sample_rows, id_col, text_col)
    weights = fit(found)

    def sums(owner, column, value, rows):
        import numpy as np

        return weights[-1] + np.bincount(owner, weights=weights[column] * value, minlength=rows)

    return scored(docs, fold("doc_id", parts, part), _ngrams, BITS, found, sums, id_col, text_col)
