"""Periodic runs of words, by online dyadic square catching.

A square is a stretch of words followed by the same stretch again. The words of a text
are appended to a sequence, and at every power of two the completed blocks of that many
words, at whole multiples, become catchers. A catcher of ``b`` words waits for its block
to come again between ``2 b`` and ``4 b`` words later: a square of such a period holds a
whole block in its first half, so it cannot slip through. Each appended word ends one
window per level, which is compared with the two catchers that are awake there, so a
word costs two comparisons of hashes per level.

What catchers of one distance report side by side is one stretch of words that equal those
a period later. It is extended to both sides, and stretches as long as their period are
squares; merged they are the runs. A level does not look again at distances that are
multiples of a run already found around them.

Words are numbered by hashes; those of a run found are compared as they are.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import flat, keyed, slices, thrifty
from tidegate.llm.words import BASE, Words, _mix

LEAST_EXPONENT, LEAST_LENGTH = 4, 6
# Hashes of blocks up to two to this power are kept for extending; of longer ones, as many as catchers need.
KEPT_LEVEL = 4


class _Level:
    """Hashes of the windows of ``size`` words that begin at ``base`` and later."""

    def __init__(self, size: int):
        import numpy as np

        self.size, self.base, self.hash = size, 0, np.zeros(0, np.uint64)

    @property
    def stop(self) -> int:
        return self.base + len(self.hash)


class Catchers:
    """Squares of a growing sequence of word numbers, up to a longest period."""

    def __init__(self, most_period: int):
        self.most_period = most_period
        self.levels = [_Level(1)]
        self.caught: list[list] = [[]]
        self.count = 0

    def append(self, codes) -> None:
        """Add words; every square that they complete is caught."""
        import numpy as np

        self.count += len(codes)
        new = codes
        for k, level in enumerate(self.levels):
            size, first = level.size, level.stop
            level.hash = np.concatenate([level.hash, new])
            at = np.arange(first, level.stop)
            for distance in (1, 2, 3) if size == 1 else (2, 3):
                block = (at // size - distance) * size if size > 1 else at - distance
                awake = slice(int(np.searchsorted(block, 0)), None)
                ended, block = at[awake], block[awake]
                hit = (level.hash[ended - level.base] == level.hash[block - level.base]) & (ended - block <= self.most_period)
                self.caught[k].append(np.stack([block[hit], ended[hit] - block[hit]]))
            if 4 * size > self.most_period:
                break
            if k + 1 == len(self.levels):
                self.levels.append(_Level(2 * size))
                self.caught.append([])
            longer = self.levels[k + 1]
            at = np.arange(longer.stop, max(longer.stop, self.count - 2 * size + 1)) - level.base
            new = _mix(level.hash[at] * np.uint64(BASE) + level.hash[at + size])
            if k > KEPT_LEVEL and len(level.hash) > 6 * size:
                drop = len(level.hash) - 5 * size
                level.base, level.hash = level.base + drop, level.hash[drop:].copy()

    def _reach(self, at, period, step: int):
        """How far words go on to equal those a period later, from ``at`` on (``step`` 1) or before it (-1)."""
        import numpy as np

        reach = np.zeros(len(at), np.int64)
        for k in range(min(KEPT_LEVEL, len(self.levels) - 1), -1, -1):
            size, known = self.levels[k].size, self.levels[k].hash
            on = np.arange(len(at))
            while len(on):
                low = at[on] + reach[on] if step > 0 else at[on] - reach[on] - size
                high = low + period[on]
                inside = (low >= 0) & (high + size <= self.count)
                on, low, high = on[inside], low[inside], high[inside]
                on = on[known[low] == known[high]]
                reach[on] += size
                if k < KEPT_LEVEL and k + 1 < len(self.levels):  # a second step would have been one of the level above
                    break
        return reach

    def runs(self, least_exponent: int = LEAST_EXPONENT, least_length: int = LEAST_LENGTH):
        """``(start, length, period)`` of the runs of so many periods and words, by start and period."""
        import numpy as np

        found = [np.zeros((3, 0), np.int64)]
        # of each place, the run around it that ends last, and its period
        until, around = np.zeros(self.count + 1, np.int64), np.ones(self.count + 1, np.int64)
        for level, caught in zip(self.levels, self.caught):
            block, period = np.concatenate(caught, axis=1) if caught else np.zeros((2, 0), np.int64)
            fresh = (until[block] < block + period + level.size) | (period % around[block] != 0)
            block, period = block[fresh], period[fresh]
            order = np.lexsort((block, period))
            block, period = block[order], period[order]
            first = np.ones(len(block), bool)
            first[1:] = (period[1:] != period[:-1]) | (block[1:] != block[:-1] + level.size)
            begin = np.flatnonzero(first)
            last = np.append(begin[1:], len(block)) - 1 if len(begin) else begin
            low, high, period = block[begin], block[last] + level.size, period[begin]
            low, high = low - self._reach(low, period, -1), high + self._reach(high, period, 1)
            length = high - low + period
            enough = (length >= least_exponent * period) & (length >= least_length)
            run = np.unique(np.stack([low[enough], length[enough], period[enough]]), axis=1)
            found.append(run)
            for start, long, p in run[:, np.argsort(run[1], kind="stable")].T.tolist():
                later = until[start : start + long] < start + long
                until[start : start + long][later] = start + long
                around[start : start + long][later] = p
        start, length, period = np.concatenate(found, axis=1)
        order = np.lexsort((period, length, start))  # of one stretch, the smallest period
        start, length, period = start[order], length[order], period[order]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        order = np.lexsort((period[new], start[new]))
        return start[new][order], length[new][order], period[new][order]


def runs_of(words: list, least_exponent: int = LEAST_EXPONENT, least_length: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of one sequence of any values, compared as they are."""
    import numpy as np

    numbers: dict = {}
    codes = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.uint64)
    catchers = Catchers(len(words) // least_exponent)
    catchers.append(_mix(codes))
    return list(zip(*(c.tolist() for c in catchers.runs(least_exponent, least_length))))


def looped(doc_id, n: int):
    """``(first, period)`` from which every tenth id's words go round in a loop, or None: a planted run."""
    import zlib

    if doc_id is None or n == 0:
        return None
    mark = zlib.crc32(str(doc_id).encode())
    if mark % 10:
        return None
    first = mark // 10 % n
    return first, 1 + (n - first) // (3 + mark // 10 % 8)


def _sound(words: list, runs: list) -> bool:
    return all(words[s : s + n - p] == words[s + p : s + n] for s, n, p in runs)


def _answers(plant: bool, least_exponent: int, least_length: int, detail: bool, others: list[str]):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        finder = Words()
        whole = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").cast(pa.binary())
                ids = part.column("doc_id").to_pylist()
                data, offsets = flat(part.column("text"))
                starts, ends, first = finder.spans(data, offsets)
                hashed = finder.hashes(data, starts, ends)
                sizes = np.diff(first)
                loops = {d: loop for d, i in enumerate(ids) if plant and (loop := looped(i, int(sizes[d])))}
                for d, (a, p) in loops.items():
                    own = hashed[first[d] : first[d + 1]]
                    own[a:] = own[a + np.arange(len(own) - a) % p]
                # between two texts stands a word of its own, which equals no other
                border = _mix((np.arange(len(ids), dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE) ^ np.uint64(0x5BD1E995))
                catchers = Catchers(int(sizes.max(initial=0)) // least_exponent)
                catchers.append(np.insert(hashed, first[1:], border))
                start, length, period = catchers.runs(least_exponent, least_length)
                begins = first[:-1] + np.arange(len(ids))
                owner = np.searchsorted(begins, start, side="right") - 1
                cuts = np.searchsorted(owner, np.arange(len(ids) + 1)).tolist()
                start = start - begins[owner]
                rows = list(zip(start.tolist(), length.tolist(), period.tolist()))
                out = []
                for d in range(len(ids)):
                    text, runs = texts[d].as_py() or b"", rows[cuts[d] : cuts[d + 1]]
                    words = text.split()
                    if d in loops:
                        a, p = loops[d]
                        words[a:] = [words[a + i % p] for i in range(len(words) - a)]
                    if not _sound(words, runs):  # two words share a hash
                        runs = runs_of(words, least_exponent, least_length)
                    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
                    milli = 1000 * best[1] // best[2] if runs else None
                    listed = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
                    if runs:
                        kept = np.ones(len(words), bool)
                        for s, n, p in runs:
                            kept[s + p : s + n] = False
                        words = [words[i] for i in np.flatnonzero(kept).tolist()]
                    collapsed = b" ".join(words)
                    detailed = ([dict(zip(("start", "length", "period"), r)) for r in runs], collapsed.decode()) if detail else ()
                    out.append((len(runs), *best, milli, listed, hashlib.sha256(collapsed).hexdigest(), *detailed))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + ([whole, pa.string()] if detail else [])
                names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"] + (["runs", "collapsed"] if detail else [])
                made = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), *made], [*others, *names])

    return run


def periodic_runs(
    docs: DataFrame, least_exponent: int = LEAST_EXPONENT, least_length: int = LEAST_LENGTH, plant: bool = False, detail: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` for each row.

    A run is a stretch of words with a smallest period that occurs ``least_exponent`` times
    (2 at least) in it, of at least ``least_length`` words, and that goes on to neither
    side. The columns from ``start`` on describe the run of the greatest ratio of length to
    period (ties: the first, then the shorter period) and are null without runs; the first
    digest is of all runs. Collapsed, a text loses all but the first period of every run;
    its words are joined by one space. With ``detail``, ``runs`` and the ``collapsed`` text
    are returned too. With ``plant``, every tenth id's words first go round in a loop from
    a place on that its hash names.

    Null and empty texts have no words and no runs; null ids are not planted. Rows that
    repeat are answered each. A very long text is worked on alone. An empty table gives an
    empty result, and columns of other names do not matter.
    """
    if least_exponent < 2:
        raise ValueError("a run holds its period at least twice")
    source = keyed(docs, id_col, text_col)
    made = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    made += ", runs array<struct<start:long,length:long,period:long>>, collapsed string" if detail else ""
    schema = T.StructType([source.schema["doc_id"], *T.StructType.fromDDL(made)])
    return source.mapInArrow(thrifty(_answers(plant, least_exponent, least_length, detail, ["doc_id"])), schema)
