"""Exact ranks, ranges and percentiles by histograms that narrow.

Spark's exact ``percentile`` keeps every distinct value of a column in one buffer,
which cannot hold a column of a large table. Here a value becomes a 64-bit key of the
same order: an integer or the digits of a decimal are their own key, a double's key is
made of its bits. So nothing is rounded, beyond 2**53 neither.

1. The first scan counts keys by the leading bits of their double, which part values of
   any size into some hundred places a power of two, and notes the least and greatest
   key of each place. That gives counts, ranges and sums, and encloses each wanted rank.
2. A place that holds few enough values is a bracket whose values are counted one by one
   in the second scan. A larger one is cut into 2**16 equal parts first, each as narrow.

A task sorts each column of a batch once and finds all its brackets, which are disjoint,
by search; a row is one entry per column whatever the number of ranks. What tasks send is
one row per place, and only a handful of brackets return to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Context, Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import settle, small_table

# Parts that a bracket is cut into, and values that one may hold to be counted singly.
BUCKETS = 1 << 16
FEW = 1 << 16
# Bits of a double that the first scan leaves out, of 64: sign, exponent and 8 more remain.
COARSE_BITS = 44
# First scan, one per 16 bits of a key at most, and the last one.
MOST_SCANS = 6
# Rows that a task holds before it adds them up.
TALLY_ROWS = 1 << 17
# Digits of a decimal whose unscaled value fits 64 bits; longer ones are ranked as doubles.
LONG_DIGITS = 18


def number_column(name: str) -> Column:
    """The column as double with NaN as missing."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _scale(kind: T.DataType) -> int | None:
    """Digits after the point of a column whose keys are whole numbers; None for doubles."""
    if isinstance(kind, T.IntegralType):
        return 0
    if isinstance(kind, T.DecimalType) and kind.precision <= LONG_DIGITS:
        return kind.scale
    return None


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    scale = _scale(kind)
    if scale is None:
        return number_column(name)
    value = F.col(f"`{name}`")
    if scale:
        value = value * F.lit(Decimal(10) ** scale)
    return value.cast("bigint")


def _double_keys(values):
    """64-bit keys in the order of doubles; both zeros are one."""
    import numpy as np

    bits = (values + 0.0).view(np.int64)
    return np.where(bits >= 0, bits, bits ^ np.int64((1 << 63) - 1))


def _sorted_keys(array, scale: int | None):
    """Keys and values of a column of a batch, without what is missing, in order."""
    import numpy as np

    if scale is None:
        values = np.array(array.to_numpy(zero_copy_only=False), np.float64)
        values = np.sort(values[~np.isnan(values)])
        return _double_keys(values), values
    values = np.sort(array.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
    return values, values.astype(np.float64)


class _Tally:
    """Rows ``bracket, place, n, lo, hi, total``, added up whenever there are many."""

    def __init__(self):
        self.whole, self.totals, self.rows = [], [], 0

    def add(self, bracket: int, place, keys, values) -> None:
        """Count sorted keys by place, which never falls."""
        import numpy as np

        if not len(keys):
            return
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(keys)) - 1
        self.whole.append(np.stack([np.full(len(first), bracket), place[first], last - first + 1, keys[first], keys[last]]))
        with np.errstate(invalid="ignore"):
            self.totals.append(np.add.reduceat(values, first))
        self.rows += len(first)
        if self.rows > TALLY_ROWS:
            self._fold()

    def _fold(self) -> None:
        import numpy as np

        whole, totals = np.concatenate(self.whole, axis=1), np.concatenate(self.totals)
        order = np.lexsort((whole[1], whole[0]))
        bracket, place, n, lo, hi = whole[:, order]
        first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (bracket[1:] != bracket[:-1])))
        with np.errstate(invalid="ignore"):
            self.totals = [np.add.reduceat(totals[order], first)]
        self.whole = [np.stack([bracket[first], place[first], np.add.reduceat(n, first), np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first)])]
        self.rows = len(first)

    def batches(self):
        import pyarrow as pa

        if self.rows:
            self._fold()
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in self.whole[0]), pa.array(self.totals[0])], ["bracket", "place", "n", "lo", "hi", "total"])


def _counted(scales: list, brackets: list | None):
    """Counts by place: of whole columns, or of ``brackets``, ``(lo, hi, step)`` lists per column, numbered through."""

    def run(batches):
        import numpy as np

        tally = _Tally()
        for batch in batches:
            number = 0
            for i, scale in enumerate(scales):
                keys, values = _sorted_keys(batch.column(i), scale)
                if brackets is None:
                    coarse = keys if scale is None else _double_keys(values)
                    tally.add(i, coarse >> COARSE_BITS, keys, values)
                    continue
                for lo, hi, step in brackets[i]:
                    a, b = np.searchsorted(keys, lo, "left"), np.searchsorted(keys, hi, "right")
                    own = keys[a:b]
                    place = own if not step else ((own.view(np.uint64) - np.uint64(lo % 2**64)) // np.uint64(step)).astype(np.int64)
                    tally.add(number, place, own, values[a:b])
                    number += 1
        yield from tally.batches()

    return run


class Ranks:
    """Counts, ranges, means and values at any rank of numeric columns."""

    def __init__(self, df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, few: int = FEW):
        self.columns = list(columns)
        self.spark, self.buckets, self.few = df.sparkSession, buckets, few
        self.scales = [_scale(df.schema[c].dataType) for c in self.columns]
        self.values = df.select(*[_number(df, c).alias(f"c{i}") for i, c in enumerate(self.columns)])
        self.scans = 0
        self.first = settle(self._scan(None))
        found = self.first.groupBy("bracket").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"))
        rows = {r["bracket"]: r for r in found.collect()}  # one per column
        self.totals = [(r["n"], r["lo"], r["hi"], r["total"]) if (r := rows.get(i)) else (0, None, None, None) for i in range(len(self.columns))]

    def _scan(self, brackets) -> DataFrame:
        self.scans += 1
        schema = "bracket long, place long, n long, lo long, hi long, total double"
        counts = self.values.mapInArrow(_counted(self.scales, brackets), schema)
        return counts.groupBy("bracket", "place").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"))

    def count(self, column: str) -> int:
        return self.totals[self.columns.index(column)][0]

    def value(self, column: str, key: int | None):
        """The value of a key in the column's own kind: int, Decimal or float."""
        import struct

        if key is None:
            return None
        scale = self.scales[self.columns.index(column)]
        if scale is None:
            return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ ((1 << 63) - 1)))[0]
        return Decimal(key).scaleb(-scale) if scale else key

    def range(self, column: str) -> tuple:
        _, lo, hi, _ = self.totals[self.columns.index(column)]
        return self.value(column, lo), self.value(column, hi)

    def mean(self, column: str) -> float | None:
        i = self.columns.index(column)
        n, _, _, total = self.totals[i]
        return total / n / 10 ** (self.scales[i] or 0) if n else None

    def _located(self, counts: DataFrame, wanted: list[tuple[int, int]]) -> dict:
        """For each wanted ``(bracket, rank inside it)``, by its place in the list: the place's ``lo, hi, n`` and the rank inside."""
        running = counts.withColumn("upto", F.sum("n").over(W.partitionBy("bracket").orderBy("place").rowsBetween(W.unboundedPreceding, 0)))
        asked = small_table(self.spark, [(b, r, k) for k, (b, r) in enumerate(wanted)], "bracket long, rank long, wanted int")
        inside = (F.col("upto") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("upto"))
        # a few ranks per column
        found = running.join(F.broadcast(asked), "bracket").where(inside)
        rows = found.select("wanted", "lo", "hi", "n", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")).collect()
        return {r["wanted"]: (r["lo"], r["hi"], r["n"], r["rank"]) for r in rows}

    def at(self, wanted: dict[str, set[int]]) -> dict[tuple[str, int], object]:
        """The values at 0-based ranks of columns, in ascending order."""
        pending = [(c, r, self.columns.index(c), r) for c, ranks in wanted.items() for r in sorted(ranks)]
        answers, counts = {}, self.first
        while pending:
            found = self._located(counts, [(bracket, rank) for _, _, bracket, rank in pending])
            still = []
            for k, (c, r, _, _) in enumerate(pending):
                lo, hi, n, rank = found[k]
                if lo == hi:
                    answers[c, r] = self.value(c, lo)
                else:
                    still.append((c, r, (lo, hi, 0 if n <= self.few else -(-(hi - lo + 1) // self.buckets)), rank))
            if not still:
                break
            brackets = [sorted({b for c, _, b, _ in still if c == name}) for name in self.columns]
            number = {(name, b): i for i, (name, b) in enumerate((name, b) for name, own in zip(self.columns, brackets) for b in own)}
            counts = settle(self._scan(brackets))
            pending = [(c, r, number[c, b], rank) for c, r, b, rank in still]
        return answers

    def percentiles(self, shares: Sequence[float]) -> dict[str, list]:
        """Linearly interpolated percentiles of every column; values met exactly keep their own kind."""
        places = {c: [Fraction(s) * (self.count(c) - 1) for s in shares] for c in self.columns if self.count(c)}
        found = self.at({c: {r for p in ps for r in (math.floor(p), math.ceil(p))} for c, ps in places.items()}) if places else {}

        def at(column: str, place: Fraction):
            low, high = math.floor(place), math.ceil(place)
            below, above = found[column, low], found[column, high]
            if below == above:
                return below
            if isinstance(below, float):
                return float(high - place) * below + float(place - low) * above
            between = Fraction(below) * (high - place) + Fraction(above) * (place - low)
            return Context(60).divide(Decimal(between.numerator), Decimal(between.denominator))

        return {c: [at(c, p) for p in places[c]] if c in places else [None] * len(shares) for c in self.columns}


def exact_percentiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], buckets: int = BUCKETS, few: int = FEW) -> dict[str, list[float | None]]:
    """Percentiles as doubles."""
    found = Ranks(df, columns, buckets, few).percentiles(shares)
    return {c: [None if v is None else float(v) for v in values] for c, values in found.items()}
