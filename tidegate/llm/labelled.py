"""Fitting on a bounded sample of labelled rows, scoring on all.

Only the sample's selected features reach the driver, where a model of bounded size is
trained; scoring is one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import keyed, slices, thrifty, working, written

# Labelled rows that a model is fitted on, the least by a hash of their id, as long as
# their texts hold so many bytes; and the features it may use at most, of each screen.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 1 << 27
MOST_FEATURES = 1 << 14
# A task counts pairs for each so many features of sampled rows.
SHARE_ENTRIES = 1 << 20


def fold(id_col: str, parts: int, part: int) -> Column:
    """True for rows of a held-out part, by the CRC-32 of the id as text; false for a null id."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part
    return F.coalesce(rest, F.lit(False))


def _described(describe: Callable, bits: int, keep, rank=None):
    """``y, features, values`` of labelled texts; only ``keep`` of the features, if given, by place or ``rank``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        features_of = describe()
        lists = pa.list_(pa.int32()), pa.list_(pa.float64())
        for batch in batches:
            for part in slices(batch):
                owner, feature, value = features_of(part.column("text"))
                if keep is not None:
                    known = np.searchsorted(keep, feature)
                    known[known == len(keep)] = 0
                    chosen = keep[known] == feature if len(keep) else np.zeros(len(feature), bool)
                    owner, feature, value = owner[chosen], known[chosen] if rank is None else rank[known[chosen]], value[chosen]
                key, place = np.unique(owner << bits | feature, return_inverse=True)
                value = np.bincount(place, weights=value, minlength=len(key))
                ends = np.searchsorted(key >> bits, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("y"),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array((key & ((1 << bits) - 1)).astype(np.int32))).cast(lists[0]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(value)).cast(lists[1]),
                    ],
                    ["y", "features", "values"],
                )

    return thrifty(run)


def _gain(with_1: Column, with_any: Column, ones: int, rows: int) -> Column:
    """G² of a feature's presence against the label."""
    out = F.lit(0.0)
    for seen, margin_a, margin_b in (
        (with_1, with_any, F.lit(ones)),
        (with_any - with_1, with_any, F.lit(rows - ones)),
        (F.lit(ones) - with_1, F.lit(rows) - with_any, F.lit(ones)),
        (F.lit(rows - ones) - (with_any - with_1), F.lit(rows) - with_any, F.lit(rows - ones)),
    ):
        out = out + F.when(seen > 0, 2 * seen * F.log(seen * F.lit(float(rows)) / (margin_a * margin_b))).otherwise(0.0)
    return out


def _gains(with_1, with_any, ones: int, rows: int):
    """The same of arrays."""
    import numpy as np

    out = np.zeros(len(with_any))
    for seen, margin_a, margin_b in (
        (with_1, with_any, ones),
        (with_any - with_1, with_any, rows - ones),
        (ones - with_1, rows - with_any, ones),
        (rows - ones - (with_any - with_1), rows - with_any, rows - ones),
    ):
        some = seen > 0
        out[some] += 2 * seen[some] * np.log(seen[some] * float(rows) / ((margin_a + 0 * seen)[some] * float(margin_b)))
    return out


def least_support(ones: int, rows: int, gain: float) -> tuple[int, int]:
    """In how many rows of label 1, or else of label 0, a pair must be to gain as much at all."""
    import numpy as np

    def least(most, label):
        n = np.arange(1, most + 1)
        enough = n[_gains(n * label, n, ones, rows) >= gain]
        return int(enough[0]) if len(enough) else rows + 1

    return least(ones, 1), least(rows - ones, 0)


def paired(y, ends, ranks, with_1, with_any, gain: float, share: int = 0, shares: int = 1):
    """``(rank, gain)`` of features of pairs that gain ``gain`` more together than the better of the two does alone.

    Features go by rank, the rarest first; ``with_1`` and ``with_any`` count a feature's
    rows. Rows are in compressed form, each with its ranks in order. All pairs are
    counted, each at its rarer feature, of which a share are looked at, so that a task
    holds the rows once and an index of its share only.
    """
    import numpy as np

    rows, ones, size = len(y), int(y.sum()), len(with_any)
    alone = _gains(with_1, with_any, ones, rows)
    own = np.flatnonzero(ranks % shares == share)
    own = own[np.argsort(ranks[own], kind="stable")]
    starts = np.searchsorted(ranks[own], np.arange(size + 1))
    least_1, least_0 = least_support(ones, rows, gain)
    best = np.zeros(size)
    for a in range(share, size, shares):
        at = own[starts[a] : starts[a + 1]]
        owner = np.searchsorted(ends, at, side="right") - 1
        lengths = ends[owner + 1] - at - 1
        rest = ranks[np.repeat(at + 1 - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
        both = np.bincount(2 * (rest - a) + np.repeat(y[owner], lengths), minlength=2 * (size - a)).reshape(-1, 2)
        b = np.flatnonzero((both[:, 1] >= least_1) | (both[:, 0] >= least_0))
        more = _gains(both[b, 1], both[b].sum(axis=1), ones, rows) - np.maximum(alone[a], alone[a + b])
        b, more = b[more >= gain], more[more >= gain]
        best[a + b] = np.maximum(best[a + b], more)
        best[a] = max(best[a], more.max(initial=0.0))
    found = np.flatnonzero(best)
    return found, best[found]


def _paired_shares(held, with_1, with_any, gain: float, shares: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for share in batch.column("id").to_pylist():
                place, more = paired(*held.value, with_1, with_any, gain, share, shares)
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(more)], ["place", "more"])

    return thrifty(run)


def _rows(table):
    """``y, ends, columns`` of described rows, in compressed form."""
    import numpy as np

    table = table.combine_chunks()
    features = table["features"].combine_chunks()
    ends = np.cumsum([0, *features.value_lengths().to_numpy(zero_copy_only=False)])
    return table["y"].to_numpy(), ends, features.flatten().to_numpy(zero_copy_only=False)


def _paired_features(texts: DataFrame, counted: DataFrame, describe: Callable, bits: int, ones: int, rows: int, gain: float, most: int):
    """Features of the sample that gain the most in pairs; tasks share out the features.

    The rows go out once as a broadcast, bounded as the sample is: 4 bytes for each
    different feature of a sampled row. It is destroyed when the pairs are counted.
    """
    import numpy as np

    least_1, least_0 = least_support(ones, rows, gain)
    able = counted.filter((F.col("with_1") >= least_1) | (F.col("with_any") - F.col("with_1") >= least_0)).orderBy("feature").toArrow()
    features, with_1, with_any = (able[c].to_numpy().astype(np.int64) for c in ("feature", "with_1", "with_any"))
    if not len(features):
        return features
    order = np.lexsort((features, with_any))
    rank = np.empty(len(features), np.int64)
    rank[order] = np.arange(len(features))
    described = texts.mapInArrow(_described(describe, bits, features, rank), "y int, features array<int>, values array<double>")
    found = _rows(described.select("y", "features").toArrow())
    spark = texts.sparkSession
    shares = -(-len(found[2]) // SHARE_ENTRIES) or 1
    held = spark.sparkContext.broadcast(found)
    places = spark.range(0, shares, 1, shares).mapInArrow(_paired_shares(held, with_1[order], with_any[order], gain, shares), "place long, more double")
    places = places.groupBy("place").agg(F.max("more").alias("more")).orderBy(F.desc("more"), "place").limit(most)
    places = places.toArrow()["place"].to_numpy()
    held.destroy()
    return np.sort(features[order[places]])


class Sample:
    """Selected features of the sample: sorted feature numbers, labels, and rows in compressed form."""

    def __init__(self, features, y, ends, columns, values):
        self.features, self.y, self.ends, self.columns, self.values = features, y, ends, columns, values

    @property
    def one_sided(self) -> bool:
        """No rows, or only rows of one label: nothing to learn but that label."""
        return len(self.y) == 0 or self.y.min() == self.y.max()


def _chosen(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """``y, text`` of the labelled rows to learn from: ``rows`` at most, of ``size`` bytes at most (or one row).

    Rows that agree in id and text are one. A few numbers per row decide, before any text is moved.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(train)
    ids = written(known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "sample-ids")
    marked = keyed(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    found = marked.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "mark").agg(F.max(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("copies"))
    first = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("mark")]
    found = found.orderBy(*first).limit(rows)
    upto = F.sum(F.col("bytes").cast("long")).over(W.orderBy(*first).rowsBetween(W.unboundedPreceding, 0))  # of ``rows`` rows at most
    found = written(found.withColumn("upto", upto).filter((F.col("upto") <= size) | (F.col("upto") == F.col("bytes"))).drop("upto"), "sample-rows")
    texts = marked.join(F.broadcast(found.select("doc_id", "mark")), ["doc_id", "mark"], "left_semi")
    if not found.filter("copies > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "mark"])
    return texts.join(F.broadcast(ids), "doc_id").select("y", "text")


def sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, describe: Callable, bits: int, least_docs: int, least_gain: float, rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id", text_col: str = "text", most_features: int = MOST_FEATURES, least_pair_gain: float | None = None, size: int = SAMPLE_BYTES,
) -> Sample:
    """The labelled rows to learn from, by the features that tell the labels apart.

    Those are, of the features of at least ``least_docs`` sampled rows, the ``most_features``
    of most gain, from ``least_gain`` on; and, with a ``least_pair_gain``, those of any two
    that gain as much more together than the better of them does alone, again the
    ``most_features`` of most such gain.

    The sample has ``rows`` rows at most, however often an id or a row repeats, and ``size``
    bytes of text (one row, if that is longer). Labels that are null, or of ids without a
    document, are left out; an id with several labels counts as 1 if any of them is.
    """
    with working(docs.sparkSession):
        return _sampled(_chosen(docs, labels, label, train, rows, size, id_col, text_col), describe, bits, least_docs, least_gain, most_features, least_pair_gain)


def _sampled(texts: DataFrame, describe: Callable, bits: int, least_docs: int, least_gain: float, most_features: int, least_pair_gain: float | None) -> Sample:
    import numpy as np

    schema = "y int, features array<int>, values array<double>"
    seen = written(texts.mapInArrow(_described(describe, bits, None), schema).select("y", "features"), "sample-features")
    total = seen.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("ones")).first()
    counted = seen.select("y", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("y").alias("with_1"), F.count(F.lit(1)).alias("with_any"))
    gain = _gain(F.col("with_1"), F.col("with_any"), total.ones, total.n)
    counted = written(counted.filter(F.col("with_any") >= least_docs), "sample-counts")
    told = counted.withColumn("gain", gain).filter(F.col("gain") >= least_gain)
    features = told.orderBy(F.desc("gain"), "feature").limit(most_features).select("feature").toArrow()["feature"].to_numpy()
    features = np.sort(features.astype(np.int64))
    if least_pair_gain is not None:
        features = np.union1d(features, _paired_features(texts, counted, describe, bits, total.ones, total.n, least_pair_gain, most_features))
    described = texts.mapInArrow(_described(describe, bits, features), schema)
    table = described.withColumn("mark", F.xxhash64("features", "values")).toArrow()
    table = table.sort_by([("y", "ascending"), ("mark", "ascending")]).combine_chunks()  # the same order in every run
    ends = np.cumsum([0, *table["features"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)])
    columns, values = (table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("features", "values"))
    return Sample(features, table["y"].to_numpy().astype(np.float64), ends, columns, values)


def _scored(describe: Callable, bits: int, features, score: Callable, constant, others: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        features_of = describe()
        number = np.full(1 << bits, -1, np.int32)
        number[features] = np.arange(len(features))
        for batch in batches:
            for part in slices(batch):
                if constant is None:
                    owner, feature, value = features_of(part.column("text"))
                    column = number[feature]
                    known = column >= 0
                    key, place = np.unique(owner[known] << bits | column[known], return_inverse=True)
                    value = np.bincount(place, weights=value[known], minlength=len(key))
                    sums = score(key >> bits, key & ((1 << bits) - 1), value, part.num_rows)
                    chance = 1 / (1 + np.exp(-np.clip(sums, -40, 40)))
                else:
                    chance = np.full(part.num_rows, constant)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(chance)], [*others, "score"])

    return thrifty(run)


def scored(
    docs: DataFrame, held_out: Column, describe: Callable, bits: int, found: Sample, score: Callable, id_col: str, text_col: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row, and the columns to carry."""
    constant = None
    if found.one_sided:
        constant = float(found.y[0]) if len(found.y) else 0.0
    source = keyed(docs, id_col, text_col, held_out=held_out, **{f"carry_{i}": F.col(c) for i, c in enumerate(carry)})
    others = [c for c in source.columns if c != "text"]
    schema = T.StructType([*(source.schema[c] for c in others), T.StructField("score", T.DoubleType())])
    out = source.mapInArrow(_scored(describe, bits, found.features, score, constant, others), schema)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumnsRenamed({f"carry_{i}": c for i, c in enumerate(carry)})
