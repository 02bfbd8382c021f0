"""Table profile: what a reader of the table wants to know about each column.

Each function takes a table and returns a small long-form DataFrame, one row per
column (or per column and bin, value, pair). Statistics that need a first pass
read it back as a scalar subquery or as a few numbers, never as a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.quantiles import Ranks, exact_percentiles, number_column
from tidegate.session import small_table

TOP_VALUES = 10
HISTOGRAM_BINS = 30
MODE_LIMIT = 10
QUARTILES = (0.25, 0.5, 0.75)
# An estimate beyond so many times the limit is certain to be beyond the limit.
SURE = 4
# Texts up to here are their own keys.
KEY_BYTES = 32
INFINITE = float("inf")
# A spread that is a smaller share of the squares it was taken from is taken again around
# the pair's own means; one under this share of the mean is that of equal values.
LOST, EQUAL = 1e-6, 1e-15

# Bytes per value of a fixed-width type.
WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN as missing."""
    value = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def _per_column(stats: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one row of ``s<i>`` structs into one row per column."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"s{i}")[f].alias(f) for f in fields]) for i, c in enumerate(columns)])
    return stats.select(F.inline(rows))


def _summaries(df: DataFrame, columns: Sequence[str], summary) -> DataFrame:
    """One aggregate over the table holding ``summary(column)`` for every column."""
    return df.agg(*[F.struct(*[v.alias(k) for k, v in summary(c).items()]).alias(f"s{i}") for i, c in enumerate(columns)])


def column_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    rows = F.count(F.lit(1))

    def summary(c):
        nulls = rows - F.count(present(df, c))
        return {"nulls": nulls, "null_pct": F.try_divide(nulls * 100.0, rows)}

    return _per_column(_summaries(df, columns, summary), columns, ["nulls", "null_pct"])


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Range, mean and exact median of numeric columns, in two scans or three.

    ``least``, ``greatest`` and ``middle`` are the same range and median as text in the
    column's own type, with all digits of long integers and decimals.
    """
    ranks = Ranks(df, list(columns or numeric_columns(df)))
    return _numeric_summary(ranks, {c: found[0] for c, found in ranks.percentiles([0.5]).items()})


def _numeric_summary(ranks: Ranks, medians: dict[str, object]) -> DataFrame:
    rows = []
    for c in ranks.columns:
        exact = [*ranks.range(c), medians[c]]
        low, high, median = (None if v is None else float(v) for v in exact)
        rows.append((c, low, high, ranks.mean(c), median, *(None if v is None else _digits(v) for v in exact)))
    return small_table(ranks.spark, rows, "column string, min_value double, max_value double, mean double, median double, least string, greatest string, middle string")


def _digits(value) -> str:
    """A number as text, a decimal without an exponent or zeros at its end."""
    if isinstance(value, Decimal):
        text = format(value, "f")
        return text.rstrip("0").rstrip(".") if "." in text else text
    return str(value)


def outliers(df: DataFrame, columns: Sequence[str] | None = None, sigmas: float = 3.0) -> DataFrame:
    """Values further than ``sigmas`` sample standard deviations from the mean."""
    columns = list(columns or numeric_columns(df))
    moments = _summaries(df, columns, lambda c: {"mean": F.avg(number_column(c)), "std": F.stddev_samp(number_column(c))})
    known = moments.select(F.struct(*[f"s{i}" for i in range(len(columns))]).alias("m")).scalar()

    def summary(c):
        x, m = number_column(c), known[f"s{columns.index(c)}"]
        far = (x < m["mean"] - sigmas * m["std"]) | (x > m["mean"] + sigmas * m["std"])
        return {"outliers": F.count_if(far)}

    return _per_column(_summaries(df, columns, summary), columns, ["outliers"])


def printed(value: Column) -> Column:
    """A short key of a value: a text of up to 32 bytes itself, a longer one by its SHA-256.

    A digest is a byte longer than any text that is its own key, so the two never meet.
    """
    digest = F.concat(F.lit(b"\x00"), F.unhex(F.sha2(value.cast("binary"), 256)))
    return F.when(F.octet_length(value) <= KEY_BYTES, value.cast("binary")).otherwise(digest)


def _key(df: DataFrame, name: str) -> Column:
    """What stands for a value where values are counted: a bounded key of a text, anything else itself."""
    return printed(present(df, name)) if isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType)) else present(df, name)


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or text_columns(df))
    return _per_column(
        _summaries(df, columns, lambda c: {"distinct_values": F.count_distinct(_key(df, c))}),
        columns, ["distinct_values"],
    )


def repeated_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose value already occurred in the column; all NULLs are one value."""
    columns = list(columns or df.columns)
    rows = F.count(F.lit(1))

    def summary(c):
        value = present(df, c)
        different = F.count_distinct(_key(df, c)) + F.max(F.when(value.isNull(), 1).otherwise(0))
        return {"duplicates": rows - different, "duplicate_pct": F.try_divide((rows - different) * 100.0, rows)}

    return _per_column(_summaries(df, columns, summary), columns, ["duplicates", "duplicate_pct"])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for all columns in one pass; NULL is no value."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(
        [], [f"`{c}`" for c in columns], "column", "value"
    )
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def column_modes(df: DataFrame, columns: Sequence[str] | None = None, limit: int = MODE_LIMIT) -> DataFrame:
    """Most frequent value of text columns with few values; ties go to the least value.

    A first scan estimates how many values a column has. One with many more than ``limit``
    is ruled out there, so only columns with few values are counted.
    """
    columns = list(columns or text_columns(df))
    estimates = df.agg(*[F.approx_count_distinct(_key(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first() if columns else []
    few = [c for c, n in zip(columns, estimates) if n <= SURE * limit]
    if not few:
        return df.sparkSession.createDataFrame([], "column string, mode string, occurrences long")
    counts = value_counts(df, few)
    best = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.min(F.struct((-F.col("n")).alias("minus"), F.col("value"))).alias("best"),
    )
    return best.where(F.col("distinct_values") <= limit).select(
        "column", F.col("best")["value"].alias("mode"), (-F.col("best")["minus"]).alias("occurrences")
    )


def top_values(df: DataFrame, columns: Sequence[str] | None = None, size: int = TOP_VALUES) -> DataFrame:
    """The most frequent values of text columns.

    Tasks keep ``size`` candidates per column before the shuffle (the rank
    filter is pushed below it), so a column of unique values stays cheap.
    """
    counts = value_counts(df, list(columns or text_columns(df)))
    window = W.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= size)


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins between the least and the greatest value."""
    columns = list(columns or numeric_columns(df))
    ends = _summaries(df, columns, lambda c: {"lo": F.min(number_column(c)), "hi": F.max(number_column(c))})
    known = ends.select(F.struct(*[f"s{i}" for i in range(len(columns))]).alias("m")).scalar()
    binned = []
    for i, c in enumerate(columns):
        x, lo, hi = number_column(c), known[f"s{i}"]["lo"], known[f"s{i}"]["hi"]
        place = F.floor(F.try_divide((x - lo) * bins, hi - lo))
        bin_no = F.when(hi == lo, 0).otherwise(F.least(place, F.lit(bins - 1)))
        binned.append(F.when(x.isNotNull(), bin_no.cast("int")).alias(c))
    long = df.select(*binned).unpivot([], [f"`{c}`" for c in columns], "column", "bin")
    return long.where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))


def box_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, fences at 1.5 times their distance, and the values beyond them."""
    columns = list(columns or numeric_columns(df))
    return _box_summary(df, exact_percentiles(df, columns, QUARTILES))  # two scans or three; the values outside take one more


def _box_summary(df: DataFrame, quartiles: dict[str, list]) -> DataFrame:
    columns = list(quartiles)

    def summary(c):
        x = number_column(c)
        q1, q2, q3 = (F.lit(q).cast("double") for q in quartiles[c])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        return {
            "q1": q1, "median": q2, "q3": q3, "low_fence": low, "high_fence": high,
            "outside": F.count_if((x < low) | (x > high)),
        }

    fields = ["q1", "median", "q3", "low_fence", "high_fence", "outside"]
    return _per_column(_summaries(df, columns, summary), columns, fields)


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns with both values present.

    A constant column has no correlation (NULL). After one scan for the means, a second
    one multiplies matrices: a task adds up the cross products of its rows, of those that
    have both values of a pair, and sends one row per pair. Pairs whose rows lie far from
    their columns' means take another scan around their own.
    """
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))

    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, r double")
    values = df.select(*[number_column(c).alias(f"c{i}") for i, c in enumerate(columns)])
    finite = [F.avg(F.when(F.abs(f"c{i}") < INFINITE, F.col(f"c{i}"))) for i in range(len(columns))]
    centres = [v or 0.0 for v in values.agg(*finite).first()]
    total = _added(values, _pair_sums(centres))
    # pairs whose rows lie far from the columns' means, as many rows lack the other value
    lost = [(r.i, r.j, centres[r.i] + r.x / r.n, centres[r.j] + r.y / r.n) for r in total.values() if r.n and (_spread(r.xx, r.x, r.n) < r.xx * LOST or _spread(r.yy, r.y, r.n) < r.yy * LOST)]
    around = {(i, j): (cx, cy) for i, j, cx, cy in lost}
    if lost:
        total |= _added(values, _sums_of_pairs(lost))
    rows = []
    for (i, j), t in sorted(total.items()):
        r = None
        if t.odd:
            r = float("nan")
        elif t.n:
            across, along = _spread(t.xx, t.x, t.n), _spread(t.yy, t.y, t.n)
            cx, cy = around.get((i, j), (centres[i], centres[j]))
            if across > t.n * (EQUAL * cx) ** 2 and along > t.n * (EQUAL * cy) ** 2:
                r = (t.xy - t.x * t.y / t.n) / across**0.5 / along**0.5
        rows.append((columns[i], columns[j], r))
    return small_table(df.sparkSession, rows, "column_a string, column_b string, r double")


def _spread(squares: float, total: float, n: int) -> float:
    return squares - total * total / n


def _added(values: DataFrame, sums) -> dict:
    """The tasks' sums added up: one row per pair of columns."""
    parts = values.mapInArrow(sums, "i int, j int, n long, x double, y double, xx double, yy double, xy double, odd long")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy", "odd")])
    return {(r.i, r.j): r for r in total.collect()}


def _sums_of_pairs(pairs: list[tuple]):
    """The same as ``_pair_sums`` for single pairs, each around a place of its own."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((len(pairs), 6))
        for batch in batches:
            columns = [np.array(c.to_numpy(zero_copy_only=False), np.float64) for c in batch.columns]
            for k, (i, j, cx, cy) in enumerate(pairs):
                both = np.isfinite(columns[i]) & np.isfinite(columns[j])
                x, y = columns[i][both] - cx, columns[j][both] - cy
                total[k] += [len(x), x.sum(), y.sum(), x @ x, y @ y, x @ y]
        places = [pa.array([p[k] for p in pairs], pa.int32()) for k in (0, 1)]
        sums = [pa.array(total[:, 0].astype(np.int64)), *(pa.array(c) for c in total[:, 1:].T), pa.array(np.zeros(len(pairs), np.int64))]
        yield pa.RecordBatch.from_arrays([*places, *sums], ["i", "j", "n", "x", "y", "xx", "yy", "xy", "odd"])

    return run


def _pair_sums(centres: list[float]):
    """Per task, counts, sums and products of every two columns over rows that have both.

    Values are taken from the columns' means, so that large values lose no digits. Rows
    with an infinite value in a pair are counted in ``odd``.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        size = len(centres)
        total = np.zeros((6, size, size))
        odd = np.zeros((size, size))
        for batch in batches:
            x = np.stack([np.array(c.to_numpy(zero_copy_only=False), np.float64) for c in batch.columns], axis=1)
            there = ~np.isnan(x)
            usual = np.isfinite(x)
            x = np.where(usual, x - centres, 0.0)
            m = usual.astype(np.float64)
            square = x * x
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x])
            if (there & ~usual).any():
                strange, any_ = (there & ~usual).astype(np.float64), there.astype(np.float64)
                odd += strange.T @ any_ + any_.T @ strange
        i, j = np.triu_indices(size, 1)
        arrays = [i.astype(np.int32), j.astype(np.int32), total[0][i, j].astype(np.int64), *(t[i, j] for t in total[1:]), odd[i, j].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["i", "j", "n", "x", "y", "xx", "yy", "xy", "odd"])

    return run


def table_totals(df: DataFrame) -> DataFrame:
    missing = F.lit(0).cast("long")
    for c in df.columns:
        missing = missing + (F.count(F.lit(1)) - F.count(present(df, c)))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        missing.alias("missing_values"),
    )


def data_size(df: DataFrame) -> DataFrame:
    """Bytes of data per column: text by its length, other types by their width."""

    def summary(c):
        kind = df.schema[c].dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)).cast("long")
        elif isinstance(kind, T.ArrayType):
            width = WIDTHS.get(type(kind.elementType), 8)
            size = F.coalesce(F.sum(F.size(F.col(f"`{c}`"))), F.lit(0)).cast("long") * width
        else:
            size = F.count(F.lit(1)) * WIDTHS.get(type(kind), 8)
        return {"bytes": size}

    return _per_column(_summaries(df, df.columns, summary), df.columns, ["bytes"])


def row_print(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a row's values; rows have one print if their values are the same, null for null and NaN for NaN.

    Each value is preceded by its length, so that no two rows run together.
    """
    parts = []
    for c in columns:
        value, kind = F.col(f"`{c}`"), df.schema[c].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            text = (value + F.lit(0.0).cast(kind)).cast("string")  # both zeros are one
        elif isinstance(kind, T.BinaryType):
            text = F.hex(value)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            text = F.when(value.isNotNull(), F.to_json(F.struct(value), {"ignoreNullFields": "false"}))
        else:
            text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256)) if parts else F.lit(b"")


def quality_score(df: DataFrame, exclude: Sequence[str] = ("id",)) -> DataFrame:
    """Completeness, uniqueness and their mean, with a traffic light.

    The table is read once: a task makes of each row the SHA-256 of its values and the
    number of its nulls, and only those are folded and shuffled.
    """
    columns = [c for c in df.columns if c not in exclude]
    nulls = F.lit(0).cast("long")
    for c in columns:
        nulls = nulls + present(df, c).isNull().cast("long")
    folded = df.select(row_print(df, columns).alias("_print"), nulls.alias("_nulls")).groupBy("_print")
    folded = folded.agg(F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"))
    sums = folded.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("different"), F.sum("_nulls").alias("nulls"))
    cells = F.col("rows") * len(columns)
    completeness = 100 - F.try_divide(F.col("nulls") * 100.0, cells)
    uniqueness = 100 - F.try_divide((F.col("rows") - F.col("different")) * 100.0, F.col("rows"))
    overall = (completeness + uniqueness) / 2
    light = F.when(overall >= 80, "green").when(overall >= 60, "yellow").otherwise("red")
    return sums.select(
        completeness.alias("completeness"), uniqueness.alias("uniqueness"),
        overall.alias("overall"), light.alias("light"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Everything about every column as ``column, metric, value, text``.

    ``value`` is a number. Four metrics have a ``text`` to go with it: ``mode`` and
    ``top_value``, whose value is how often the text occurs; ``bin``, the number of a
    histogram's bin and the values in it; ``correlation``, the other column of the pair. A
    fixed number of passes, whatever the number of columns: ranges, means, medians and
    quartiles come from the same ones. A table without columns of a kind has no metrics of
    that kind.
    """
    numbers, texts = numeric_columns(df), text_columns(df)
    found, named = [column_nulls(df), repeated_values(df)], []
    if numbers:
        ranks = Ranks(df, numbers)
        quartiles = ranks.percentiles(QUARTILES)
        found.append(_numeric_summary(ranks, {c: q[1] for c, q in quartiles.items()}).drop("least", "greatest", "middle"))
        found += [outliers(df, numbers), _box_summary(df, {c: [None if v is None else float(v) for v in q] for c, q in quartiles.items()}).drop("median")]
        named.append(("bin", histogram(df, numbers), "column", "bin", "n"))
    if len(numbers) > 1:
        named.append(("correlation", correlation(df, numbers), "column_a", "column_b", "r"))
    if texts:
        found.append(distinct_values(df, texts))
        named.append(("mode", column_modes(df, texts), "column", "mode", "occurrences"))
        named.append(("top_value", top_values(df, texts), "column", "value", "n"))
    parts = []
    for one in found:
        metrics = [c for c in one.columns if c != "column"]
        wide = one.select("column", *[F.col(m).cast("double").alias(m) for m in metrics])
        parts.append(wide.unpivot("column", metrics, "metric", "value").withColumn("text", F.lit(None).cast("string")))
    for metric, one, column, text, value in named:
        parts.append(one.select(F.col(column).alias("column"), F.lit(metric).alias("metric"), F.col(value).cast("double").alias("value"), F.col(text).cast("string").alias("text")))
    return reduce(DataFrame.unionByName, parts)


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table, largest first."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
        )
        out = one if out is None else out.unionByName(one)
    return out.orderBy(F.desc("rows"), "table_name")


def table_stats_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.sum("rows").alias("total_rows"),
        F.avg("rows").alias("average_rows"),
    )
