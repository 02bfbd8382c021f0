"""Cleaning: equal values made equal, duplicate rows removed per file, null counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import numbers
from tidegate.functions.text import decode_null, fill_null, strip
from tidegate.operators.infer import column_facts, reading_kind
from tidegate.session import lookup, settle


def decode_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: decode_null(F.col(f"`{c}`")) for c in columns})


def fill_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text form for export. Typed tables never hold the filler text."""
    return df.withColumns({c: fill_null(F.col(f"`{c}`")) for c in columns or df.columns})


class Kinds:
    """How each column reads (int, float, bool, text), file by file.

    A column that reads alike in all files takes the type it reads as: numbers
    travel as numbers, and text columns cost nothing. Only a column that reads
    differently from file to file stays text and is looked up per row, in a
    table of one row per file.
    """

    def __init__(self, facts: DataFrame, file: str, columns: Sequence[str]):
        """``facts`` is a settled table of one row per file and column."""
        self.file = file
        kinds = facts.select(file, "column", reading_kind().alias("kind"))
        found = kinds.groupBy("column").agg(F.collect_set("kind").alias("kinds")).collect()
        sets = {r["column"]: r["kinds"] for r in found}
        self.uniform = {c: sets[c][0] for c in columns if len(sets.get(c, ())) == 1}
        self.mixed = [c for c in columns if len(sets.get(c, ())) > 1]
        self.per_file = kinds.groupBy(file).agg(
            *[F.max(F.when(F.col("column") == c, F.col("kind"))).alias(f"_kind_{c}") for c in self.mixed]
        ) if self.mixed else None

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace every value by what it reads as."""
        if self.mixed:
            df = df.join(lookup(self.per_file), self.file)
        values = {c: _READERS[k](F.col(f"`{c}`")) for c, k in self.uniform.items() if k != "text"}
        values |= {c: read_text(F.col(f"`{c}`"), F.col(f"`_kind_{c}`")) for c in self.mixed}
        return df.withColumns(values).drop(*[f"_kind_{c}" for c in self.mixed])


def reading_kinds(df: DataFrame, file: str, columns: Sequence[str]) -> Kinds:
    return Kinds(settle(column_facts(df, columns, [file])), file, columns)


_READERS = {
    "int": lambda value: strip(value).try_cast("bigint"),
    "float": lambda value: numbers.reading_number(strip(value)),
    "bool": lambda value: value.try_cast("boolean"),
}


def double_text(x: Column) -> Column:
    """Whole numbers as digits, others as Spark prints doubles."""
    whole = F.when((x % 1 == 0) & (F.abs(x) < float(2**53)), x.try_cast("bigint"))
    return F.coalesce(whole.cast("string"), x.cast("string"))


def number_text(value: Column) -> Column:
    """One text per number, the same whether its column travels as numbers or as text."""
    return double_text(numbers.reading_value(value))


def value_text(df: DataFrame, column: str) -> Column:
    """A column's values as text again."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if kind == T.DoubleType():
        return double_text(value)
    return F.initcap(value.cast("string")) if kind == T.BooleanType() else value.cast("string")


def read_text(value: Column, kind: Column) -> Column:
    """The value's text once its column is read as ``kind``.

    Equal values get equal text: ``7``, ``007`` and `` 7 `` in a numeric column,
    ``1`` and ``1.0`` as well. Text columns keep every blank.
    """
    return (
        F.when(kind == "text", value)
        .when(kind == "bool", F.initcap(value))
        .when(kind == "int", numbers.long_value(strip(value)).cast("string"))
        .when(kind == "float", number_text(value))
    )


def as_written(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns as text again."""
    return [value_text(df, c).alias(c) for c in columns]


def dedupe_rows(df: DataFrame, file: str, pos: str, columns: Sequence[str]) -> DataFrame:
    """One row per distinct row of a file, at its first position, with its copies.

    The same row in two files is kept in both. A plain hash aggregate on
    ``(file, all columns)`` keeping the least position: tasks fold their copies
    before the shuffle, so a row repeated millions of times costs one row per
    task, and the position is a single long, which keeps the hash path.
    """
    keys = [F.col(f"`{c}`") for c in columns]
    return df.groupBy(F.col(file), *keys).agg(
        F.min(pos).alias(pos), F.count(F.lit(1)).alias("copies")
    )


def null_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, column, nulls)`` in one pass."""
    sums = df.groupBy(*keys).agg(
        *[(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(c) for c in columns]
    )
    return sums.unpivot(list(keys), [f"`{c}`" for c in columns], "column", "nulls")


def nulls_in_row(columns: Sequence[str]) -> Column:
    total = F.lit(0).cast("long")
    for c in columns:
        total = total + F.col(f"`{c}`").isNull().cast("long")
    return total


def column_samples(df: DataFrame, file: str, ordinal: str, columns: Sequence[str], size: int = 3) -> DataFrame:
    """The first values of every column, per file, in row order.

    Only rows numbered up to ``size`` are looked at, so a group holds ``size`` values.
    """
    first = df.where(F.col(ordinal) <= size).select(file, ordinal, *[f"`{c}`" for c in columns])
    long = first.select(file, ordinal, *as_written(first, columns)).unpivot(
        [file, ordinal], [f"`{c}`" for c in columns], "column", "value"
    )
    entry = F.struct(F.col(ordinal), F.coalesce("value", F.lit("NULL")).alias("value"))
    return long.groupBy(file, "column").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["value"]), "|").alias("samples")
    )
