"""Row checks against the table's types, and the typed values themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import dates, numbers
from tidegate.functions.text import strip
from tidegate.operators.clean import as_written, value_text
from tidegate.operators.infer import declared_length, spark_type

FAULT = "_fault"


def expected_kind(sql_type: str) -> str | None:
    """Word used in messages for what a column accepts; None if it takes any text."""
    if sql_type in numbers.INTEGER_TYPES:
        return "INT"
    if sql_type == "DOUBLE":
        return "FLOAT"
    if sql_type in ("DATE", "DATETIME"):
        return "DATE"
    if sql_type == "BOOLEAN":
        return "BOOLEAN"
    return None


def parsed_value(text: Column, sql_type: str) -> Column:
    """A stripped text as the column's type, NULL where it does not convert."""
    if sql_type in numbers.INTEGER_TYPES:
        return numbers.integer_number(text, sql_type)
    if sql_type == "DOUBLE":
        return numbers.vote_number(text)
    if sql_type == "DATE":
        return dates.date_value(text)
    if sql_type == "DATETIME":
        return dates.timestamp_value(text)
    return text.try_cast("boolean")


def typed_values(df: DataFrame, types: Mapping[str, str], prefix: str = "") -> DataFrame:
    """Add every column under its table type, NULL where a value does not convert.

    Columns that were read as numbers or booleans convert by a plain cast; only
    text is parsed. Stripping is a step of its own so that it happens once.
    """
    texts, values = {}, {}
    for c, sql_type in types.items():
        value, source, target = F.col(f"`{c}`"), df.schema[c].dataType, spark_type(sql_type)
        text = value_text(df, c)
        if expected_kind(sql_type) is None:
            values[prefix + c] = text
        elif source == target:
            values[prefix + c] = value
        elif isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
            values[prefix + c] = value.try_cast(target.simpleString())
        else:
            texts[f"_text_{c}"] = strip(text)
            values[prefix + c] = parsed_value(F.col(f"`_text_{c}`"), sql_type)
    return df.withColumns(texts).withColumns(values).drop(*texts)


def column_checks(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> dict[str, tuple[str, Column]]:
    """For each column that can reject a value: what it expects and when it rejects.

    The conditions refer to the typed values under the prefix ``_value_``. NULL
    fits every column, any text fits text and boolean columns; what is no boolean has
    no typed value. ``strict`` holds text to its declared length, and booleans to be some.
    """
    checks = {}
    for c, sql_type in types.items():
        value, kind = F.col(f"`{c}`"), expected_kind(sql_type)
        if kind is not None and (strict or kind != "BOOLEAN"):
            checks[c] = (kind, value.isNotNull() & F.col(f"`_value_{c}`").isNull())
        elif strict and (longest := declared_length(sql_type)) is not None:
            checks[c] = (sql_type, F.char_length(value.cast("string")) > longest)
    return checks


def check_rows(df: DataFrame, types: Mapping[str, str], order: Sequence[str] | None = None, strict: bool = False, places: str | None = None, labels: Mapping[str, str] | None = None) -> DataFrame:
    """Add the first fault of every row, ``(column, expected, value)`` or NULL.

    First means first in the column order of the row's file: ``order`` if all
    files share one, else ``places``, a column with the place of every column of
    ``types`` in the row's own file. Each column is checked once. ``labels`` are the
    names that faults call the columns by.
    """
    checks = column_checks(df, types, strict)
    if not checks:
        return df.withColumn(FAULT, F.lit(None).cast("struct<column:string,expected:string,value:string>"))
    names = [c for c in (order or types) if c in checks]
    if places is None:
        number = F.when(F.lit(False), F.lit(0))
        for i, c in enumerate(names):
            number = number.when(checks[c][1], F.lit(i))
    else:
        at = list(types)
        found = [
            F.when(checks[c][1], F.struct(F.get(places, F.lit(at.index(c))).alias("place"), F.lit(i).alias("no")))
            for i, c in enumerate(names)
        ]
        number = F.array_min(F.array_compact(F.array(*found)))["no"]
    no = F.col("_fault_no")
    value = F.when(F.lit(False), F.lit(""))
    for i, text in enumerate(as_written(df, names)):
        value = value.when(no == i, text)
    fault = F.struct(
        F.get(F.array(*[F.lit((labels or {}).get(c, c)) for c in names]), no).alias("column"),
        F.get(F.array(*[F.lit(checks[c][0]) for c in names]), no).alias("expected"),
        value.alias("value"),
    )
    judged = typed_values(df, {c: types[c] for c in names}, "_value_").withColumn("_fault_no", number)
    return judged.withColumn(FAULT, F.when(no.isNotNull(), fault)).drop("_fault_no", *[f"_value_{c}" for c in names])


def fault_message(fault: Column | None = None) -> Column:
    fault = F.col(FAULT) if fault is None else fault
    text = F.concat(
        F.lit("Column '"), fault["column"], F.lit("' expects "), fault["expected"],
        F.lit(", got '"), fault["value"], F.lit("'"),
    )
    return F.when(fault.isNotNull(), text)


def good_rows(checked: DataFrame, types: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows without a fault, with typed values."""
    good = checked.where(F.col(FAULT).isNull())
    return typed_values(good, types).select(*keep, *[F.col(f"`{c}`") for c in types])


def bad_rows(checked: DataFrame, types: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Faulty rows with their values as written and the reason."""
    return checked.where(F.col(FAULT).isNotNull()).select(
        *keep,
        *as_written(checked, list(types)),
        F.col(FAULT)["column"].alias("error_column"),
        F.col(FAULT)["expected"].alias("expected"),
        fault_message().alias("error"),
    )


def error_sample(bad: DataFrame, file: str, ordinal: str, size: int = 5) -> DataFrame:
    """The first errors of every file.

    The rank filter lets Spark keep only ``size`` rows per file and task before
    the shuffle, so one file full of errors does not land in one task.
    """
    window = W.partitionBy(file).orderBy(ordinal)
    return bad.withColumn("error_no", F.row_number().over(window)).where(F.col("error_no") <= size)


def error_breakdown(bad: DataFrame, file: str) -> DataFrame:
    return bad.groupBy(file, "error_column", "expected").agg(F.count(F.lit(1)).alias("errors"))
