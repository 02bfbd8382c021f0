"""Tables as they are: which exist, their columns, how many rows, a first look."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREVIEW_ROWS = 10_000

# Spark's type names -> the names shown.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def type_name(data_type: T.DataType) -> str:
    return TYPE_NAMES.get(data_type.simpleString(), data_type.simpleString().upper())


def list_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def preview(df: DataFrame, order: str | None = None, rows: int = PREVIEW_ROWS) -> DataFrame:
    """At most ``rows`` rows; with ``order`` the same ones every time."""
    return (df.orderBy(order) if order else df).limit(rows)


def describe(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with how many values it has."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(df.schema.fields)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
            F.lit(type_name(f.dataType)).alias("type"), F.col(f"n{i}").alias("filled"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def value_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """``typeof`` of columns over all rows, as ``(column, type, n)``."""
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    types = F.array(*[F.struct(F.lit(c).alias("column"), names[F.typeof(F.col(f"`{c}`"))].alias("type")) for c in columns])
    return df.select(F.inline(types)).groupBy("column", "type").agg(F.count(F.lit(1)).alias("n"))
