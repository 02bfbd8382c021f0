"""Schema gate: which files fit the table, decided on the header registry.

The registry has one row per file with its column names; all decisions here are
expressions over that small table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.session import small_table

RESERVED = "id"


def schema_key(columns: Column) -> Column:
    """Order-insensitive identity of a schema: the sorted names joined by a bar."""
    return F.array_join(F.array_sort(columns), "|")


def main_schema(registry: DataFrame, file: str = "file", key: str = "schema_key") -> DataFrame:
    """The schema of the first file by name."""
    return registry.agg(F.min(file).alias("first_file"), F.min_by(key, file).alias("schema_key"))


def mismatch_reason(expected: Column, got: Column) -> Column:
    return F.concat(F.lit("Schema mismatch. Expected: "), expected, F.lit(", Got: "), got)


def judge_files(registry: DataFrame, main_key: Column, key: str = "schema_key", columns: str | None = None) -> DataFrame:
    """Add ``status`` and ``reason``: a file fits if its key equals the main key.

    ``main_key`` is a literal from the control table, or a scalar subquery.
    """
    got = F.col(key)
    status = F.when(got == main_key, "accepted").otherwise("schema_mismatch")
    reason = F.when(got != main_key, mismatch_reason(main_key, got))
    if columns:
        reserved = F.array_contains(columns, RESERVED)
        status = F.when(reserved, "reserved_column").otherwise(status)
        reason = F.when(reserved, F.lit(f"Reserved column: {RESERVED}")).otherwise(reason)
    return registry.withColumn("status", status).withColumn("reason", reason)


def route_by_schema(registry: DataFrame, file: str = "file", key: str = "schema_key", known: int = 0, keep: Mapping[str, str] | None = None) -> DataFrame:
    """One table per distinct schema, numbered from ``known`` on in the order schemas first appear.

    Schemas in ``keep`` have the table they had. Numbering runs over the distinct schemas,
    not over the files.
    """
    schemas = registry.groupBy(key).agg(F.min(file).alias("first_file"))
    kept = small_table(registry.sparkSession, list((keep or {}).items()), f"{key} string, kept string")
    schemas = schemas.join(F.broadcast(kept), key, "left")  # one row per schema on both sides
    number = F.row_number().over(W.partitionBy(F.col("kept").isNull()).orderBy("first_file")) + F.lit(known)
    tables = schemas.withColumn("table_name", F.coalesce("kept", F.concat(F.lit("tbl_"), number.cast("string")))).drop("kept")
    return registry.join(tables, key)
