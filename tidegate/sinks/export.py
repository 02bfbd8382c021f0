"""Other ways to write a table: bucketed by id, or as CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.clean import fill_nulls
from tidegate.operators.infer import table_ddl

BUCKETS = 3
ERROR_FILE = "error_file"
# Quotes inside values are doubled, and blanks around them kept.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def create_table(spark: SparkSession, table: str, types: Mapping[str, str], buckets: int = BUCKETS) -> None:
    """Create a catalog table from inferred types, hashed by id."""
    spark.sql(table_ddl(table, dict(types), buckets))


def append_table(df: DataFrame, table: str) -> None:
    """Append rows by column name; the catalog table keeps its bucketing."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def export_csv(df: DataFrame, path: str, spell_nulls: bool = False) -> None:
    """The table as CSV files with a header, written in parallel."""
    out = fill_nulls(df) if spell_nulls else df
    out.write.mode("overwrite").options(**CSV).csv(path)


def export_errors(bad_rows: DataFrame, columns: list[str], path: str) -> None:
    """Quarantined rows as CSV, one folder ``error_<file>`` per source file, in the order of its rows.

    Rows are dealt out by ranges of file and row, so a folder has one part file, or a few if
    it spans ranges, and not one of each task.
    """
    fields = F.from_json("payload", ", ".join(f"`{c}` string" for c in columns))
    base = F.regexp_replace("file", r"\.[^.]*$", "")
    named = bad_rows.withColumn(ERROR_FILE, F.concat(F.lit("error_"), base))
    dealt = named.repartitionByRange(ERROR_FILE, "file", "row_number").sortWithinPartitions(ERROR_FILE, "file", "row_number")
    out = dealt.select(ERROR_FILE, fields.alias("row"), "error")
    out.select(ERROR_FILE, "row.*", "error").write.mode("overwrite").partitionBy(ERROR_FILE).options(**CSV).csv(path)
