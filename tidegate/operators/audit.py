"""Per-file and per-run counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.clean import nulls_in_row


def transform_audit(deduped: DataFrame, file: str, columns: Sequence[str]) -> DataFrame:
    """Rows in, duplicates removed, nulls left and rows staged, per file.

    Input rows are known from the copies counted while folding duplicates.
    """
    return deduped.groupBy(file).agg(
        F.sum("copies").alias("rows_in"),
        F.lit(len(columns)).cast("long").alias("columns"),
        F.sum(F.col("copies") - 1).alias("duplicates_removed"),
        F.sum(nulls_in_row(columns)).alias("nulls"),
        F.count(F.lit(1)).alias("rows_staged"),
    )


def load_audit(checked: DataFrame, file: str, good: Column) -> DataFrame:
    return checked.groupBy(file).agg(
        F.count_if(good).alias("rows_loaded"), F.count_if(~good).alias("rows_bad")
    )


def run_summary(audit: DataFrame, status: str = "status") -> DataFrame:
    """Totals of one run over its files."""
    return audit.agg(
        F.count(F.lit(1)).alias("files_seen"),
        F.count_if(F.col(status) == "loaded").alias("files_loaded"),
        F.count_if(F.col(status) == "schema_mismatch").alias("files_mismatched"),
        F.count_if(~F.col(status).isin("loaded", "schema_mismatch")).alias("files_unreadable"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("long").alias("rows_loaded"),
        F.coalesce(F.sum("rows_bad"), F.lit(0)).cast("long").alias("rows_bad"),
    )


def backlog(files: DataFrame, processed: DataFrame, name: str = "file") -> DataFrame:
    """How many landed files there are, how many are done and how many remain."""
    done = processed.select(name).distinct().withColumn("_done", F.lit(True))
    return files.join(done, name, "left").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count("_done").alias("processed_files"),
        (F.count(F.lit(1)) - F.count("_done")).alias("remaining_files"),
    )
