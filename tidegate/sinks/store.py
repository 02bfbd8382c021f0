"""Where a load keeps its tables: Parquet folders, one subfolder per run.

Every sink of a run writes its own ``run=<n>`` folder. A run that died half-way is
done again under the same number, after all folders of that number are removed. A run counts
once ``processed_files`` has its rows, which are written last; readers ignore
anything newer.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import small_table

PROCESSED = "processed_files"
SCHEMAS = "schema_registry"
BAD_FILES = "quarantine_files"
BAD_ROWS = "quarantine_rows"
AUDIT = "file_audit"
RUNS = "run_summary"
NOTES = "file_notes"
LAST_IDS = "last_ids"

SCHEMA_OF = {
    PROCESSED: "file string, status string, processed_at timestamp",
    SCHEMAS: "table_name string, schema_key string, columns array<struct<name:string,type:string,varchar_len:int>>, first_file string",
    BAD_FILES: "file string, status string, reason string, pos long, payload string",
    BAD_ROWS: "file string, ordinal long, row_number long, error_column string, expected string, error string, payload string",
    AUDIT: "file string, status string, columns long, rows_in long, duplicates_removed long, nulls long, rows_staged long, rows_loaded long, rows_bad long",
    LAST_IDS: "last_id long",
    NOTES: "file string, first_errors array<string>, samples map<string,array<string>>",
    RUNS: "files_seen long, files_loaded long, files_mismatched long, files_unreadable long, rows_loaded long, rows_bad long, seconds double",
}


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str, run: int | None = None) -> str:
        return f"{self.root}/{name}" if run is None else f"{self.root}/{name}/run={run}"

    def write(self, df: DataFrame, name: str, run: int) -> None:
        df.write.mode("overwrite").parquet(self.path(name, run))

    def remove(self, name: str, run: int) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name, run))
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def remove_all(self, name: str) -> None:
        """Remove a whole table."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def discard(self, run: int) -> None:
        """Remove what a run that died has left under this number, in whatever table.

        The run that takes the number over may write other tables, or none.
        """
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/run={run}")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for left in system.globStatus(root) or []:
            system.delete(left.getPath(), True)

    def read(self, name: str, schema: str) -> DataFrame:
        """All rows of a table with their ``run``; empty if nothing was written."""
        try:
            return self.spark.read.schema(f"{schema}, run int").parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return small_table(self.spark, [], f"{schema}, run int")

    def rows(self, name: str, schema: str) -> DataFrame:
        """The rows of finished runs without their run, so that any column may be called so."""
        folders = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/run=*")
        system = folders.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath().toString() for f in system.globStatus(folders) or []]
        last = self.last_run()
        finished = [p for p in found if int(p.rsplit("=", 1)[1]) <= last]
        return self.spark.read.schema(schema).parquet(*finished) if finished else small_table(self.spark, [], schema)

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.text(self.path(name))
            return True
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def last_run(self) -> int:
        """Number of the last finished run, 0 if there is none."""
        return self.control(PROCESSED).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]

    def control(self, name: str) -> DataFrame:
        return self.read(name, SCHEMA_OF[name])

    def finished(self, name: str, schema: str | None = None) -> DataFrame:
        """The rows of finished runs."""
        return self.read(name, schema or SCHEMA_OF[name]).where(F.col("run") <= self.last_run())
