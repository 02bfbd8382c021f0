"""The loaded table in the catalog: hashed by id, one partition per run.

A run publishes its rows as a partition of its own, which is dropped first, so a run that
is repeated publishes once. Which runs count is for the load's journal to say; readers
leave other partitions out. Buckets run through all partitions, so tables hashed alike
join on their ids where they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.infer import spark_type
from tidegate.sources.tables import table_exists

BUCKETS = 3


class CatalogTable:
    def __init__(self, spark: SparkSession, name: str, location: str, buckets: int = BUCKETS):
        self.spark, self.name, self.location, self.buckets = spark, name, location, buckets

    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    def _run(self, columns) -> str:
        """The partition column, apart from the table's own."""
        name = "_run"
        while name in columns:
            name += "_"
        return name

    def create(self, types: Mapping[str, str], lineage: str) -> None:
        run = self._run([*types, lineage])
        columns = ["`id` BIGINT", *(f"`{c}` {spark_type(t).simpleString()}" for c, t in types.items()), f"`{lineage}` STRING", f"`{run}` INT"]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.name}` ({', '.join(columns)}) USING parquet PARTITIONED BY (`{run}`) "
            f"CLUSTERED BY (`id`) SORTED BY (`id`) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
        )

    def publish(self, rows: DataFrame, run: int) -> None:
        """Make the rows the run's partition."""
        column = self._run(rows.columns)
        self.spark.sql(f"ALTER TABLE `{self.name}` DROP IF EXISTS PARTITION (`{column}` = {run})")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{column}={run}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        rows.withColumn(column, F.lit(run)).write.insertInto(self.name)

    def rows(self, last_run: int) -> DataFrame:
        """The rows of runs that count."""
        table = self.spark.table(self.name)
        run = table.columns[-1]
        return table.where(F.col(f"`{run}`") <= last_run).drop(run)
