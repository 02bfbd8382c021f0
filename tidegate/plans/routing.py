"""Loading files of any number of schemas, each schema into a table of its own.

A table's load is an ordinary one below the router's folder, with its own journal, ids and
quarantine. The router keeps which schema has which table: a schema that is new gets the
next number, in the order of the first files' names, and a known one keeps its table.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import gate
from tidegate.plans.ingest import Load, LoadConfig
from tidegate.session import settle, small_table, tune
from tidegate.sinks import store as st
from tidegate.sinks.store import Store
from tidegate.sources import files, listing

MAP = "schema_tables"
MAP_SCHEMA = "schema_key string, table_name string, first_file string"
# Files without a header that could be read.
UNREAD = "unread"


class Router:
    def __init__(self, spark: SparkSession, config: LoadConfig):
        self.spark = tune(spark)
        self.config = config
        self.store = Store(spark, config.warehouse)

    def tables(self) -> DataFrame:
        """``schema_key, table_name, first_file`` of every schema met so far."""
        return self.store.finished(MAP, MAP_SCHEMA).drop("run")

    def load(self, table: str) -> Load:
        """The load of one table."""
        return Load(self.spark, replace(self.config, warehouse=f"{self.store.root}/{table}", table=table))

    def run_all(self, listed: DataFrame | None = None) -> int:
        """Load everything pending, batch by batch; returns the number of files taken."""
        listed = settle(listing.list_files(self.spark, self.config.landing) if listed is None else listed)
        taken = 0
        while True:
            pending = files.pending_files(listed, self.store.control(st.PROCESSED))
            done = self.run_batch(pending.orderBy("file").limit(self.config.files_per_batch))
            taken += done
            if done < self.config.files_per_batch:
                return taken

    def run_batch(self, pending: DataFrame) -> int:
        """Load one capped batch, one table after another.

        A batch that died half-way is done again: the tables that were finished know their files.
        """
        pending = settle(pending)
        registry = settle(files.header_registry(pending).select("file", "schema_key", F.col("problem").isNotNull().alias("unread")))
        known = {r["schema_key"]: r["table_name"] for r in self.tables().collect()}  # one row per schema
        routed = gate.route_by_schema(registry.where("NOT unread"), known=len(known), keep=known)
        routed = settle(routed.select("file", "schema_key", "table_name").unionByName(registry.where("unread").select("file", "schema_key", F.lit(UNREAD).alias("table_name"))))
        count = routed.count()
        if not count:
            return 0
        run = self.store.last_run() + 1
        self.store.discard(run)
        for r in routed.select("table_name").distinct().orderBy("table_name").collect():  # one row per schema of the batch
            own = pending.join(F.broadcast(routed.where(F.col("table_name") == r["table_name"]).select("file")), "file", "left_semi")
            load = self.load(r["table_name"])
            load.run_batch(load.pending(own))
        new = routed.where(F.col("table_name") != UNREAD).groupBy("schema_key", "table_name").agg(F.min("file").alias("first_file"))
        if known:
            new = new.join(F.broadcast(small_table(self.spark, [(k,) for k in known], "schema_key string")), "schema_key", "left_anti")
        self.store.write(new.select("schema_key", "table_name", "first_file"), MAP, run)
        now = datetime.now(timezone.utc)
        done = routed.select("file", F.col("table_name").alias("status"), F.lit(now).cast("timestamp").alias("processed_at"))
        self.store.write(done.coalesce(1), st.PROCESSED, run)
        return count
