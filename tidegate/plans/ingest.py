"""A whole load: landed CSV files into a typed table, with everything that went wrong.

Files are taken in ascending name order, a capped number at a time, so every
per-file table in here has a known bound. Within a batch all files are handled
by the same few Spark jobs:

1. headers: tasks open their files and read the first records;
2. facts: one scan judges every column of every file and finds broken files;
3. staging: one scan reads, folds duplicates and ranks rows; written as Parquet;
4. tallies: one row per chunk of staged rows, from which ids follow;
5. sinks: good rows, bad rows, mismatching files, audits, and last the checkpoint.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import audit, clean, gate, ids, infer, validate
from tidegate.session import lookup, settle, shuffle_sized_for, small_table, steady_splits, together, tune
from tidegate.sinks import export
from tidegate.sinks import store as st
from tidegate.sinks.catalog import CatalogTable
from tidegate.sinks.store import Store
from tidegate.sources import csv, files, listing
from tidegate.sources.csv import Layout

LOADED, MISMATCH, UNREADABLE, RESERVED = "loaded", "schema_mismatch", "unreadable", "reserved_column"
STAGED, TALLIES = "staged", "chunk_tallies"
FLAGS = ["overlong", "open_quote"]
# Errors and values that are kept of each file.
ERRORS, SAMPLES = 5, 3
# How reasons begin of files whose lines cannot be read either.
GONE = "cannot be read"
UNREACHABLE = (GONE, files.UNADDRESSABLE, "FileNotFoundError")


@dataclass(frozen=True)
class LoadConfig:
    landing: str
    warehouse: str
    table: str = "main_data_table"
    files_per_batch: int = 2000
    chunk_span: int = csv.CHUNK_SPAN
    strict: bool = False
    # The table's name in the catalog, hashed by id; without, it is a folder of the warehouse.
    catalog: str | None = None
    # A folder for the bad rows as CSV, a folder per run and source file.
    error_files: str | None = None


@dataclass(frozen=True)
class MainSchema:
    """Columns and types of the table, fixed by the first file that loads."""

    key: str
    columns: tuple[str, ...]
    types: dict[str, str] | None
    first_file: str

    @property
    def inner(self) -> dict[str, str]:
        """Names of the columns while rows are worked on, so that a file may call its columns anything."""
        return {c: f"_d{i}" for i, c in enumerate(self.columns)}

    @property
    def lineage(self) -> str:
        """The column that names a row's file, apart from the file's own."""
        name = "_src_file"
        while name in self.columns:
            name += "_"
        return name

    def inside(self, layouts: list[Layout]) -> list[Layout]:
        names = self.inner
        return [replace(x, columns=tuple(names[c] for c in x.columns)) for x in layouts]


@dataclass(frozen=True)
class Judged:
    layout: Layout | None
    file: str
    status: str
    reason: str | None = None


class Load:
    def __init__(self, spark: SparkSession, config: LoadConfig):
        self.spark = tune(spark)
        steady_splits(spark)
        self.config = config
        self.store = Store(spark, config.warehouse)
        self.catalog = config.catalog and CatalogTable(spark, config.catalog, self.store.path(config.table))

    # --- state across runs ------------------------------------------------------

    def pending(self, listed: DataFrame | None = None) -> DataFrame:
        """Files of the folder, or of a listing of it, that are not checkpointed yet."""
        if listed is None:
            listed = listing.list_files(self.spark, self.config.landing)
        return files.pending_files(listed, self.store.control(st.PROCESSED))

    def registered_schema(self) -> MainSchema | None:
        """The registered schema; without types if its table has gone."""
        rows = self.store.finished(st.SCHEMAS).orderBy(F.desc("run")).limit(1).collect()
        if not rows:
            return None
        row = rows[0]
        types = {c["name"]: c["type"] for c in row["columns"]}
        gone = not self._table_exists()
        return MainSchema(row["schema_key"], tuple(types), None if gone else types, row["first_file"])

    def _table_exists(self) -> bool:
        return self.catalog.exists() if self.catalog else self.store.exists(self.config.table)

    def table(self) -> DataFrame:
        """The loaded rows of all finished runs."""
        schema = self.registered_schema()
        if schema is None or schema.types is None:
            raise ValueError("nothing has been loaded yet")
        if self.catalog:
            return self.catalog.rows(self.store.last_run())
        fields = [f"`{c}` {infer.spark_type(t).simpleString()}" for c, t in schema.types.items()]
        return self.store.rows(self.config.table, ", ".join(["id long", *fields, f"`{schema.lineage}` string"]))

    def last_id(self) -> int:
        """The greatest id given so far, from one row per finished run; 0 if the table has gone."""
        if not self._table_exists():
            return 0
        return self.store.finished(st.LAST_IDS).agg(F.coalesce(F.max("last_id"), F.lit(0))).first()[0]

    # --- a run ------------------------------------------------------------------

    def run_all(self, listed: DataFrame | None = None) -> int:
        """Load everything pending, batch by batch; returns the number of files taken.

        The folder is listed once; what lands meanwhile is for the next run.
        """
        listed = settle(listing.list_files(self.spark, self.config.landing) if listed is None else listed)
        taken = 0
        while True:
            names = self.pending(listed).orderBy("file").limit(self.config.files_per_batch)
            done = self.run_batch(names)
            taken += done
            if done < self.config.files_per_batch:
                return taken

    def run_batch(self, pending: DataFrame) -> int:
        """Load one capped batch of pending files."""
        started = time.time()
        registry = files.header_registry(pending).orderBy("file").collect()
        if registry:
            with shuffle_sized_for(self.spark, sum(r["length"] for r in registry)):
                self._load_batch(registry, started)
        return len(registry)

    def _load_batch(self, registry: list, started: float) -> None:
        run = self.store.last_run() + 1
        self.store.discard(run)
        known = self.registered_schema()
        judged, main, facts, other_facts = self._judge(registry, known)
        good = [j.layout for j in judged if j.status == LOADED]
        paths = {r["file"]: r["path"] for r in registry}
        loaded, _ = together(
            lambda: self._stage_and_load(run, good, main, facts) if good else None,
            lambda: self._quarantine_files(run, judged, paths, other_facts),
        )
        if good:
            main = replace(main, types=loaded)
        self._audit(run, judged, bool(good), started)
        if good and (known is None or known.types is None):
            self._register(run, main)
        self._checkpoint(run, judged)
        self.store.remove(STAGED, run)
        self.store.remove(TALLIES, run)

    # --- which files fit --------------------------------------------------------

    def _judge(self, registry: list, main: MainSchema | None):
        """Status of every file, the main schema, and the facts of fitting and other files.

        The first readable file defines a missing schema. Whether a file is
        readable to its end shows when it is scanned, so files found broken are
        struck out, files with line breaks inside quotes are scanned again as
        whole records, and the gate is run anew until nothing changes.
        """
        broken = {r["file"]: r["problem"] for r in registry if r["problem"]}
        multiline = {r["file"] for r in registry if r["multiline"]}
        self._isolated(registry, broken, lambda: self._read_lines([self._layout(r, multiline) for r in registry if r["file"] not in broken], multiline, broken))
        scanned: set[str] = set()
        facts: list[DataFrame] = []
        other_facts: list[DataFrame] = []
        defined = main
        while True:
            readable = [r for r in registry if r["file"] not in broken]
            if main is None:
                first = next((r for r in readable if gate.RESERVED not in r["columns"]), None)
                new = first and MainSchema(first["schema_key"], tuple(first["columns"]), None, first["file"])
                if new != defined:
                    defined, scanned, facts, other_facts = new, set(), [], []
            judged = [Judged(None, f, UNREADABLE, why) for f, why in broken.items()]
            for r in readable:
                judged.append(Judged(self._layout(r, multiline), r["file"], *self._status(r, defined)))
            fitting = [j.layout for j in judged if j.status == LOADED and j.file not in scanned]
            others = [j.layout for j in judged if j.status in (MISMATCH, RESERVED) and j.file not in scanned]
            if not fitting and not others:
                return judged, defined, facts, other_facts
            if fitting:
                fitting = defined.inside(fitting)
            groups = [(fitting, defined and list(defined.inner.values()), facts), (others, None, other_facts)]
            groups = [g for g in groups if g[0]]
            struck = [dict(broken) for _ in groups]  # each scan strikes out files of its own
            scans = [self._scan_job(registry, own, layouts, wanted) for (layouts, wanted, _), own in zip(groups, struck)]
            for (layouts, _, into), own, found in zip(groups, struck, together(*scans)):
                broken |= own
                if found is None:
                    continue
                refused = self._refused(found, multiline, broken)
                into.append(found.where(~F.col("file").isin(refused)) if refused else found)
                scanned |= {x.file for x in layouts} - set(refused)

    def _scan_job(self, registry: list, broken: dict, layouts: list[Layout], wanted: list[str] | None):
        """The scan of some files for their facts, as a job for ``together``."""
        return lambda: self._isolated(registry, broken, lambda: self._facts([x for x in layouts if x.file not in broken], wanted))

    def _facts(self, layouts: list[Layout], wanted: list[str] | None) -> DataFrame | None:
        if not layouts:
            return None
        rows = csv.scan(self.spark, layouts, wanted)
        return settle(infer.column_facts(rows, wanted or csv.positional(rows), ["file"], FLAGS))

    @staticmethod
    def _isolated(registry: list, broken: dict, job):
        """Run a job over the batch's files; one that its reader fails on is struck out, and the others are read again.

        A file may go away or turn unreadable after it was listed. The reader's error names it.
        """
        while True:
            try:
                return job()
            except (Py4JJavaError, PySparkException) as error:
                text = unquote(str(error))
                named = [r for r in registry if r["file"] not in broken and f"/{r['file']}" in text]
                if not named:
                    raise
                worst = max(named, key=lambda r: len(r["file"]))  # a name may end another
                kind = error.getCondition() if isinstance(error, PySparkException) else None
                broken[worst["file"]] = f"{GONE}: {kind or type(error).__name__}"

    @staticmethod
    def _layout(r, multiline: set) -> Layout:
        return Layout(r["path"], r["file"], tuple(r["columns"]), r["first_width"], r["file"] in multiline)

    def _read_lines(self, layouts: list[Layout], multiline: set, broken: dict) -> None:
        """Strike out files by their raw lines, and find those with line breaks inside quotes."""
        if not layouts:
            return
        # At most one row per file of the batch, whose number is capped.
        for r in csv.line_facts(self.spark, layouts).collect():
            if r["bad_bytes"]:
                broken[r["file"]] = files.NOT_TEXT
            elif r["open_quote"]:
                multiline.add(r["file"])
            elif r["overlong"] and r["file"] not in multiline:
                broken[r["file"]] = csv.file_verdict(0, 1, False)

    @staticmethod
    def _status(r, defined: MainSchema) -> tuple[str, str | None]:
        if gate.RESERVED in r["columns"]:
            return RESERVED, f"Reserved column: {gate.RESERVED}"
        if defined is not None and r["schema_key"] == defined.key:
            return LOADED, None
        expected = "" if defined is None else defined.key
        return MISMATCH, f"Schema mismatch. Expected: {expected}, Got: {r['schema_key']}"

    @staticmethod
    def _refused(flags: DataFrame, multiline: set, broken: dict) -> list[str]:
        """Files that cannot be used as scanned: broken, or to be read as whole records."""
        per_file = flags.groupBy("file").agg(*[F.max(f).alias(f) for f in FLAGS])
        refused = []
        # At most one row per file of the batch, whose number is capped.
        for r in per_file.where("overlong > 0 OR open_quote > 0").collect():
            verdict = csv.file_verdict(r["open_quote"], r["overlong"], r["file"] in multiline)
            if verdict == "multiline":
                multiline.add(r["file"])
            else:
                broken[r["file"]] = verdict
            refused.append(r["file"])
        return refused

    # --- rows -------------------------------------------------------------------

    def _rows(self, layouts: list[Layout], columns: list[str], kinds: clean.Kinds) -> DataFrame:
        """Rows as read, one per distinct row of a file."""
        rows = kinds.apply(csv.scan(self.spark, layouts, columns))
        return clean.dedupe_rows(rows, "file", "pos", columns)

    def _stage(self, run: int, layouts: list[Layout], rows: DataFrame, types: dict[str, str], labels: dict[str, str]) -> DataFrame:
        """Rows with their rank in their chunk and their first fault, on disk.

        Each row is judged once, here. Counting and quarantine then read the few
        columns they need.
        """
        ranked = ids.rank_in_chunks(rows, "file", "pos", self.config.chunk_span)
        staged = self._check(ranked, layouts, types, labels).withColumn("_nulls", clean.nulls_in_row(list(types)))
        self.store.write(staged, STAGED, run)
        return self.spark.read.parquet(self.store.path(STAGED, run))

    def _stage_and_load(self, run: int, layouts: list[Layout], main: MainSchema, facts: list[DataFrame]) -> dict[str, str]:
        names = main.inner
        labels = {inner: c for c, inner in names.items()}
        layouts = main.inside(layouts)
        columns = list(labels)
        kinds = clean.Kinds(reduce(DataFrame.unionByName, facts), "file", columns)
        types = main.types and {names[c]: t for c, t in main.types.items()}
        if types is None:
            first = min(layouts, key=lambda x: x.file)
            types = infer.collect_types(infer.infer_schema(self._rows([first], columns, kinds), columns))
        staged = self._stage(run, layouts, self._rows(layouts, columns, kinds), types, labels)
        good = F.col(validate.FAULT).isNull()
        extras = F.sum("copies").alias("rows_in"), F.sum("_nulls").alias("nulls"), F.count_if(good).alias("good_rows")
        self.store.write(ids.tally_chunks(staged, "file", good, *extras), TALLIES, run)
        tallies = self.spark.read.parquet(self.store.path(TALLIES, run))
        before = self.last_id()
        chunks = ids.chunk_offsets(tallies, "file", before)
        last = F.max(F.col("id_base") + F.col("rows_before") + F.col("last_good"))
        reached = chunks.agg(F.coalesce(last, F.lit(before)).cast("long").alias("last_id"))
        offsets = lookup(chunks, tallies).drop("last_good")
        numbered = ids.apply_offsets(staged, offsets, "file")
        loaded = validate.good_rows(numbered, types, ["id", "file"])
        named = [F.col(inner).alias(c) for inner, c in labels.items()]
        rows = loaded.select("id", *named, F.col("file").alias(main.lineage))
        if self.catalog:
            self.catalog.create({c: types[inner] for inner, c in labels.items()}, main.lineage)
        notes = self._notes(run, numbered.where(F.col(ids.ORDINAL) <= SAMPLES), labels, offsets)
        together(
            lambda: self.catalog.publish(rows, run) if self.catalog else self.store.write(rows, self.config.table, run),
            lambda: self._write_bad_rows(self._bad_rows(layouts, labels, numbered.where(~good), tallies), notes, run),
            lambda: self.store.write(reached, st.LAST_IDS, run),
        )
        if self.config.error_files:
            bad = self.spark.read.schema(st.SCHEMA_OF[st.BAD_ROWS]).parquet(self.store.path(st.BAD_ROWS, run))
            export.export_errors(bad, list(labels.values()), f"{self.config.error_files.rstrip('/')}/run={run}")
        return {c: types[inner] for inner, c in labels.items()}

    def _notes(self, run: int, first: DataFrame, labels: dict[str, str], files_of: DataFrame) -> DataFrame:
        """The first values of every column of each file, as read, a null as ``NULL``."""
        values = F.struct(F.col(ids.ORDINAL).alias("at"), *[F.coalesce(clean.value_text(first, inner), F.lit("NULL")).alias(inner) for inner in labels])
        # SAMPLES rows per file at most
        rows = first.select("file", values.alias("row")).groupBy("file").agg(F.array_sort(F.collect_list("row")).alias("rows"))
        lists = [F.col("rows")[inner] for inner in labels]
        samples = F.map_from_arrays(F.array(*[F.lit(c) for c in labels.values()]), F.array(*lists))
        return files_of.select("file").distinct().join(rows, "file", "left").select("file", samples.alias("samples"))

    def _write_bad_rows(self, bad: DataFrame, samples: DataFrame, run: int) -> None:
        """Bad rows, and the first errors of each file beside its samples."""
        self.store.write(bad, st.BAD_ROWS, run)
        written = self.spark.read.schema(st.SCHEMA_OF[st.BAD_ROWS]).parquet(self.store.path(st.BAD_ROWS, run))
        first = validate.error_sample(written, "file", ids.ORDINAL, ERRORS).groupBy("file")
        errors = first.agg(F.transform(F.array_sort(F.collect_list(F.struct("error_no", "error"))), lambda e: e["error"]).alias("first_errors"))
        notes = samples.join(errors, "file", "left").select("file", F.coalesce("first_errors", F.array().cast("array<string>")).alias("first_errors"), "samples")
        self.store.write(notes, st.NOTES, run)

    def _bad_rows(self, layouts: list[Layout], labels: dict[str, str], faulty: DataFrame, tallies: DataFrame) -> DataFrame:
        """Bad rows with their values as the file has them.

        Rows are staged as what they read as. The few that are bad are looked up in a second
        scan of the same files, whose positions are those of the first one.
        """
        judged = faulty.select(
            "file",
            "pos",
            ids.ORDINAL,
            (F.col(ids.ORDINAL) + 1).alias("row_number"),
            F.col(validate.FAULT)["column"].alias("error_column"),
            F.col(validate.FAULT)["expected"].alias("expected"),
            validate.fault_message().alias("error"),
        )
        if not tallies.agg(F.sum(F.col("chunk_rows") - F.col("good_rows"))).first()[0]:
            return judged.drop("pos").withColumn("payload", F.lit(None).cast("string"))
        written = csv.scan(self.spark, layouts, list(labels))
        payload = F.to_json(F.struct(*[F.col(inner).alias(c) for inner, c in labels.items()]), {"ignoreNullFields": "false"})
        return written.select("file", "pos", payload.alias("payload")).join(lookup(settle(judged)), ["file", "pos"]).select(*judged.drop("pos").columns, "payload")

    def _check(self, rows: DataFrame, layouts: list[Layout], types: dict[str, str], labels: dict[str, str]) -> DataFrame:
        """Add the first fault in the column order of the row's own file."""
        strict = self.config.strict
        if len({layout.columns for layout in layouts}) == 1:
            return validate.check_rows(rows, types, layouts[0].columns, strict, labels=labels)
        listed = [(x.file, [x.columns.index(c) for c in types]) for x in layouts]
        # One row per file of the batch, whose number is capped.
        guide = F.broadcast(small_table(self.spark, listed, "file string, _places array<int>"))
        return validate.check_rows(rows.join(guide, "file"), types, strict=strict, places="_places", labels=labels).drop("_places")

    # --- books ------------------------------------------------------------------

    def _quarantine_files(self, run: int, judged: list[Judged], paths: dict[str, str], facts: list[DataFrame]) -> None:
        reasons = [(j.file, j.status, j.reason) for j in judged if j.status != LOADED]
        if not reasons:
            self.store.write(small_table(self.spark, [], st.SCHEMA_OF[st.BAD_FILES]), st.BAD_FILES, run)
            return
        parts = []
        mixed = [j.layout for j in judged if j.status in (MISMATCH, RESERVED)]
        if mixed:
            parts.append(self._mismatch_rows(mixed, reduce(DataFrame.unionByName, facts)))
        lines = [paths[j.file] for j in judged if j.status == UNREADABLE and not (j.reason or "").startswith(UNREACHABLE)]
        if lines:
            parts.append(csv.scan_lines(self.spark, lines).withColumnRenamed("line", "payload"))
        schema = "file string, status string, reason string"
        # One row per rejected file of the batch, whose number is capped.
        listed = small_table(self.spark, reasons, schema)
        rows = small_table(self.spark, [], "file string, pos long, payload string")
        for part in parts:
            rows = rows.unionByName(part)
        # A rejected file without rows still leaves its reason behind.
        held = rows.join(F.broadcast(listed), "file")
        empty = listed.join(rows.select("file").distinct(), "file", "left_anti").select(
            "file", "status", "reason", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("payload")
        )
        self.store.write(held.select(*empty.columns).unionByName(empty), st.BAD_FILES, run)

    def _mismatch_rows(self, layouts: list[Layout], facts: DataFrame) -> DataFrame:
        """Cleaned rows of files that do not fit, each as JSON under its own names.

        Any number of different headers is read by position in one scan.
        """
        rows = csv.scan(self.spark, layouts)
        fields = csv.positional(rows)
        rows = clean.Kinds(facts, "file", fields).apply(rows)
        rows = clean.dedupe_rows(rows, "file", "pos", fields)
        names = small_table(self.spark, [(x.file, list(x.columns)) for x in layouts], "file string, names array<string>")
        values = F.slice(F.array(*clean.as_written(rows, fields)), F.lit(1), F.size("names"))
        payload = F.to_json(F.map_from_arrays("names", values), {"ignoreNullFields": "false"})
        return rows.join(F.broadcast(names), "file").select("file", "pos", payload.alias("payload"))

    def _audit(self, run: int, judged: list[Judged], loaded: bool, started: float) -> None:
        listed = small_table(
            self.spark,
            [(j.file, j.status, len(j.layout.columns) if j.layout else 0) for j in judged],
            "file string, status string, columns long",
        )
        counts = ["rows_in", "duplicates_removed", "nulls", "rows_staged", "rows_loaded", "rows_bad"]
        if loaded:
            per_file = (
                self.spark.read.parquet(self.store.path(TALLIES, run))
                .groupBy("file")
                .agg(
                    F.sum("rows_in").alias("rows_in"),
                    F.sum(F.col("rows_in") - F.col("chunk_rows")).alias("duplicates_removed"),
                    F.sum("nulls").alias("nulls"),
                    F.sum("chunk_rows").alias("rows_staged"),
                    F.sum("good_rows").alias("rows_loaded"),
                    F.sum(F.col("chunk_rows") - F.col("good_rows")).alias("rows_bad"),
                )
            )
            audits = listed.join(per_file, "file", "left").fillna(0, counts)
        else:
            audits = listed.withColumns({c: F.lit(0).cast("long") for c in counts})
        self.store.write(audits.select("file", "status", "columns", *counts), st.AUDIT, run)
        summary = audit.run_summary(self.spark.read.parquet(self.store.path(st.AUDIT, run)))
        self.store.write(summary.withColumn("seconds", F.lit(time.time() - started)), st.RUNS, run)

    def _register(self, run: int, main: MainSchema) -> None:
        columns = [(c, t, infer.declared_length(t)) for c, t in main.types.items()]
        row = (self.config.table, main.key, columns, main.first_file)
        self.store.write(small_table(self.spark, [row], st.SCHEMA_OF[st.SCHEMAS]), st.SCHEMAS, run)

    def _checkpoint(self, run: int, judged: list[Judged]) -> None:
        now = datetime.now(timezone.utc)
        rows = [(j.file, j.status, now) for j in judged]
        self.store.write(small_table(self.spark, rows, st.SCHEMA_OF[st.PROCESSED]).coalesce(1), st.PROCESSED, run)
