"""Registered queries about landed files, the schema gate and whole loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import audit, clean, gate, ids
from tidegate.operators.infer import column_facts
from tidegate.plans import dirty, load_queries
from tidegate.plans.dirty import table
from tidegate.plans.expected import NULL_TOKENS, VOTE_PATTERN
from tidegate.plans.ingest import FLAGS, Load, LoadConfig
from tidegate.plans.landing import (
    COLUMNS, HEADER, LEAST_ORDERS, MOST_FILES, ORACLE_ROWS, OTHER, OTHER_HEADER, POISONS, RAGGED, REORDERED, landing, poisoned_landing, texts_landing,
)
from tidegate.plans.profile_queries import TABLES
from tidegate.plans.routing import Router
from tidegate.session import scratch_path, settle
from tidegate.sinks import export
from tidegate.sinks import store as st
from tidegate.sources import csv, files, listing, tables
from tidegate.sources.csv import Layout

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
_MAIN_KEY = "|".join(sorted(COLUMNS.values()))
_OTHER_KEY = "clerk|order_price_usd"
_REASON = f"Schema mismatch. Expected: {_MAIN_KEY}, Got: {_OTHER_KEY}"
_ORDER = list(COLUMNS)
_PLACED = f"""
WITH rows AS ({ORACLE_ROWS}),
files AS (SELECT DISTINCT file, file_no FROM rows)
"""
_VOTE = f"'{VOTE_PATTERN}'"
_LOAD = (
    _PLACED
    + f""",
decoded AS (SELECT file, file_no, pos, {", ".join(f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in _ORDER)}
  FROM rows WHERE file_no % 7 NOT IN ({OTHER}, {RAGGED})),
deduped AS (SELECT file, file_no, MIN(pos) AS pos, COUNT(*) AS copies, {", ".join(_ORDER)} FROM decoded GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY pos) AS ordinal FROM deduped),
typed AS (SELECT *,
    CASE WHEN regexp_full_match(TRIM(price), {_VOTE}) THEN TRY_CAST(TRIM(price) AS DOUBLE) END AS price_value,
    CASE WHEN odate LIKE '____-__-__' THEN TRY_CAST(odate AS DATE) ELSE CAST(try_strptime(odate, '%m/%d/%Y') AS DATE) END AS odate_value,
    TRY_CAST(TRUNC(TRY_CAST(TRIM(cust) AS DOUBLE)) AS BIGINT) AS cust_value
  FROM numbered),
faults AS (SELECT *, price IS NOT NULL AND price_value IS NULL AS bad_price, odate IS NOT NULL AND odate_value IS NULL AS bad_odate,
    cust IS NOT NULL AND cust_value IS NULL AS bad_cust FROM typed),
judged AS (SELECT *, CASE
    WHEN file_no % 7 = {REORDERED} AND bad_cust THEN 'Column ''cust_key'' expects INT, got ''' || cust || ''''
    WHEN file_no % 7 = {REORDERED} AND bad_odate THEN 'Column ''order_date'' expects DATE, got ''' || odate || ''''
    WHEN bad_price THEN 'Column ''order_price_usd'' expects FLOAT, got ''' || price || ''''
    WHEN bad_odate THEN 'Column ''order_date'' expects DATE, got ''' || odate || ''''
    WHEN bad_cust THEN 'Column ''cust_key'' expects INT, got ''' || cust || '''' END AS error FROM faults),
reach AS (SELECT file, COALESCE(MAX(CASE WHEN error IS NULL THEN ordinal END), 0) AS reach FROM judged GROUP BY file),
bases AS (SELECT file, COALESCE(SUM(reach) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM reach),
loaded AS (SELECT j.*, CAST(b.base + j.ordinal AS BIGINT) AS id FROM judged j JOIN bases b ON j.file = b.file)
"""
)
_VALUES = "price_value AS order_price_usd, CAST(odate_value AS VARCHAR) AS order_date, cust_value AS cust_key, status"


# --- the landing folder -------------------------------------------------------


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.list_files(spark, landing(spark, sf_dir))


def _processed(listed: DataFrame) -> DataFrame:
    """Every other file counts as done already."""
    return listed.where(F.substring("file", 8, 6).cast("int") % 2 == 0).select("file")


@query("file_inventory", _PLACED + "SELECT file, TRUE AS has_content FROM files")
def file_inventory(spark, sf_dir):
    return _files(spark, sf_dir).select("file", (F.col("length") > 0).alias("has_content"))


@query("pending_files", _PLACED + "SELECT file FROM files WHERE file_no % 2 <> 0")
def pending_files(spark, sf_dir):
    listed = _files(spark, sf_dir)
    return files.pending_files(listed, _processed(listed)).select("file").orderBy("file")


@query(
    "backlog",
    _PLACED + "SELECT COUNT(*) AS total_files, COUNT(CASE WHEN file_no % 2 = 0 THEN 1 END) AS processed_files, "
    "COUNT(CASE WHEN file_no % 2 <> 0 THEN 1 END) AS remaining_files FROM files",
)
def backlog(spark, sf_dir):
    listed = _files(spark, sf_dir)
    return audit.backlog(listed, _processed(listed))


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file, settled so that no file is opened twice."""
    return settle(files.header_registry(_files(spark, sf_dir)))


def _by_kind(usual: str, reordered: str, other: str) -> str:
    return f"CASE file_no % 7 WHEN {REORDERED} THEN '{reordered}' WHEN {OTHER} THEN '{other}' ELSE '{usual}' END"


def _listed(names) -> str:
    return "|".join(names)


_RAW = _by_kind(_listed(HEADER.values()), _listed(reversed(HEADER.values())), _listed(OTHER_HEADER.values()))
_NAMES = _by_kind(_listed(COLUMNS.values()), _listed(reversed(COLUMNS.values())), "order_price_usd|clerk")


@query(
    "header_registry",
    _PLACED + f"SELECT file, {_RAW} AS header, {_NAMES} AS columns, CAST(CASE WHEN file_no % 7 = {OTHER} THEN 2 ELSE 4 END AS INTEGER) AS first_width, TRUE AS renamed FROM files",
)
def header_registry(spark, sf_dir):
    return _registry(spark, sf_dir).select(
        "file", F.array_join("header", "|").alias("header"), F.array_join("columns", "|").alias("columns"), "first_width", "renamed"
    )


_KEY = _by_kind(_MAIN_KEY, _MAIN_KEY, _OTHER_KEY)


@query("schema_key", _PLACED + f"SELECT file, {_KEY} AS schema_key FROM files")
def schema_key(spark, sf_dir):
    return _registry(spark, sf_dir).select("file", "schema_key")


@query("main_schema", _PLACED + f"SELECT MIN(file) AS first_file, '{_MAIN_KEY}' AS schema_key FROM files")
def main_schema(spark, sf_dir):
    return gate.main_schema(_registry(spark, sf_dir))


@query(
    "schema_gate",
    _PLACED + f"SELECT file, CASE WHEN file_no % 7 = {OTHER} THEN 'schema_mismatch' ELSE 'accepted' END AS status, "
    f"CASE WHEN file_no % 7 = {OTHER} THEN '{_REASON}' END AS reason FROM files",
)
def schema_gate(spark, sf_dir):
    registry = _registry(spark, sf_dir)
    main_key = gate.main_schema(registry).select("schema_key").scalar()
    return gate.judge_files(registry, main_key, columns="columns").select("file", "status", "reason")


@query("schema_router", _PLACED + f"SELECT file, CASE WHEN file_no % 7 = {OTHER} THEN 'tbl_2' ELSE 'tbl_1' END AS table_name FROM files")
def schema_router(spark, sf_dir):
    return gate.route_by_schema(_registry(spark, sf_dir)).select("file", "table_name")


def _layouts(registry: DataFrame) -> list[Layout]:
    """Layouts of landed files; the folder holds a capped number of them."""
    chosen = registry.select("path", "file", "columns", "first_width").collect()
    return [Layout(r["path"], r["file"], tuple(r["columns"]), r["first_width"]) for r in chosen]


def _filled(*columns: str) -> str:
    return " + ".join(f"CASE WHEN {c} IS NULL OR {c} IN ({_TOKENS}) THEN 0 ELSE 1 END" for c in columns)


@query(
    "file_validation",
    _PLACED + f"SELECT file, COUNT(*) AS rows, CAST(SUM(CASE WHEN file_no % 7 = {OTHER} THEN {_filled('price', 'clerk')} ELSE {_filled(*COLUMNS)} END) AS BIGINT) AS values, COUNT(CASE WHEN file_no % 7 = {RAGGED} AND o_orderkey % 500 = 250 THEN 1 END) AS overlong_rows, "
    f"CASE WHEN COUNT(CASE WHEN file_no % 7 = {RAGGED} AND o_orderkey % 500 = 250 THEN 1 END) > 0 THEN 'row longer than the header' ELSE 'ok' END AS verdict "
    "FROM rows GROUP BY file",
)
def file_validation(spark, sf_dir):
    """Whether every record of a file fits its header."""
    rows = csv.scan(spark, _layouts(_registry(spark, sf_dir)))
    facts = column_facts(rows, csv.positional(rows), ["file"], FLAGS)
    per_file = facts.groupBy("file").agg(
        F.max("rows").alias("rows"), F.sum("filled").alias("values"), F.max("overlong").alias("overlong_rows")
    )
    verdict = F.when(F.col("overlong_rows") > 0, "row longer than the header").otherwise("ok")
    return per_file.select("file", "rows", "values", "overlong_rows", verdict.alias("verdict"))


@query(
    "csv_scan",
    _PLACED + f"SELECT file, row_number() OVER (PARTITION BY file ORDER BY pos) AS ordinal, "
    f"{', '.join(f'CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {n}' for c, n in COLUMNS.items())} FROM rows WHERE file_no % 7 <> {OTHER}",
)
def csv_scan(spark, sf_dir):
    """Rows of all files with the table's columns, by name, in file order."""
    wanted = list(COLUMNS.values())
    registry = _registry(spark, sf_dir)
    fitting = registry.where(F.col("schema_key") == gate.main_schema(registry).select("schema_key").scalar())
    rows = csv.scan(spark, _layouts(fitting), wanted)
    return ids.number_rows(rows, "file", "pos", span=csv.CHUNK_SPAN).select("file", ids.ORDINAL, *wanted)


_TEXT_FIELDS = ", ".join(f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in ("text", "lang"))


@query(
    "multiline_scan",
    f"SELECT source || '.csv' AS file, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS ordinal, CAST(doc_id AS VARCHAR) AS doc_id, {_TEXT_FIELDS} FROM documents WHERE source IS NOT NULL",
)
def multiline_scan(spark, sf_dir):
    """Records that go on over line ends, in file order; a file is read by as many tasks as it has splits."""
    listed = listing.list_files(spark, texts_landing(spark, sf_dir))
    names = ["doc_id", "text", "lang"]
    layouts = [Layout(r["path"], r["file"], tuple(names), len(names), True) for r in listed.collect()]
    return ids.number_rows(csv.scan(spark, layouts, names), "file", "pos", span=csv.CHUNK_SPAN).select("file", ids.ORDINAL, *names)


# --- whole loads --------------------------------------------------------------

_warehouses: dict[tuple[str, str], Load] = {}


def loaded(spark: SparkSession, sf_dir: str) -> Load:
    """A finished load of the landing folder, run once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        run = Load(spark, LoadConfig(landing(spark, sf_dir), scratch_path(spark, "warehouse"), files_per_batch=10_000))
        run.run_all()
        _warehouses[key] = run
    return _warehouses[key]


@query("ingest_table", _LOAD + f"SELECT id, file, {_VALUES} FROM loaded WHERE error IS NULL")
def ingest_table(spark, sf_dir):
    """The table after a whole load of the landing folder."""
    rows = loaded(spark, sf_dir).table()
    return rows.select(
        "id", F.col("_src_file").alias("file"), "order_price_usd", F.col("order_date").cast("string"), F.col("cust_key").cast("long"), "status"
    )


@query("ingest_batches", _LOAD + f"SELECT id, file, {_VALUES} FROM loaded WHERE error IS NULL")
def ingest_batches(spark, sf_dir):
    """The same table from several batches: ids, texts and types do not depend on their size."""
    folder = landing(spark, sf_dir)
    batch = -(-listing.list_files(spark, folder).count() // 4)
    run = Load(spark, LoadConfig(folder, scratch_path(spark, "batches"), files_per_batch=batch))
    run.run_all()
    return run.table().select(
        "id", F.col("_src_file").alias("file"), "order_price_usd", F.col("order_date").cast("string"), F.col("cust_key").cast("long"), "status"
    )


_FIRST_FILE = "file = (SELECT MIN(file) FROM deduped)"
_LENGTHS = "CASE WHEN longest <= 50 THEN 100 WHEN longest <= 100 THEN 200 WHEN longest <= 255 THEN 500 WHEN longest <= 1000 THEN 2000 ELSE 65533 END"
_STEPS = " ".join(f"WHEN low >= -{2**b} AND high <= {2**b - 1} THEN '{t}'" for b, t in ((7, "TINYINT"), (15, "SMALLINT"), (31, "INT")))


@query(
    "schema_registry",
    _LOAD + f""", first_file AS (SELECT * FROM typed WHERE {_FIRST_FILE}),
whole AS (SELECT MIN(file) AS file, MIN(cust_value) AS low, MAX(cust_value) AS high, MAX(length(status)) AS longest FROM first_file),
named AS (SELECT file, low, high, {_LENGTHS} AS varchar_len FROM whole)
SELECT 'main_data_table' AS table_name, '{_MAIN_KEY}' AS schema_key, file AS first_file, u.position, u.name, u.type, u.varchar_len
FROM named, LATERAL (VALUES (1, 'order_price_usd', 'DOUBLE', NULL), (2, 'order_date', CASE WHEN (SELECT COUNT(*) FROM first_file WHERE odate IS NOT NULL AND NOT regexp_matches(odate, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) = 0 THEN 'DATE' ELSE 'VARCHAR(100)' END, NULL),
  (3, 'cust_key', CASE {_STEPS} ELSE 'BIGINT' END, NULL), (4, 'status', 'VARCHAR(' || varchar_len || ')', varchar_len)) AS u(position, name, type, varchar_len)""",
)
def schema_registry(spark, sf_dir):
    """What a load registers of its table: columns in order, their types, the lengths of text."""
    found = loaded(spark, sf_dir).store.finished(st.SCHEMAS)
    columns = found.select("table_name", "schema_key", "first_file", F.posexplode("columns").alias("position", "c"))
    return columns.select("table_name", "schema_key", "first_file", (F.col("position") + 1).alias("position"), "c.name", "c.type", "c.varchar_len")


@query("ingest_bad_rows", _LOAD + "SELECT file, ordinal + 1 AS row_number, error FROM loaded WHERE error IS NOT NULL")
def ingest_bad_rows(spark, sf_dir):
    return loaded(spark, sf_dir).store.finished(st.BAD_ROWS).select("file", "row_number", "error")


_JSON = "json_object(" + ", ".join(f"'{n}', raw.{c}" for c, n in COLUMNS.items()) + ")"


@query(
    "quarantined_values",
    _LOAD + f""", raw AS (SELECT file, pos, {", ".join(f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in _ORDER)} FROM rows)
SELECT l.file, l.ordinal + 1 AS row_number, CAST({_JSON} AS VARCHAR) AS payload FROM loaded l JOIN raw ON l.file = raw.file AND l.pos = raw.pos WHERE l.error IS NOT NULL""",
)
def quarantined_values(spark, sf_dir):
    """The values of bad rows as their files have them, blanks and digits kept."""
    return loaded(spark, sf_dir).store.finished(st.BAD_ROWS).select("file", "row_number", "payload")


_QUOTED = """CASE WHEN status LIKE '%,%' THEN '"' || replace(status, '"', '""') || '"' ELSE status END"""
_RAW_LINE = f"COALESCE(price, '') || ',' || COALESCE(odate, '') || ',' || COALESCE(cust, '') || ',' || COALESCE({_QUOTED}, '') || CASE WHEN o_orderkey % 500 = 250 THEN ',surplus' ELSE '' END"
_CLERK_JSON = """'{"order_price_usd":' || COALESCE('"' || price || '"', 'null') || ',"clerk":"' || clerk || '"}'"""


@query(
    "quarantine_files",
    _PLACED + f"SELECT DISTINCT file, 'schema_mismatch' AS status, '{_REASON}' AS reason, {_CLERK_JSON} AS payload FROM rows WHERE file_no % 7 = {OTHER} "
    f"UNION ALL SELECT file, 'unreadable', 'row longer than the header', {_RAW_LINE} FROM rows WHERE file_no % 7 = {RAGGED} "
    f"UNION ALL SELECT file, 'unreadable', 'row longer than the header', '{','.join(HEADER.values())}' FROM files WHERE file_no % 7 = {RAGGED}",
)
def quarantine_files(spark, sf_dir):
    """Every rejected file: rows of those that do not fit, lines of those that cannot be read."""
    return loaded(spark, sf_dir).store.finished(st.BAD_FILES).select("file", "status", "reason", "payload")


@query(
    "file_notes",
    _LOAD + """SELECT file, COALESCE(string_agg(error, '; ' ORDER BY ordinal) FILTER (error_no <= 5), '') AS first_errors,
  string_agg(COALESCE(status, 'NULL'), '; ' ORDER BY ordinal) FILTER (ordinal <= 3) AS first_status
FROM (SELECT *, CASE WHEN error IS NOT NULL THEN row_number() OVER (PARTITION BY file, error IS NULL ORDER BY ordinal) END AS error_no FROM loaded) GROUP BY file""",
)
def file_notes(spark, sf_dir):
    """The first errors and values of each file, kept by the load."""
    notes = loaded(spark, sf_dir).store.finished(st.NOTES)
    return notes.select("file", F.array_join("first_errors", "; ").alias("first_errors"), F.array_join(F.col("samples")["status"], "; ").alias("first_status"))


_STATUS = f"CASE file_no % 7 WHEN {OTHER} THEN 'schema_mismatch' WHEN {RAGGED} THEN 'unreadable' ELSE 'loaded' END"


@query("checkpoint_update", _PLACED + f"SELECT file, {_STATUS} AS status FROM files")
def checkpoint_update(spark, sf_dir):
    return loaded(spark, sf_dir).store.finished(st.PROCESSED).select("file", "status")


@query(
    "ingest_audit",
    _LOAD + "SELECT file, CAST(4 AS BIGINT) AS columns, CAST(SUM(copies) AS BIGINT) AS rows_in, CAST(SUM(copies - 1) AS BIGINT) AS duplicates_removed, "
    f"CAST(SUM({' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in _ORDER)}) AS BIGINT) AS nulls, COUNT(*) AS rows_staged, "
    "COUNT(*) - COUNT(error) AS rows_loaded, COUNT(error) AS rows_bad FROM loaded GROUP BY file",
)
def ingest_audit(spark, sf_dir):
    return loaded(spark, sf_dir).store.finished(st.AUDIT).where("status = 'loaded'").drop("status", "run")


@query(
    "ingest_summary",
    _LOAD + f"SELECT (SELECT COUNT(*) FROM files) AS files_seen, (SELECT COUNT(*) FROM files WHERE file_no % 7 NOT IN ({OTHER}, {RAGGED})) AS files_loaded, "
    f"(SELECT COUNT(*) FROM files WHERE file_no % 7 = {OTHER}) AS files_mismatched, (SELECT COUNT(*) FROM files WHERE file_no % 7 = {RAGGED}) AS files_unreadable, "
    "COUNT(*) - COUNT(error) AS rows_loaded, COUNT(error) AS rows_bad FROM loaded",
)
def ingest_summary(spark, sf_dir):
    return loaded(spark, sf_dir).store.finished(st.RUNS).drop("seconds", "run")


def _typed(rows: DataFrame, lineage: str = "_src_file") -> DataFrame:
    return rows.select("id", F.col(lineage).alias("file"), "order_price_usd", F.col("order_date").cast("string"), F.col("cust_key").cast("long"), "status")


@query("bucketed_load", _LOAD + f"SELECT id, file, {_VALUES} FROM loaded WHERE error IS NULL")
def bucketed_load(spark, sf_dir):
    """The load as a catalog table hashed by id, joined with itself on ids without an exchange."""
    config = LoadConfig(landing(spark, sf_dir), scratch_path(spark, "bucketed"), files_per_batch=10_000, catalog=f"tidegate_{uuid.uuid4().hex}")
    run = Load(spark, config)
    run.run_all()
    rows = run.table()
    texts = rows.select("id", "status", "_src_file").hint("merge")
    return _typed(rows.drop("status", "_src_file").join(texts, "id"))


_LATER = _LOAD.replace(f"FROM rows WHERE file_no % 7 NOT IN ({OTHER}, {RAGGED})", f"FROM rows WHERE file_no % 7 NOT IN ({OTHER}, {RAGGED}) AND file_no >= (SELECT (COUNT(*) + 1) // 2 FROM files)")
# Dates of two layouts make the column text in the first file of the later half.
_LATER = _LATER.replace("odate IS NOT NULL AND odate_value IS NULL AS bad_odate", "FALSE AS bad_odate")


@query("missing_table_rebuild", _LATER + f"SELECT id, file, {_VALUES.replace('CAST(odate_value AS VARCHAR)', 'odate')} FROM loaded WHERE error IS NULL")
def missing_table_rebuild(spark, sf_dir):
    """The catalog table is dropped between two batches: the next one infers and builds it anew, with ids from 1."""
    folder, name = landing(spark, sf_dir), f"tidegate_{uuid.uuid4().hex}"
    listed = settle(listing.list_files(spark, folder))
    half = (listed.count() + 1) // 2
    run = Load(spark, LoadConfig(folder, scratch_path(spark, "rebuilt"), files_per_batch=10_000, catalog=name))
    run.run_batch(run.pending(listed).orderBy("file").limit(half))
    spark.sql(f"DROP TABLE `{name}`")
    run.store.remove_all(run.config.table)
    run.run_all(listed)
    return _typed(run.table())


@query(
    "error_files",
    _LOAD + "SELECT 'error_' || replace(file, '.csv', '') AS error_file, price AS order_price_usd, odate AS order_date, cust AS cust_key, status, error FROM loaded WHERE error IS NOT NULL",
)
def error_files(spark, sf_dir):
    """Bad rows of a load as CSV, one folder per source file, read back."""
    path = scratch_path(spark, "errors")
    Load(spark, LoadConfig(landing(spark, sf_dir), scratch_path(spark, "error-warehouse"), files_per_batch=10_000, error_files=path)).run_all()
    back = spark.read.option("header", True).option("escape", '"').csv(f"{path}/run=1")
    return back.select("error_file", "order_price_usd", "order_date", "cust_key", "status", "error")


@query(
    "schema_tables",
    _LOAD + f""", other AS (SELECT DISTINCT file, price, clerk FROM rows WHERE file_no % 7 = {OTHER})
SELECT 'tbl_1' AS table_name, file, COUNT(*) - COUNT(error) AS rows_loaded FROM loaded GROUP BY file
UNION ALL SELECT 'tbl_1', file, 0 FROM files WHERE file_no % 7 = {RAGGED}
UNION ALL SELECT 'tbl_2', file, COUNT(CASE WHEN price IS NULL OR TRY_CAST(TRIM(price) AS DOUBLE) IS NOT NULL THEN 1 END) FROM other GROUP BY file""",
)
def schema_tables(spark, sf_dir):
    """Each schema into its own table, in two batches; a schema met again keeps its table."""
    folder = landing(spark, sf_dir)
    batch = (listing.list_files(spark, folder).count() + 1) // 2
    router = Router(spark, LoadConfig(folder, scratch_path(spark, "routed"), files_per_batch=batch))
    router.run_all()
    parts = [
        router.load(r["table_name"]).store.finished(st.AUDIT).select(F.lit(r["table_name"]).alias("table_name"), "file", "rows_loaded")
        for r in router.tables().collect()  # one row per schema
    ]
    return reduce(DataFrame.unionByName, parts)


@query("streaming_ingest", _LOAD + f"SELECT file, {_VALUES} FROM loaded WHERE error IS NULL")
def streaming_ingest(spark, sf_dir):
    """The same load driven by a stream over the folder; ids follow the order of arrival."""
    from tidegate.streaming import landing as stream

    config = LoadConfig(landing(spark, sf_dir), scratch_path(spark, "stream-warehouse"), files_per_batch=10_000)
    stream.start(spark, config, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    rows = Load(spark, config).table()
    return rows.select(
        F.col("_src_file").alias("file"), "order_price_usd", F.col("order_date").cast("string"), F.col("cust_key").cast("long"), "status"
    )


_POISONED = f"""
WITH files AS (SELECT o_orderkey // GREATEST({LEAST_ORDERS}, (SELECT MAX(o_orderkey) + 1 FROM orders) // {MOST_FILES}) AS file_no, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT 'orders_' || LPAD(CAST(file_no AS VARCHAR), 6, '0') || '.csv' AS file,
  CASE WHEN file_no % 7 BETWEEN 1 AND 5 THEN 'unreadable' ELSE 'loaded' END AS status,
  CASE file_no % 7 {" ".join(f"WHEN {k} THEN '{why}'" for k, why in POISONS.items())} END AS reason,
  CASE WHEN file_no % 7 IN (0, 6) THEN n ELSE 0 END AS rows_loaded FROM files
"""


def _outcome(load: Load) -> DataFrame:
    """What became of each file, why, and how many of its rows were loaded."""
    reasons = load.store.finished(st.BAD_FILES).groupBy("file").agg(F.max("reason").alias("reason"))
    audits = load.store.finished(st.AUDIT).select("file", "rows_loaded")
    return load.store.finished(st.PROCESSED).select("file", "status").join(reasons, "file", "left").join(audits, "file").select("file", "status", "reason", "rows_loaded")


@query("poison_files", _POISONED)
def poison_files(spark, sf_dir):
    """Bad bytes, tens of thousands and a million fields, a quote that never closes, no bytes: each costs its file only."""
    run = Load(spark, LoadConfig(poisoned_landing(spark, sf_dir), scratch_path(spark, "poisoned-warehouse"), files_per_batch=10_000))
    run.run_all()
    return _outcome(run)


@query("poison_stream", _POISONED)
def poison_stream(spark, sf_dir):
    """The same folder by a stream, which notices files without a byte."""
    from tidegate.streaming import landing as stream

    config = LoadConfig(poisoned_landing(spark, sf_dir), scratch_path(spark, "poisoned-stream"), files_per_batch=10_000)
    stream.start(spark, config, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return _outcome(Load(spark, config))


# --- sinks and the catalog ----------------------------------------------------


@query("staged_roundtrip", dirty.ORACLE + f"SELECT src_file, pos, copies, {', '.join(dirty.COLUMNS)} FROM deduped")
def staged_roundtrip(spark, sf_dir):
    """Staged rows written and read back."""
    store = st.Store(spark, scratch_path(spark, "staged"))
    store.write(load_queries.deduped(spark, sf_dir), "staged", 1)
    back = spark.read.parquet(store.path("staged", 1))
    return back.select(dirty.FILE, dirty.POS, "copies", *clean.as_written(back, dirty.COLUMNS))


@query("csv_export", "SELECT * FROM orders")
def csv_export(spark, sf_dir):
    """A table exported as CSV and read back."""
    path = scratch_path(spark, "export")
    rows = table(spark, sf_dir, "orders")
    export.export_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).option("escape", '"').csv(path)


@query(
    "table_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM (DESCRIBE {t})) AS columns, COUNT(*) > 0 AS has_rows FROM {t}" for t in TABLES
    ),
)
def table_catalog(spark, sf_dir):
    """Tables known to the catalog, and what can be seen of each."""
    prefix = "tidegate_catalog_"
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(prefix + t)
    out = None
    for name in tables.list_tables(spark, prefix):
        df = spark.table(name)
        one = df.agg((F.count(F.lit(1)) > 0).alias("has_rows")).select(
            F.lit(name.removeprefix(prefix)).alias("table_name"), F.lit(len(df.columns)).cast("long").alias("columns"), "has_rows"
        )
        out = one if out is None else out.unionByName(one)
    return out
