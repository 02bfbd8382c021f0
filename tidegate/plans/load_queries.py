"""Registered queries of inference, cleaning, row checks, ids and audits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import clean_header, table_columns_of
from tidegate.operators import audit, clean, ids, infer, validate
from tidegate.plans import dirty
from tidegate.plans.dirty import COLUMNS, FILE, ORACLE, POS, VOTE, table
from tidegate.session import lookup, scratch_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


# --- stages of a load ---------------------------------------------------------


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.decode_nulls(dirty.raw(spark, sf_dir), COLUMNS)


def as_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decoded(spark, sf_dir)
    return clean.reading_kinds(rows, FILE, COLUMNS).apply(rows)


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedupe_rows(as_read(spark, sf_dir), FILE, POS, COLUMNS)


def first_file(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(FILE) == rows.agg(F.min(FILE)).scalar())


def main_types(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Types of the first file, one per column, fixed before any row is checked."""
    rows = first_file(decoded(spark, sf_dir))
    return infer.collect_types(infer.infer_schema(rows.select(*COLUMNS)))


_staged: dict[tuple[str, str], tuple[DataFrame, dict[str, str]]] = {}


def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    """Deduplicated, ranked and checked rows on disk, and the types they met.

    Staged once per application. Everything after it reads only the columns it
    needs, instead of running the cleaning again for each of its passes.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        types = main_types(spark, sf_dir)
        ranked = ids.rank_in_chunks(deduped(spark, sf_dir), FILE, POS)
        path = scratch_path(spark, "staged")
        validate.check_rows(ranked, types).write.parquet(path)
        _staged[key] = (spark.read.parquet(path), types)
    return _staged[key]


def numbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    rows, types = staged(spark, sf_dir)
    tallies = settle(ids.tally_chunks(rows, FILE, F.col(validate.FAULT).isNull()))
    return ids.apply_offsets(rows, lookup(ids.chunk_offsets(tallies, FILE), tallies), FILE), types


# --- inference ----------------------------------------------------------------

_SHARE = f"COUNT(CASE WHEN regexp_full_match(TRIM({{c}}), {VOTE}) THEN 1 END)"


@query(
    "numeric_share",
    ORACLE + _union(f"SELECT '{c}' AS \"column\", COUNT({c}) AS filled, {_SHARE.format(c=c)} AS votes, ROUND({_SHARE.format(c=c)} * 1.0 / NULLIF(COUNT({c}), 0), 6) AS share FROM decoded" for c in COLUMNS),
)
def numeric_share(spark, sf_dir):
    facts = infer.column_facts(decoded(spark, sf_dir), COLUMNS)
    return facts.select("column", "filled", "votes", F.round(infer.numeric_share(), 6).alias("share"))


@query(
    "majority_vote",
    ORACLE + _union(f"SELECT src_file, '{c}' AS \"column\", {_SHARE.format(c=c)} * 2 > COUNT({c}) AS numeric FROM decoded GROUP BY src_file" for c in COLUMNS),
)
def majority_vote(spark, sf_dir):
    facts = infer.column_facts(decoded(spark, sf_dir), COLUMNS, [FILE])
    return facts.select(FILE, "column", infer.has_majority().alias("numeric"))


def _ladder(low: str, high: str) -> str:
    return (
        f"CASE WHEN {low} >= -128 AND {high} <= 127 THEN 'TINYINT' WHEN {low} >= -32768 AND {high} <= 32767 THEN 'SMALLINT' "
        f"WHEN {low} >= -2147483648 AND {high} <= 2147483647 THEN 'INT' ELSE 'BIGINT' END"
    )


_INTEGERS = {"part": ["p_partkey", "p_size"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "events": ["event_id", "user_id"]}


@query(
    "integer_width",
    _union(
        f"SELECT '{t}' AS table_name, '{c}' AS \"column\", MIN({c}) AS low, MAX({c}) AS high, {_ladder(f'MIN({c})', f'MAX({c})')} AS type FROM {t}"
        for t, columns in _INTEGERS.items() for c in columns
    ),
)
def integer_width(spark, sf_dir):
    out = None
    for t, columns in _INTEGERS.items():
        facts = infer.table_facts(table(spark, sf_dir, t), columns).select(
            F.lit(t).alias("table_name"), "column", F.col("low").cast("long"), F.col("high").cast("long"), infer.numeric_type().alias("type")
        )
        out = facts if out is None else out.unionByName(facts)
    return out


_FLOATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "integral_floats",
    _union(
        f"SELECT '{c}' AS \"column\", bool_and({c} % 1 = 0) AS integral, CASE WHEN bool_and({c} % 1 = 0) THEN {_ladder(f'MIN({c})', f'MAX({c})')} ELSE 'DOUBLE' END AS type FROM lineitem"
        for c in _FLOATS
    ),
)
def integral_floats(spark, sf_dir):
    facts = infer.table_facts(table(spark, sf_dir, "lineitem"), _FLOATS)
    return facts.select("column", (F.col("whole") == F.col("readings")).alias("integral"), infer.numeric_type().alias("type"))


@query(
    "boolean_detect",
    ORACLE + _union(
        f"SELECT src_file, '{c}' AS \"column\", COUNT(CASE WHEN LOWER({c}) IN ('true', 'false') THEN 1 END) = COUNT(*) AS is_boolean FROM decoded GROUP BY src_file"
        for c in COLUMNS
    ),
)
def boolean_detect(spark, sf_dir):
    facts = infer.column_facts(decoded(spark, sf_dir), COLUMNS, [FILE])
    return facts.select(FILE, "column", (infer.decided_type() == "BOOLEAN").alias("is_boolean"))


@query(
    "date_detect",
    ORACLE + "SELECT src_file, COUNT(odate) AS filled, COUNT(CASE WHEN regexp_full_match(odate, '\\d{4}-\\d{2}-\\d{2}') THEN 1 END) AS dates, "
    "CASE WHEN bool_and(regexp_full_match(odate, '\\d{4}-\\d{2}-\\d{2}')) THEN 'DATE' ELSE 'VARCHAR(100)' END AS type FROM decoded GROUP BY src_file",
)
def date_detect(spark, sf_dir):
    facts = infer.column_facts(decoded(spark, sf_dir), ["odate"], [FILE])
    return facts.select(FILE, "filled", "dates", infer.decided_type().alias("type"))


_TEXTS = {"documents": ["text", "lang", "source"], "customer": ["c_name", "c_mktsegment"], "benchmark": ["text"], "pages": ["url", "html"]}


@query(
    "varchar_bucket",
    _union(
        f"SELECT '{t}' AS table_name, '{c}' AS \"column\", CAST(MAX(length({c})) AS INTEGER) AS longest, "
        f"CASE WHEN MAX(length({c})) <= 50 THEN 'VARCHAR(100)' WHEN MAX(length({c})) <= 100 THEN 'VARCHAR(200)' WHEN MAX(length({c})) <= 255 THEN 'VARCHAR(500)' "
        f"WHEN MAX(length({c})) <= 1000 THEN 'VARCHAR(2000)' ELSE 'VARCHAR(65533)' END AS type FROM {t}"
        for t, columns in _TEXTS.items() for c in columns
    ),
)
def varchar_bucket(spark, sf_dir):
    out = None
    for t, columns in _TEXTS.items():
        facts = infer.table_facts(table(spark, sf_dir, t), columns).select(
            F.lit(t).alias("table_name"), "column", "longest", infer.varchar_type().alias("type")
        )
        out = facts if out is None else out.unionByName(facts)
    return out


@query(
    "empty_column_type",
    ORACLE + _union(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS filled, CASE WHEN COUNT({c}) = 0 THEN 'VARCHAR(255)' END AS empty_type FROM decoded" for c in COLUMNS
    ),
)
def empty_column_type(spark, sf_dir):
    facts = infer.column_facts(decoded(spark, sf_dir), COLUMNS)
    return facts.select("column", "filled", F.when(F.col("filled") == 0, infer.decided_type()).alias("empty_type"))


_X = f"CASE WHEN regexp_full_match(TRIM({{c}}), {VOTE}) THEN TRY_CAST(TRIM({{c}}) AS DOUBLE) END"


def _infer_sql(position: int, c: str) -> str:
    x = _X.format(c=c)
    return f"""
SELECT CAST({position} AS INTEGER) AS position, '{c}' AS "column", CASE
  WHEN COUNT({c}) = 0 THEN 'VARCHAR(255)'
  WHEN COUNT({x}) * 2 > COUNT({c}) THEN CASE WHEN bool_and(({x}) % 1 = 0) THEN {_ladder(f"MIN({x})", f"MAX({x})")} ELSE 'DOUBLE' END
  WHEN COUNT(CASE WHEN LOWER({c}) IN ('true', 'false') THEN 1 END) = COUNT(*) THEN 'BOOLEAN'
  WHEN bool_and(regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}')) THEN 'DATE'
  WHEN MAX(length({c})) <= 50 THEN 'VARCHAR(100)' WHEN MAX(length({c})) <= 100 THEN 'VARCHAR(200)'
  WHEN MAX(length({c})) <= 255 THEN 'VARCHAR(500)' WHEN MAX(length({c})) <= 1000 THEN 'VARCHAR(2000)'
  ELSE 'VARCHAR(65533)' END AS type
FROM decoded WHERE src_file = (SELECT MIN(src_file) FROM decoded)"""


_INFERRED = _union(_infer_sql(i, c) for i, c in enumerate(COLUMNS, 1))


@query("infer_schema", ORACLE + _INFERRED)
def infer_schema(spark, sf_dir):
    return infer.infer_schema(first_file(decoded(spark, sf_dir)).select(*COLUMNS))


_TYPED = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "typed_source_schema",
    "SELECT CAST(position AS INTEGER) AS position, \"column\", type FROM (VALUES "
    + ", ".join(f"({i}, '{c}', (SELECT ANY_VALUE({{{c}}}) FROM events))" for i, c in enumerate(_TYPED, 1)).format(
        event_id=_ladder("MIN(event_id)", "MAX(event_id)"), user_id=_ladder("MIN(user_id)", "MAX(user_id)"), ts="'DATETIME'", value="'DOUBLE'",
        event_type="'VARCHAR(100)'", props="'VARCHAR(100)'",
    ).replace("ANY_VALUE(CASE", "(CASE")
    + ') t(position, "column", type)',
)
def typed_source_schema(spark, sf_dir):
    """Types of a table whose columns have types already: times stay times, numbers get their width."""
    return infer.infer_schema(table(spark, sf_dir, "events").select(*_TYPED))


@query(
    "inferred_ddl",
    ORACLE + f", inferred AS ({_INFERRED}) SELECT 'CREATE TABLE IF NOT EXISTS `main_data_table` (`id` BIGINT NOT NULL, ' || "
    "string_agg('`' || \"column\" || '` ' || type, ', ' ORDER BY position) || ') USING parquet CLUSTERED BY (`id`) INTO 3 BUCKETS' AS ddl FROM inferred",
)
def inferred_ddl(spark, sf_dir):
    schema = infer_schema(spark, sf_dir)
    entry = F.struct("position", F.concat(F.lit("`"), "column", F.lit("` "), "type").alias("text"))
    parts = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])  # one entry per column
    head, tail = infer.table_ddl("main_data_table", {}).split("NOT NULL")
    return schema.agg(
        F.concat(F.lit(head + "NOT NULL, "), F.array_join(parts, ", "), F.lit(tail)).alias("ddl")
    )


# --- cleaning -----------------------------------------------------------------

_RAW_HEADER = "CONCAT(' ', p_name, '.', p_type, ' (', p_brand, '/x) ')"


@query(
    "normalize_headers",
    f"SELECT p_partkey, {_RAW_HEADER} AS header, REPLACE(REPLACE(REPLACE(REPLACE(LOWER(TRIM({_RAW_HEADER})), ' ', '_'), '.', '_'), '(', ''), ')', '') AS name, TRUE AS renamed FROM part",
)
def normalize_headers(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(_RAW_HEADER).alias("header"))
    name = clean_header(F.col("header"))
    return part.select("p_partkey", "header", name.alias("name"), (name != F.col("header")).alias("renamed"))


_CLEAN = "REPLACE(LOWER(p_name), ' ', '_')"


@query(
    "header_collisions",
    f"SELECT p_partkey, {_CLEAN} || '|' || {_CLEAN} || '.1|' || LOWER(p_brand) || '|' || {_CLEAN} || '_1|unnamed:_4|' || {_CLEAN} || '_1.1' AS columns FROM part",
)
def header_collisions(spark, sf_dir):
    """Every part as a file header with repeated, empty and colliding names."""
    name, shouted = F.col("p_name"), F.upper("p_name")
    header = F.array(name, shouted, F.col("p_brand"), name, F.lit(""), shouted)
    part = table(spark, sf_dir, "part").select("p_partkey", header.alias("header"))
    return part.select("p_partkey", F.array_join(table_columns_of(F.col("header")), "|").alias("columns"))


@query("dedupe_rows", ORACLE + f"SELECT src_file, pos, copies, {', '.join(COLUMNS)} FROM deduped")
def dedupe_rows(spark, sf_dir):
    rows = deduped(spark, sf_dir)
    return rows.select(FILE, POS, "copies", *clean.as_written(rows, COLUMNS))


@query("duplicate_count", ORACLE + "SELECT src_file, CAST(SUM(copies - 1) AS BIGINT) AS duplicates FROM deduped GROUP BY src_file")
def duplicate_count(spark, sf_dir):
    return deduped(spark, sf_dir).groupBy(FILE).agg(F.sum(F.col("copies") - 1).alias("duplicates"))


@query("null_counts", ORACLE + _union(f"SELECT src_file, '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls FROM deduped GROUP BY src_file" for c in COLUMNS))
def null_counts(spark, sf_dir):
    return clean.null_counts(deduped(spark, sf_dir), COLUMNS, [FILE])


@query("null_fill", ORACLE + f"SELECT src_file, pos, {', '.join(f'COALESCE({c}, {chr(39)}NULL{chr(39)}) AS {c}' for c in COLUMNS)} FROM deduped")
def null_fill(spark, sf_dir):
    rows = deduped(spark, sf_dir)
    return clean.fill_nulls(rows.select(FILE, POS, *clean.as_written(rows, COLUMNS)), COLUMNS)


@query(
    "column_samples",
    ORACLE + _union(
        f"SELECT src_file, '{c}' AS \"column\", string_agg(COALESCE({c}, 'NULL'), '|' ORDER BY ordinal) AS samples FROM numbered WHERE ordinal <= 3 GROUP BY src_file" for c in COLUMNS
    ),
)
def column_samples(spark, sf_dir):
    rows = ids.number_rows(deduped(spark, sf_dir), FILE, POS)
    return clean.column_samples(rows, FILE, ids.ORDINAL, COLUMNS)


# --- row checks ---------------------------------------------------------------


def _check_one(spark, sf_dir, column: str, sql_type: str) -> DataFrame:
    types = {column: sql_type}
    rows = decoded(spark, sf_dir).select(FILE, POS, column)
    checked = validate.typed_values(validate.check_rows(rows, types), types, "value_of_")
    value = F.col(f"value_of_{column}")
    return checked.select(
        FILE, POS, F.col(column).alias("text"), (value.cast("string") if sql_type == "DATE" else value).alias("value"), validate.fault_message().alias("error")
    )


def _check_sql(column: str, kind: str, value: str) -> str:
    return (
        ORACLE + f"SELECT src_file, pos, {column} AS text, {value} AS value, CASE WHEN {column} IS NOT NULL AND {value} IS NULL THEN "
        f"'Column ''{column}'' expects {kind}, got ''' || {column} || '''' END AS error FROM decoded"
    )


_INT_SQL = "TRY_CAST(TRUNC(TRY_CAST(TRIM(cust) AS DOUBLE)) AS BIGINT)"


@query("validate_int", _check_sql("cust", "INT", _INT_SQL))
def validate_int(spark, sf_dir):
    return _check_one(spark, sf_dir, "cust", "BIGINT")


@query("validate_float", _check_sql("price", "FLOAT", "TRY_CAST(TRIM(price) AS DOUBLE)"))
def validate_float(spark, sf_dir):
    return _check_one(spark, sf_dir, "price", "DOUBLE")


_DATE_SQL = "CAST(" + dirty._DATE + " AS VARCHAR)"


@query("validate_date", _check_sql("odate", "DATE", _DATE_SQL))
def validate_date(spark, sf_dir):
    return _check_one(spark, sf_dir, "odate", "DATE")


@query(
    "validate_rows",
    ORACLE + "SELECT src_file, COUNT(CASE WHEN error IS NULL THEN 1 END) AS good, COUNT(error) AS bad FROM messages GROUP BY src_file",
)
def validate_rows(spark, sf_dir):
    rows, _ = staged(spark, sf_dir)
    fault = F.col(validate.FAULT)
    return rows.groupBy(FILE).agg(F.count_if(fault.isNull()).alias("good"), F.count_if(fault.isNotNull()).alias("bad"))


@query("first_error", ORACLE + "SELECT src_file, pos, error_column, error FROM messages WHERE error IS NOT NULL")
def first_error(spark, sf_dir):
    rows, types = staged(spark, sf_dir)
    return validate.bad_rows(rows, types, [FILE, POS]).select(FILE, POS, "error_column", "error")


def _bad(spark, sf_dir) -> DataFrame:
    rows, types = numbered(spark, sf_dir)
    return validate.bad_rows(rows, types, [FILE, ids.ORDINAL])


def _message():
    return F.concat(F.lit("Row "), (F.col(ids.ORDINAL) + 1).cast("string"), F.lit(": "), F.col("error"))


@query("error_row_numbers", ORACLE + "SELECT src_file, ordinal + 1 AS row_number, 'Row ' || (ordinal + 1) || ': ' || error AS message FROM messages WHERE error IS NOT NULL")
def error_row_numbers(spark, sf_dir):
    return _bad(spark, sf_dir).select(FILE, (F.col(ids.ORDINAL) + 1).alias("row_number"), _message().alias("message"))


@query(
    "error_sample",
    ORACLE + "SELECT src_file, error_no, 'Row ' || (ordinal + 1) || ': ' || error AS message FROM (SELECT *, row_number() OVER (PARTITION BY src_file ORDER BY ordinal) AS error_no "
    "FROM messages WHERE error IS NOT NULL) WHERE error_no <= 5",
)
def error_sample(spark, sf_dir):
    sample = validate.error_sample(_bad(spark, sf_dir), FILE, ids.ORDINAL)
    return sample.select(FILE, F.col("error_no").cast("long").alias("error_no"), _message().alias("message"))


@query("error_breakdown", ORACLE + "SELECT src_file, error_column, expected, COUNT(*) AS errors FROM messages WHERE error IS NOT NULL GROUP BY ALL")
def error_breakdown(spark, sf_dir):
    rows, types = staged(spark, sf_dir)
    return validate.error_breakdown(validate.bad_rows(rows, types, [FILE]), FILE)


@query("quarantine_rows", ORACLE + f"SELECT src_file, ordinal, {', '.join(COLUMNS)}, error FROM messages WHERE error IS NOT NULL")
def quarantine_rows(spark, sf_dir):
    return _bad(spark, sf_dir).select(FILE, ids.ORDINAL, *COLUMNS, "error")


# --- ids and loads ------------------------------------------------------------


@query("surrogate_ids", ORACLE + "SELECT src_file, pos, ordinal, id, error IS NULL AS good FROM loaded")
def surrogate_ids(spark, sf_dir):
    rows, _ = numbered(spark, sf_dir)
    return rows.select(FILE, POS, ids.ORDINAL, "id", F.col(validate.FAULT).isNull().alias("good"))


@query("max_id", ORACLE + "SELECT COALESCE(MAX(id), 0) AS max_id FROM loaded WHERE error IS NULL")
def max_id(spark, sf_dir):
    rows, _ = numbered(spark, sf_dir)
    return ids.max_id(rows.where(F.col(validate.FAULT).isNull()))


@query(
    "load_good_rows",
    ORACLE + "SELECT id, src_file, price_value AS price, CAST(odate_value AS VARCHAR) AS odate, cust_value AS cust, CAST(qty AS BIGINT) AS qty, "
    "flag = 'True' AS flag, status, note FROM loaded WHERE error IS NULL",
)
def load_good_rows(spark, sf_dir):
    rows, types = numbered(spark, sf_dir)
    good = validate.good_rows(rows, types, ["id", FILE])
    return good.withColumns({"odate": F.col("odate").cast("string"), "cust": F.col("cust").cast("long"), "qty": F.col("qty").cast("long")})


# --- audits -------------------------------------------------------------------

_NULLS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in COLUMNS)


@query(
    "file_audit",
    ORACLE + f"SELECT src_file, CAST(SUM(copies) AS BIGINT) AS rows_in, CAST({len(COLUMNS)} AS BIGINT) AS columns, CAST(SUM(copies - 1) AS BIGINT) AS duplicates_removed, "
    f"CAST(SUM({_NULLS}) AS BIGINT) AS nulls, COUNT(*) AS rows_staged FROM deduped GROUP BY src_file",
)
def file_audit(spark, sf_dir):
    return audit.transform_audit(deduped(spark, sf_dir), FILE, COLUMNS)


@query("load_audit", ORACLE + "SELECT src_file, COUNT(*) - COUNT(error) AS rows_loaded, COUNT(error) AS rows_bad FROM messages GROUP BY src_file")
def load_audit(spark, sf_dir):
    rows, _ = staged(spark, sf_dir)
    return audit.load_audit(rows, FILE, F.col(validate.FAULT).isNull())


@query(
    "run_summary",
    ORACLE + "SELECT COUNT(DISTINCT src_file) AS files_seen, COUNT(DISTINCT src_file) AS files_loaded, CAST(0 AS BIGINT) AS files_mismatched, "
    "CAST(0 AS BIGINT) AS files_unreadable, COUNT(*) - COUNT(error) AS rows_loaded, COUNT(error) AS rows_bad FROM messages",
)
def run_summary(spark, sf_dir):
    return audit.run_summary(load_audit(spark, sf_dir).withColumn("status", F.lit("loaded")))
