"""The dirty view: orders as untidy text rows of four landing files.

The text of the view is valid in Spark and in DuckDB, so the queries and their
oracle SQL start from the same rows. Faults are planted by key: words among
numbers, impossible dates, null tokens, blanks, and repeated rows that differ
only in how their numbers are written. ``data_1.csv`` holds half of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.plans.expected import NULL_TOKENS, VOTE_PATTERN
from tidegate.session import tune

FILE = "src_file"
POS = "pos"
COLUMNS = ["price", "odate", "cust", "qty", "flag", "status", "note"]

_FIRST = "(o_orderkey % 3 = 0 OR o_orderkey % 4 = 0)"


def _rows(copy: int) -> str:
    qty = "CAST(o_orderkey % 50 AS VARCHAR(20))"
    padded = f"CONCAT(' ', {qty}, '  ')"
    true_word, false_word = ("'True'", "'false'") if copy == 0 else ("'TRUE'", "'False'")
    return f"""
SELECT CASE WHEN {_FIRST} THEN 'data_1.csv'
            ELSE CONCAT('data_', CAST(o_orderkey % 4 + 1 AS VARCHAR(20)), '.csv') END AS src_file,
       o_orderkey * 2 + {copy} AS pos,
       CASE WHEN o_orderkey % 97 = 0 THEN 'twenty'
            WHEN o_orderkey % 89 = 0 THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(40)) END AS price,
       CASE WHEN o_orderkey % 101 = 0 THEN '1997-13-45'
            WHEN o_orderkey % 103 = 0 AND NOT {_FIRST} THEN '10/02/1997'
            WHEN o_orderkey % 107 = 0 AND NOT {_FIRST} THEN 'soon'
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) END AS odate,
       CASE WHEN o_orderkey % 109 = 0 THEN 'unknown'
            WHEN o_orderkey % 211 = 0 AND NOT {_FIRST} THEN 'inf'
            WHEN o_orderkey % 13 = 0 AND NOT {_FIRST} THEN CONCAT(CAST(o_custkey AS VARCHAR(20)), '.9')
            WHEN o_orderkey % 11 = 0 THEN CONCAT(' ', CAST(o_custkey AS VARCHAR(20)), ' ')
            ELSE CAST(o_custkey AS VARCHAR(20)) END AS cust,
       CASE WHEN o_orderkey % 7 = {copy * 3} THEN {padded} ELSE {qty} END AS qty,
       CASE WHEN o_orderkey % 2 = 0 THEN {true_word} ELSE {false_word} END AS flag,
       CASE WHEN o_orderkey % 83 = 0 THEN 'N/A'
            WHEN o_orderkey % 79 = 0 THEN '<NA>'
            ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN 'None' ELSE '' END AS note
FROM orders"""


RAW_SQL = _rows(0) + "\nUNION ALL" + _rows(1) + " WHERE o_orderkey % 50 = 0"

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
_DECODED = ", ".join(f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" for c in COLUMNS)
_NAMES = ", ".join(COLUMNS)

# Oracle side only, in DuckDB's dialect: the stages of a load as named subqueries.
VOTE = "'" + VOTE_PATTERN + "'"
_DATE = """CASE WHEN regexp_full_match(odate, '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(odate AS DATE)
     WHEN regexp_full_match(odate, '\\d{1,2}/\\d{1,2}/\\d{4}') THEN CAST(try_strptime(odate, '%m/%d/%Y') AS DATE) END"""
_CUST = "TRY_CAST(TRUNC(TRY_CAST(TRIM(cust) AS DOUBLE)) AS BIGINT)"

ORACLE = f"""
WITH raw AS ({RAW_SQL}),
decoded AS (SELECT src_file, pos, {_DECODED} FROM raw),
as_read AS (
  SELECT src_file, pos, price, odate, cust, CAST(CAST(TRIM(qty) AS BIGINT) AS VARCHAR) AS qty,
         CASE WHEN LOWER(flag) = 'true' THEN 'True' ELSE 'False' END AS flag, status, note
  FROM decoded),
deduped AS (
  SELECT src_file, MIN(pos) AS pos, COUNT(*) AS copies, {_NAMES}
  FROM as_read GROUP BY src_file, {_NAMES}),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY src_file ORDER BY pos) AS ordinal FROM deduped),
typed AS (
  SELECT *,
    CASE WHEN regexp_full_match(TRIM(price), {VOTE}) THEN TRY_CAST(TRIM(price) AS DOUBLE) END AS price_value,
    {_DATE} AS odate_value, {_CUST} AS cust_value
  FROM numbered),
checked AS (
  SELECT *,
    CASE WHEN price IS NOT NULL AND price_value IS NULL THEN 'price'
         WHEN odate IS NOT NULL AND odate_value IS NULL THEN 'odate'
         WHEN cust IS NOT NULL AND cust_value IS NULL THEN 'cust' END AS error_column
  FROM typed),
judged AS (
  SELECT *,
    CASE error_column WHEN 'price' THEN 'FLOAT' WHEN 'odate' THEN 'DATE' WHEN 'cust' THEN 'INT' END AS expected,
    CASE error_column WHEN 'price' THEN price WHEN 'odate' THEN odate WHEN 'cust' THEN cust END AS bad_value
  FROM checked),
messages AS (
  SELECT *, CASE WHEN error_column IS NOT NULL THEN
      'Column ''' || error_column || ''' expects ' || expected || ', got ''' || bad_value || '''' END AS error
  FROM judged),
reach AS (
  SELECT src_file, COALESCE(MAX(CASE WHEN error_column IS NULL THEN ordinal END), 0) AS reach
  FROM messages GROUP BY src_file),
bases AS (
  SELECT src_file, COALESCE(SUM(reach) OVER (ORDER BY src_file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
  FROM reach),
loaded AS (
  SELECT m.*, CAST(b.base + m.ordinal AS BIGINT) AS id FROM messages m JOIN bases b ON m.src_file = b.src_file)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty view as a CSV reader would see it, null tokens included."""
    tune(spark)
    return spark.sql(RAW_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
