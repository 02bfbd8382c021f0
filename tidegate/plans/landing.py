"""A landing folder written from the orders table, for queries about files.

Orders go into CSV files by key, at most about ten thousand files of at least a
thousand orders, so a file grows with the data and one task writes one file.
Every seventh file each has its columns in another order, belongs to another
schema, or holds a row that is too long. The rows are described once, as SQL that
Spark and DuckDB both run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.plans.dirty import table
from tidegate.session import scratch_path

REORDERED, OTHER, RAGGED = 3, 4, 5
LEAST_ORDERS = 1000
MOST_FILES = 10_000

# Raw headers, with the spelling a table does not want.
HEADER = {"price": "Order Price (usd)", "odate": "Order Date", "cust": "Cust.Key", "status": "Status "}
COLUMNS = {"price": "order_price_usd", "odate": "order_date", "cust": "cust_key", "status": "status"}
OTHER_HEADER = {"price": "Order Price (usd)", "clerk": "Clerk"}


def _copy(number: int) -> str:
    return f"""
SELECT file_no, CONCAT('orders_', LPAD(CAST(file_no AS VARCHAR(20)), 6, '0'), '.csv') AS file,
       o_orderkey * 2 + {number} AS pos, o_orderkey,
       CASE WHEN o_orderkey % 97 = 0 THEN 'twenty'
            WHEN o_orderkey % 89 = 0 THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(40)) END AS price,
       CASE WHEN o_orderkey % 101 = 0 THEN '1997-13-45'
            WHEN o_orderkey % 103 = 0 AND file_no > 0 THEN '10/02/1997'
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) END AS odate,
       CASE WHEN o_orderkey % 109 = 0 THEN 'unknown'
            WHEN o_orderkey % 13 = 0 AND file_no > 0 THEN CONCAT(CAST(o_custkey AS VARCHAR(20)), '.9')
            WHEN o_orderkey % 11 = 0 THEN CONCAT(' ', CAST(o_custkey AS VARCHAR(20)), ' ')
            ELSE CAST(o_custkey AS VARCHAR(20)) END AS cust,
       CASE WHEN o_orderkey % 83 = 0 THEN 'N/A'
            WHEN o_orderkey % 71 = 0 THEN CONCAT(o_orderstatus, ', "late"')
            ELSE o_orderstatus END AS status,
       CONCAT('Clerk#', CAST(o_custkey % 100 AS VARCHAR(20))) AS clerk
FROM placed"""


def rows_sql(source: str, file_no: str) -> str:
    placed = f"WITH placed AS (SELECT *, {file_no} AS file_no FROM {source})"
    return placed + _copy(0) + "\nUNION ALL" + _copy(1) + " WHERE o_orderkey % 50 = 0"


ORACLE_ROWS = rows_sql(
    "orders",
    f"o_orderkey // GREATEST({LEAST_ORDERS}, (SELECT MAX(o_orderkey) + 1 FROM orders) // {MOST_FILES})",
)


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    size = max(LEAST_ORDERS, (top + 1) // MOST_FILES)
    return spark.sql(rows_sql("{orders}", f"o_orderkey div {size}"), orders=orders)


def _write_csv(rows: DataFrame, header: dict[str, str], path: str) -> None:
    """One CSV file per landing file, in folders named after it."""
    placed = rows.repartition("file").sortWithinPartitions("file", "pos")
    named = placed.select("file", *[F.col(c).alias(h) for c, h in header.items()])
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    named.write.partitionBy("file").options(**options).csv(path)


def _write_ragged(rows: DataFrame, path: str) -> None:
    """Files with one row that has a field too many, written as lines."""
    quoted = F.when(F.col("status").contains(","), F.concat(F.lit('"'), F.replace("status", F.lit('"'), F.lit('""')), F.lit('"')))
    fields = [F.coalesce(c, F.lit("")) for c in ("price", "odate", "cust")] + [F.coalesce(quoted, "status")]
    surplus = F.when(F.col("o_orderkey") % 500 == 250, ",surplus").otherwise("")
    lines = rows.select("file", "pos", F.concat(F.concat_ws(",", *fields), surplus).alias("line"))
    head = rows.select("file").distinct().select("file", F.lit(-1).cast("long").alias("pos"), F.lit(",".join(HEADER.values())).alias("line"))
    every = head.unionByName(lines).repartition("file").sortWithinPartitions("file", "pos")
    every.select("file", "line").write.partitionBy("file").text(path)


def _land(spark: SparkSession, parts: list[str], landing: str) -> None:
    """Give every written file its landing name (a rename each, at most ``MOST_FILES``)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(landing)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for part in parts:
        for status in system.globStatus(hadoop.Path(f"{part}/file=*/part-*")):
            source = status.getPath()
            name = source.getParent().getName().removeprefix("file=")
            system.rename(source, hadoop.Path(target, name))


def texts_landing(spark: SparkSession, sf_dir: str) -> str:
    """All documents as one CSV file per source, in order of their ids, line ends and quotes in the texts kept."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.concat("source", F.lit(".csv")).alias("file"), F.col("doc_id").alias("pos"), "doc_id", "text", "lang")
    work, target = scratch_path(spark, "parts"), scratch_path(spark, "texts")
    _write_csv(rows.where(F.col("source").isNotNull()), {c: c for c in ("doc_id", "text", "lang")}, work)
    _land(spark, [work], target)
    return target


# What is wrong with every seventh file of the poisoned folder; the others are fine. A
# file of kind SPREAD has a line end inside quotes, which is no fault.
POISONS = {1: "not UTF-8", 2: "row longer than the header", 3: "unterminated quote", 4: "row longer than the header", 5: "empty file"}
BAD_BYTES, MANY_FIELDS, OPEN_QUOTE, MOST_FIELDS, NO_BYTES, SPREAD = 1, 2, 3, 4, 5, 6


def poisoned_landing(spark: SparkSession, sf_dir: str) -> str:
    """All orders as CSV files of a key and a status, most files with one fault in one of their rows."""
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    size = max(LEAST_ORDERS, (top + 1) // MOST_FILES)
    rows = orders.select(F.floor(F.col("o_orderkey") / size).alias("file_no"), F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    rows = rows.withColumn("kind", F.col("file_no") % 7).withColumn("last", F.max("key").over(W.partitionBy("file_no")) == F.col("key"))
    plain, kind = F.concat_ws(",", "key", "status"), F.col("kind")
    over = F.concat(F.col("key").cast("string"), F.lit(',"two\nlines"'))
    spoiled = (
        F.when(kind == BAD_BYTES, F.concat(plain.cast("binary"), F.unhex(F.lit("FFFE"))).cast("string"))
        .when(kind == MANY_FIELDS, F.repeat(F.lit("9,"), 25_000))
        .when(kind == OPEN_QUOTE, F.concat(F.col("key").cast("string"), F.lit(',"no end')))
        .when(kind == MOST_FIELDS, F.concat(over, F.lit("\n"), F.repeat(F.lit("9,"), 1_050_000)))
        .when(kind == SPREAD, over)
        .otherwise(plain)
    )
    line = F.when(F.col("last"), spoiled).otherwise(plain)
    named = rows.where(kind != NO_BYTES).select(F.concat(F.lit("orders_"), F.lpad(F.col("file_no").cast("string"), 6, "0"), F.lit(".csv")).alias("file"), F.col("key").alias("pos"), line.alias("line"))
    head = named.select("file").distinct().select("file", F.lit(-1).cast("long").alias("pos"), F.lit("key,status").alias("line"))
    work, target = scratch_path(spark, "parts"), scratch_path(spark, "poisoned")
    every = named.unionByName(head).repartition("file").sortWithinPartitions("file", "pos")
    every.select("file", "line").write.partitionBy("file").text(work)
    _land(spark, [work], target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in rows.where(kind == NO_BYTES).select("file_no").distinct().collect():  # MOST_FILES at most
        system.create(hadoop.Path(target, f"orders_{r['file_no']:06d}.csv")).close()
    return target


_landed: dict[tuple[str, str], str] = {}


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The landing folder of a data set, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        rows = landing_rows(spark, sf_dir)
        kind = F.col("file_no") % 7
        work, target = scratch_path(spark, "parts"), scratch_path(spark, "landing")
        _write_csv(rows.where(~kind.isin(REORDERED, OTHER, RAGGED)), HEADER, f"{work}/usual")
        _write_csv(rows.where(kind == REORDERED), dict(reversed(HEADER.items())), f"{work}/reordered")
        _write_csv(rows.where(kind == OTHER), OTHER_HEADER, f"{work}/other")
        _write_ragged(rows.where(kind == RAGGED), f"{work}/ragged")
        _land(spark, [f"{work}/{k}" for k in ("usual", "reordered", "other", "ragged")], target)
        _landed[key] = target
    return _landed[key]
