"""Registered queries of the table profile, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import clean, profile
from tidegate.plans import dirty
from tidegate.plans.dirty import table
from tidegate.plans.expected import NULL_TOKENS
from tidegate.sources import tables

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.decode_nulls(dirty.raw(spark, sf_dir), dirty.COLUMNS)


@query(
    "profile_nulls",
    dirty.ORACLE
    + _union(
        [
            f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls, "
            f"ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 4) AS null_pct FROM decoded"
            for c in dirty.COLUMNS
        ]
    ),
)
def profile_nulls(spark, sf_dir):
    return _rounded(profile.column_nulls(_decoded(spark, sf_dir), dirty.COLUMNS), "null_pct")


def _numeric_sql(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", ROUND(MIN({column}), 4) AS min_value, ROUND(MAX({column}), 4) AS max_value, "
        f"ROUND(AVG({column}), 4) AS mean, ROUND(quantile_cont({column}, 0.5), 4) AS median FROM lineitem"
    )


@query("profile_numeric", _union([_numeric_sql(c) for c in _NUMBERS]))
def profile_numeric(spark, sf_dir):
    out = profile.numeric_summary(table(spark, sf_dir, "lineitem"), _NUMBERS).drop("least", "greatest", "middle")
    return _rounded(out, "min_value", "max_value", "mean", "median")


# Keys moved beyond what doubles tell apart, and prices as decimals.
_WIDE = "SELECT 9007199254740993 + {key} AS wide, -9223372036854775807 + {key} AS least, CAST(o_totalprice AS DECIMAL(15,2)) AS price, CAST(o_custkey AS INT) AS customer FROM {orders}"
_WIDE_COLUMNS = ["wide", "least", "price", "customer"]


def _exact_sql(c: str) -> str:
    middle = f"""(SELECT list_aggregate(list_slice(list_sort(list({c})), (COUNT({c}) + 1) // 2, COUNT({c}) // 2 + 1), 'min') FROM wide)"""
    upper = f"""(SELECT list_aggregate(list_slice(list_sort(list({c})), (COUNT({c}) + 1) // 2, COUNT({c}) // 2 + 1), 'max') FROM wide)"""
    half = f"(CAST({middle} AS DECIMAL(38, 4)) + CAST({upper} AS DECIMAL(38, 4))) * 0.5"

    def bare(value: str) -> str:
        return f"rtrim(rtrim(CAST(CAST({value} AS DECIMAL(38, 4)) AS VARCHAR), '0'), '.')"

    return f"SELECT '{c}' AS \"column\", {bare(f'MIN({c})')} AS least, {bare(f'MAX({c})')} AS greatest, {bare(half)} AS middle FROM wide"


@query(
    "profile_exact",
    f"WITH wide AS ({_WIDE.format(key='o_orderkey', orders='orders')}) " + _union([_exact_sql(c) for c in _WIDE_COLUMNS]),
)
def profile_exact(spark, sf_dir):
    """Ranges and medians of long integers and decimals with all their digits."""
    wide = spark.sql(_WIDE.replace("{key}", "o_orderkey"), orders=table(spark, sf_dir, "orders"))
    return profile.numeric_summary(wide, _WIDE_COLUMNS).select("column", "least", "greatest", "middle")


_EVENT_NUMBERS = ["event_id", "user_id", "value"]


@query(
    "outliers_3sigma",
    _union(
        [
            f"SELECT '{c}' AS \"column\", COUNT(*) AS outliers FROM events, "
            f"(SELECT AVG({c}) AS m, stddev_samp({c}) AS s FROM events) WHERE {c} < m - 3 * s OR {c} > m + 3 * s"
            for c in _EVENT_NUMBERS
        ]
    ),
)
def outliers_3sigma(spark, sf_dir):
    return profile.outliers(table(spark, sf_dir, "events"), _EVENT_NUMBERS)


# All text columns of these tables.
_DISTINCT = {"orders": ["o_orderstatus", "o_orderpriority"], "documents": ["lang", "source", "text"], "pages": ["url", "html"], "customer": ["c_name", "c_mktsegment"]}


@query(
    "profile_distinct",
    _union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS \"column\", COUNT(DISTINCT {c}) AS distinct_values FROM {t}"
            for t, columns in _DISTINCT.items()
            for c in columns
        ]
    ),
)
def profile_distinct(spark, sf_dir):
    parts = [
        profile.distinct_values(table(spark, sf_dir, t), columns).select(
            F.lit(t).alias("table_name"), "column", "distinct_values"
        )
        for t, columns in _DISTINCT.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_MODE_COLUMNS = ["l_returnflag", "l_linestatus"]
_ORDER_TEXTS = ["o_orderstatus", "o_orderpriority"]
_DOCUMENT_TEXTS = ["text", "lang", "source"]


def _mode_sql(t: str, c: str) -> str:
    return (
        f"(SELECT '{c}' AS \"column\", {c} AS mode, COUNT(*) AS occurrences FROM {t} WHERE {c} IS NOT NULL "
        f"AND (SELECT COUNT(DISTINCT {c}) FROM {t}) <= 10 GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"
    )


@query("profile_mode", _union([_mode_sql(t, c) for t, columns in (("orders", _ORDER_TEXTS), ("lineitem", _MODE_COLUMNS), ("documents", _DOCUMENT_TEXTS)) for c in columns]))
def profile_mode(spark, sf_dir):
    orders = profile.column_modes(table(spark, sf_dir, "orders"), _ORDER_TEXTS)
    lineitem = profile.column_modes(table(spark, sf_dir, "lineitem"), _MODE_COLUMNS)
    documents = profile.column_modes(table(spark, sf_dir, "documents"), _DOCUMENT_TEXTS)
    return orders.unionByName(lineitem).unionByName(documents)


_REPEATED = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "profile_duplicates",
    _union(
        [
            f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT(DISTINCT {c}) - MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS duplicates, "
            f"ROUND((COUNT(*) - COUNT(DISTINCT {c}) - MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) * 100.0 / COUNT(*), 4) AS duplicate_pct FROM customer"
            for c in _REPEATED
        ]
    ),
)
def profile_duplicates(spark, sf_dir):
    return _rounded(profile.repeated_values(table(spark, sf_dir, "customer"), _REPEATED), "duplicate_pct")


@query(
    "table_totals",
    dirty.ORACLE
    + "SELECT COUNT(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns, CAST("
    + " + ".join(f"COUNT(*) - COUNT({c})" for c in dirty.COLUMNS)
    + " AS BIGINT) AS missing_values FROM decoded",
)
def table_totals(spark, sf_dir):
    return profile.table_totals(_decoded(spark, sf_dir))


_SIZE_SQL = {
    "doc_id": "COUNT(*) * 8",
    "text": "SUM(octet_length(encode(text)))",
    "lang": "SUM(octet_length(encode(lang)))",
    "source": "SUM(octet_length(encode(source)))",
    "n_chars": "COUNT(*) * 8",
}


@query(
    "data_size",
    _union([f"SELECT '{c}' AS \"column\", CAST({e} AS BIGINT) AS bytes FROM documents" for c, e in _SIZE_SQL.items()]),
)
def data_size(spark, sf_dir):
    return profile.data_size(table(spark, sf_dir, "documents"))


_TOP = ["event_type", "props"]


@query(
    "top_values",
    _union(
        [
            f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n, "
            f"row_number() OVER (ORDER BY COUNT(*) DESC, {c}) AS rank FROM events GROUP BY {c}) WHERE rank <= 10"
            for c in _TOP
        ]
    ),
)
def top_values(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "events"), _TOP).withColumn("rank", F.col("rank").cast("long"))


def _histogram_sql(c: str, t: str = "lineitem") -> str:
    return (
        f"SELECT '{c}' AS \"column\", CAST(LEAST(FLOOR(({c} - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, COUNT(*) AS n "
        f"FROM {t}, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {t}) GROUP BY 2"
    )


@query("histogram", _union([_histogram_sql(c) for c in _NUMBERS]))
def histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "lineitem"), _NUMBERS)


def _box_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", ROUND(ANY_VALUE(q1), 4) AS q1, ROUND(ANY_VALUE(q2), 4) AS median, ROUND(ANY_VALUE(q3), 4) AS q3, "
        f"ROUND(ANY_VALUE(q1 - 1.5 * (q3 - q1)), 4) AS low_fence, ROUND(ANY_VALUE(q3 + 1.5 * (q3 - q1)), 4) AS high_fence, "
        f"COUNT(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outside FROM lineitem, "
        f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"
    )


@query("box_stats", _union([_box_sql(c) for c in _NUMBERS]))
def box_stats(spark, sf_dir):
    out = profile.box_summary(table(spark, sf_dir, "lineitem"), _NUMBERS)
    return _rounded(out, "q1", "median", "q3", "low_fence", "high_fence")


_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1 :]]


@query(
    "correlation",
    _union(
        [
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
            f"ROUND(covar_pop({a}, {b}) / NULLIF(stddev_pop({a}) * stddev_pop({b}), 0), 4) + 0.0 AS r FROM lineitem"
            for a, b in _PAIRS
        ]
    ),
)
def correlation(spark, sf_dir):
    out = profile.correlation(table(spark, sf_dir, "lineitem"), _NUMBERS)
    return out.withColumn("r", F.round("r", 4) + F.lit(0.0))


@query(
    "quality_score",
    dirty.ORACLE
    + f"""
, folded AS (SELECT COUNT(*) AS n, src_file, {", ".join(dirty.COLUMNS)} FROM as_read GROUP BY src_file, {", ".join(dirty.COLUMNS)}),
sums AS (SELECT SUM(n) AS rows, COUNT(*) AS different, SUM(n * ({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in dirty.COLUMNS)})) AS nulls FROM folded),
scores AS (SELECT 100 - nulls * 100.0 / (rows * 8) AS completeness, 100 - (rows - different) * 100.0 / rows AS uniqueness FROM sums)
SELECT ROUND(CAST(completeness AS DOUBLE), 4) AS completeness, ROUND(CAST(uniqueness AS DOUBLE), 4) AS uniqueness,
  ROUND(CAST((completeness + uniqueness) / 2 AS DOUBLE), 4) AS overall,
  CASE WHEN (completeness + uniqueness) / 2 >= 80 THEN 'green' WHEN (completeness + uniqueness) / 2 >= 60 THEN 'yellow' ELSE 'red' END AS light
FROM scores""",
)
def quality_score(spark, sf_dir):
    decoded = _decoded(spark, sf_dir)
    as_read = clean.reading_kinds(decoded, dirty.FILE, dirty.COLUMNS).apply(decoded)
    return _rounded(profile.quality_score(as_read, exclude=["pos"]), "completeness", "uniqueness", "overall")


_CUSTOMER_NUMBERS, _CUSTOMER_TEXTS = ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"]


def _profile_sql() -> str:
    def one(column: str, metric: str, value: str) -> str:
        return f"SELECT '{column}' AS \"column\", '{metric}' AS metric, ROUND(CAST({value} AS DOUBLE), 4) AS value, CAST(NULL AS VARCHAR) AS text FROM customer"

    parts = []
    for c in _CUSTOMER_NUMBERS + _CUSTOMER_TEXTS:
        again = f"COUNT(*) - COUNT(DISTINCT {c}) - MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
        parts += [one(c, "nulls", f"COUNT(*) - COUNT({c})"), one(c, "null_pct", f"(COUNT(*) - COUNT({c})) * 100.0 / COUNT(*)")]
        parts += [one(c, "duplicates", again), one(c, "duplicate_pct", f"({again}) * 100.0 / COUNT(*)")]
    for c in _CUSTOMER_NUMBERS:
        parts += [one(c, "min_value", f"MIN({c})"), one(c, "max_value", f"MAX({c})"), one(c, "mean", f"AVG({c})"), one(c, "median", f"quantile_cont({c}, 0.5)")]
        far = f"{c} < m - 3 * s OR {c} > m + 3 * s"
        parts.append(one(c, "outliers", f"COUNT(CASE WHEN {far} THEN 1 END)") + f", (SELECT AVG({c}) AS m, stddev_samp({c}) AS s FROM customer)")
    parts += [one(c, "distinct_values", f"COUNT(DISTINCT {c})") for c in _CUSTOMER_TEXTS]
    for c in _CUSTOMER_NUMBERS:
        quartiles = ", ".join(f"quantile_cont({c}, 0.{q}) AS q{k}" for k, q in ((1, "25"), (3, "75")))
        low, high = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
        shape = {"q1": "q1", "q3": "q3", "low_fence": low, "high_fence": high}
        shape = {m: f"ANY_VALUE({e})" for m, e in shape.items()} | {"outside": f"COUNT(CASE WHEN {c} < {low} OR {c} > {high} THEN 1 END)"}
        parts += [one(c, m, e) + f", (SELECT {quartiles} FROM customer)" for m, e in shape.items()]
        parts.append(f"SELECT \"column\", 'bin', CAST(n AS DOUBLE), CAST(bin AS VARCHAR) FROM ({_histogram_sql(c, 'customer')})")
    for i, a in enumerate(_CUSTOMER_NUMBERS):
        for b in _CUSTOMER_NUMBERS[i + 1 :]:
            r = f"covar_pop({a}, {b}) / NULLIF(stddev_pop({a}) * stddev_pop({b}), 0)"
            parts.append(f"SELECT '{a}', 'correlation', ROUND({r}, 4) + 0.0, '{b}' FROM customer")
    for c in _CUSTOMER_TEXTS:
        counts = f"SELECT {c} AS value, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, {c}) AS rank FROM customer WHERE {c} IS NOT NULL GROUP BY {c}"
        parts.append(f"SELECT '{c}', 'top_value', CAST(n AS DOUBLE), value FROM ({counts}) WHERE rank <= 10")
    mode = f"SELECT \"column\", 'mode' AS metric, CAST(occurrences AS DOUBLE) AS value, mode AS text FROM ({_union([_mode_sql('customer', c) for c in _CUSTOMER_TEXTS])})"
    return _union([*parts, mode])


@query("table_profile", _profile_sql())
def table_profile(spark, sf_dir):
    """All metrics of all columns of a table by one call."""
    found = _rounded(profile.profile(table(spark, sf_dir, "customer")), "value")
    return found.withColumn("value", F.col("value") + F.lit(0.0))


def _count_sql(t: str) -> str:
    return f"SELECT '{t}' AS table_name, COUNT(*) AS rows, (SELECT COUNT(*) FROM (DESCRIBE {t})) AS columns FROM {t}"


@query("row_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    return tables.row_count(table(spark, sf_dir, "lineitem"))


@query("table_stats", _union([_count_sql(t) for t in TABLES]))
def table_stats(spark, sf_dir):
    return profile.table_stats({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    "table_stats_summary",
    f"SELECT COUNT(*) AS total_tables, CAST(SUM(rows) AS BIGINT) AS total_rows, ROUND(AVG(rows), 4) AS average_rows FROM ({_union([_count_sql(t) for t in TABLES])})",
)
def table_stats_summary(spark, sf_dir):
    return _rounded(profile.table_stats_summary(table_stats(spark, sf_dir)), "average_rows")


@query("table_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10000")
def table_preview(spark, sf_dir):
    """The feature is a limited scan; the order makes it repeatable."""
    return tables.preview(table(spark, sf_dir, "customer"), "c_custkey")


@query("adhoc_avg", "SELECT ROUND(AVG(c_acctbal), 4) AS average_balance FROM customer")
def adhoc_avg(spark, sf_dir):
    return spark.sql(
        "SELECT ROUND(AVG(c_acctbal), 4) AS average_balance FROM {customer}",
        customer=table(spark, sf_dir, "customer"),
    )


@query("adhoc_filter_count", "SELECT COUNT(*) AS n FROM events WHERE value > 50")
def adhoc_filter_count(spark, sf_dir):
    return spark.sql("SELECT COUNT(*) AS n FROM {events} WHERE value > 50", events=table(spark, sf_dir, "events"))


_TYPEOF = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "adhoc_typeof",
    _union([f"SELECT '{c}' AS \"column\", typeof({c}) AS type, COUNT(*) AS n FROM orders GROUP BY typeof({c})" for c in _TYPEOF]),
)
def adhoc_typeof(spark, sf_dir):
    return tables.value_types(table(spark, sf_dir, "orders"), _TYPEOF)


_DESCRIBED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "describe_table",
    _union(
        [
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", typeof(ANY_VALUE({c})) AS type, COUNT({c}) AS filled FROM orders"
            for i, c in enumerate(_DESCRIBED, 1)
        ]
    ),
)
def describe_table(spark, sf_dir):
    return tables.describe(table(spark, sf_dir, "orders"))


@query(
    "null_tokens",
    dirty.ORACLE
    + _union(
        [
            f"SELECT '{c}' AS \"column\", COALESCE(r.{c}, '(null)') AS token, COUNT(*) AS n FROM raw r WHERE r.{c} IS NULL OR r.{c} IN "
            f"({', '.join(repr(t) for t in NULL_TOKENS)}) GROUP BY 2"
            for c in dirty.COLUMNS
        ]
    ),
)
def null_tokens(spark, sf_dir):
    """Which spellings of a missing value occur in which column."""
    raw = dirty.raw(spark, sf_dir).select(*dirty.COLUMNS)
    long = raw.unpivot([], dirty.COLUMNS, "column", "token")
    missing = long.where(clean.decode_null(F.col("token")).isNull())
    return missing.groupBy("column", F.coalesce("token", F.lit("(null)")).alias("token")).agg(F.count(F.lit(1)).alias("n"))
