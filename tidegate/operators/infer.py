"""Column types by majority vote.

One pass over the data collects a handful of facts per column; the decision is
then an expression over those facts. The table is unpivoted first, so the plan
has the same dozen accumulators whether it has two columns or two thousand, and
map-side aggregation leaves one small row per column and task to shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import numbers
from tidegate.functions.dates import DATE_SHAPE
from tidegate.functions.text import decode_null, strip
from tidegate.session import small_table

EMPTY_TYPE = "VARCHAR(255)"

# Longest text allowed -> declared width.
VARCHAR_STEPS = ((50, 100), (100, 200), (255, 500), (1000, 2000))
VARCHAR_WIDEST = 65533

# Integer types, narrowest first, with their bounds.
INTEGER_STEPS = (
    ("TINYINT", -(2**7), 2**7 - 1),
    ("SMALLINT", -(2**15), 2**15 - 1),
    ("INT", -(2**31), 2**31 - 1),
)

SPARK_TYPES = {
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampType(),
}


def spark_type(sql_type: str) -> T.DataType:
    return SPARK_TYPES.get(sql_type, T.StringType())


def as_text(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns as decoded text, whatever their type."""
    return [decode_null(F.col(f"`{c}`").cast("string")).alias(c) for c in columns]


def column_facts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """What the values of each column look like, per key (for example per file).

    The columns must be text with NULL for missing values. ``flags`` are boolean
    row columns whose number of true rows is reported along, in the same pass.
    """
    long = df.select(*keys, *flags, *[F.col(f"`{c}`") for c in columns]).unpivot(
        [*keys, *flags], [f"`{c}`" for c in columns], "column", "value"
    )
    value, text, integer, reading = (F.col(c) for c in ("value", "text", "integer", "reading"))
    # Cheapest test first; a pattern runs only where the tests before it failed.
    judged = (
        long.withColumn("text", strip(value))
        .withColumn("integer", numbers.long_value(text))
        .withColumn("reading", integer.isNotNull() | text.rlike(numbers.READING_PATTERN))
        .withColumn("vote", reading | text.rlike(numbers.VOTE_PATTERN))
        .withColumn("x", F.coalesce(integer.cast("double"), F.when(reading, numbers.reading_number(text))))
        .withColumn("too_wide", integer.isNull() & reading & numbers.is_wide_integer(text))
    )
    x, too_wide = F.col("x"), F.col("too_wide")
    return judged.groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("filled"),
        F.count_if("vote").alias("votes"),
        F.count("x").alias("readings"),
        F.count_if(integer.isNotNull() | too_wide).alias("integers"),
        F.count_if(too_wide).alias("too_wide"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.count_if(x % 1 == 0).alias("whole"),
        F.count_if(value.isin(*numbers.BOOLEAN_WORDS)).alias("booleans"),
        F.count_if(value.rlike(DATE_SHAPE)).alias("dates"),
        F.max(F.char_length(value)).alias("longest"),
        *[F.count_if(flag).alias(flag) for flag in flags],
    )


def numeric_share() -> Column:
    return F.try_divide(F.col("votes"), F.col("filled"))


def has_majority() -> Column:
    """Strictly more than half of the values are numbers."""
    return F.col("votes") * 2 > F.col("filled")


def integer_step(low: Column, high: Column) -> Column:
    step = F.when(F.lit(False), F.lit(""))
    for name, least, most in INTEGER_STEPS:
        step = step.when((low >= float(least)) & (high <= float(most)), F.lit(name))
    return step.otherwise(F.lit("BIGINT"))


def numeric_type() -> Column:
    """Narrowest type for a numeric column.

    A column of nothing but integer literals is compared exactly. Any other
    column was read as floating point, so its range test is one of doubles.
    """
    low, high = F.col("low"), F.col("high")
    exact = (F.col("integers") == F.col("rows")) & (F.col("filled") == F.col("rows"))
    beyond = F.when(exact, F.col("too_wide") > 0).otherwise(
        (high >= numbers.TWO_63) | (low < -numbers.TWO_63)
    )
    integral = F.col("whole") == F.col("readings")
    return F.when(~integral | beyond, F.lit("DOUBLE")).otherwise(integer_step(low, high))


def varchar_type() -> Column:
    width = F.when(F.lit(False), F.lit(""))
    for longest, declared in VARCHAR_STEPS:
        width = width.when(F.col("longest") <= longest, F.lit(f"VARCHAR({declared})"))
    return width.otherwise(F.lit(f"VARCHAR({VARCHAR_WIDEST})"))


def decided_type() -> Column:
    """The SQL type of a column, from its facts."""
    filled = F.col("filled")
    all_booleans = (F.col("booleans") == filled) & (filled == F.col("rows"))
    return (
        F.when(filled == 0, F.lit(EMPTY_TYPE))
        .when(has_majority() & (F.col("readings") == 0), F.lit(EMPTY_TYPE))
        .when(has_majority(), numeric_type())
        .when(all_booleans, F.lit("BOOLEAN"))
        .when(F.col("dates") == filled, F.lit("DATE"))
        .otherwise(varchar_type())
    )


def reading_kind() -> Column:
    """How a whole-column reader takes the column: int, float, bool or text.

    Unlike the vote this is all or nothing. It decides which values of a column
    are equal (``1`` and ``1.0`` only if every value is a number). A column of
    integers and missing values stays integer here, so that long ones keep their
    digits. NULL for a column without values, which may pass for anything.
    """
    filled = F.col("filled")
    # Integers too wide for the reader stay text unless fractions made it read floats.
    mixed = (F.col("too_wide") == 0) | (F.col("integers") < filled)
    return (
        F.when(filled == 0, F.lit(None))
        .when((F.col("integers") == filled) & (F.col("too_wide") == 0), F.lit("int"))
        .when((F.col("readings") == filled) & mixed, F.lit("float"))
        .when((F.col("booleans") == filled) & (filled == F.col("rows")), F.lit("bool"))
        .otherwise(F.lit("text"))
    )


def number_facts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The facts of columns that already are numbers, without a look at any text."""
    whole_types = [c for c in columns if isinstance(df.schema[c].dataType, T.IntegralType)]
    long = df.select(
        *[F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(c) for c in columns]
    ).unpivot([], [f"`{c}`" for c in columns], "column", "x")
    filled = F.count("x")
    none = F.lit(0).cast("long")
    return long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        filled.alias("filled"),
        filled.alias("votes"),
        filled.alias("readings"),
        F.count_if(F.col("x").isNotNull() & F.col("column").isin(whole_types)).alias("integers"),
        none.alias("too_wide"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.count_if(F.col("x") % 1 == 0).alias("whole"),
        none.alias("booleans"),
        none.alias("dates"),
        F.lit(None).cast("int").alias("longest"),
    )


def settled_type(data_type: T.DataType) -> str | None:
    """Type a typed source already decides."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "DATETIME"
    if isinstance(data_type, T.DateType):
        return "DATE"
    return "BOOLEAN" if isinstance(data_type, T.BooleanType) else None


def table_facts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Facts of text and number columns alike."""
    numbers_ = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    texts = [c for c in columns if c not in numbers_]
    parts = []
    if texts:
        parts.append(column_facts(df.select(*as_text(df, texts)), texts))
    if numbers_:
        parts.append(number_facts(df, numbers_))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def infer_schema(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(position, column, type)`` for every column of ``df``, in one pass.

    The result has one row per column. Columns whose source type is already a
    date, timestamp or boolean keep it without a look at the data.
    """
    columns = list(columns or df.columns)
    settled = {c: settled_type(df.schema[c].dataType) for c in columns}
    order = small_table(
        df.sparkSession,
        [(i, c, settled[c]) for i, c in enumerate(columns, 1)],
        "position int, column string, settled string",
    )
    open_columns = [c for c in columns if settled[c] is None]
    if not open_columns:
        return order.select("position", "column", F.col("settled").alias("type"))
    # One row per column on both sides.
    return order.join(F.broadcast(table_facts(df, open_columns)), "column", "left").select(
        "position",
        "column",
        F.coalesce(F.col("settled"), decided_type(), F.lit(EMPTY_TYPE)).alias("type"),
    )


def collect_types(schema: DataFrame) -> dict[str, str]:
    """Inferred types on the driver, in column order (one row per column)."""
    return {r["column"]: r["type"] for r in schema.orderBy("position").collect()}


def declared_length(sql_type: str) -> int | None:
    """The length that a text type declares; None for other types."""
    return int(sql_type[len("VARCHAR(") : -1]) if sql_type.startswith("VARCHAR(") else None


def table_ddl(table: str, types: dict[str, str], buckets: int = 3) -> str:
    """``CREATE TABLE`` text with the surrogate key first, hashed by it."""
    columns = ["`id` BIGINT NOT NULL"] + [f"`{c}` {t}" for c, t in types.items()]
    return (
        f"CREATE TABLE IF NOT EXISTS `{table}` ({', '.join(columns)}) USING parquet "
        f"CLUSTERED BY (`id`) INTO {buckets} BUCKETS"
    )
