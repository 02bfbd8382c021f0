"""Numeric text: which spellings count as numbers, and what value they have.

Two grammars matter. A *vote* accepts whatever Python's ``float`` accepts; a
*reading* is what a CSV reader turns into a number when a whole column is
numeric (no digit separators, no spelled-out NaN, nothing that overflows).
Spark's own casts accept ``1d`` or ``0x1p3`` and refuse ``1_000``, so every cast
below is guarded by a pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import strip

_DIGITS = r"\d+(_\d+)*"
_EXPONENT = rf"([eE][+-]?{_DIGITS})?"
VOTE_PATTERN = (
    rf"^[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS}){_EXPONENT}"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"
)
READING_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
INTEGER_PATTERN = r"^[+-]?\d+$"
BOOLEAN_WORDS = ("true", "True", "TRUE", "false", "False", "FALSE")

INTEGER_TYPES = {"TINYINT": "tinyint", "SMALLINT": "smallint", "INT": "int", "BIGINT": "bigint"}
TWO_63 = float(2**63)


# Functions of ``text`` expect it stripped; functions of ``value`` strip it themselves.


def votes_numeric(value: Column) -> Column:
    return strip(value).rlike(VOTE_PATTERN)


def vote_number(text: Column) -> Column:
    """Value of a text the vote accepts, NULL otherwise."""
    number = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    # A signed NaN is a number to the grammar but not to the cast.
    signed_nan = F.when(F.lower(text).rlike("^[+-]nan$"), F.lit(float("nan")))
    return F.when(text.rlike(VOTE_PATTERN), F.coalesce(number, signed_nan))


def vote_value(value: Column) -> Column:
    return vote_number(strip(value))


def reading_number(text: Column) -> Column:
    """Number in a stripped text known to match the reading pattern; NULL if it overflows."""
    number = text.try_cast("double")
    overflow = (F.abs(number) == float("inf")) & ~F.lower(text).contains("inf")
    return F.when(~overflow, number)


def reading_value(value: Column) -> Column:
    """Number a whole-column reader would take from the text, else NULL."""
    text = strip(value)
    return F.when(text.rlike(READING_PATTERN), reading_number(text))


def long_value(text: Column) -> Column:
    """Value of a stripped 64-bit integer literal.

    The pattern comes first, here as everywhere: a cast that fails raises and
    catches an exception, which costs many times as much as a pattern.
    """
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


def is_wide_integer(text: Column) -> Column:
    """Integer literals that may not fit 64 bits; asked only where the cast failed."""
    return (F.char_length(text) > 18) & text.rlike(INTEGER_PATTERN)


def integer_number(text: Column, sql_type: str) -> Column:
    """Integer in ``sql_type``, truncated toward zero; NULL if it does not fit.

    Integer literals are cast directly, which keeps all digits beyond 2**53; all
    other numbers go through double.
    """
    target = INTEGER_TYPES[sql_type]
    bare = F.replace(text, F.lit("_"), F.lit(""))
    whole = F.when(bare.rlike(INTEGER_PATTERN), bare.try_cast(target)).otherwise(bare.try_cast("double").try_cast(target))
    return F.when(text.rlike(VOTE_PATTERN), whole)


def integer_value(value: Column, sql_type: str) -> Column:
    return integer_number(strip(value), sql_type)
