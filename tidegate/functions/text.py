"""Text helpers: null tokens, blank stripping, header names."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "no value" in a CSV field.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

NULL_TEXT = "NULL"

# Blanks removed around a value before it is judged as a number.
ODD_EDGE = r"^[^!-~]|[^!-~]$"
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def decode_null(value: Column) -> Column:
    """Turn a null token into NULL; every other text is kept as written."""
    return F.when(~value.isin(*NULL_TOKENS), value)


def fill_null(value: Column) -> Column:
    """Text form of a value for CSV export, with NULL spelled out."""
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def strip(value: Column) -> Column:
    """Remove blanks of any script around the text.

    Few values have any, and trimming a set of characters is slow, so a look at
    the first and last character comes first.
    """
    return F.when(value.rlike(ODD_EDGE), F.btrim(value, F.lit(BLANKS))).otherwise(value)


def clean_header(name: Column) -> Column:
    """Column form of :func:`clean_name`, for header tables."""
    text = F.lower(strip(name))
    return F.translate(text, " .()", "__")


def clean_name(name: str) -> str:
    text = name.strip().lower()
    return text.translate(str.maketrans({" ": "_", ".": "_", "(": None, ")": None}))


def unique_names(names: list[str]) -> list[str]:
    """Name empty headers by position and number repeated ones ``x, x.1, x.2``."""
    named = [n if n else f"Unnamed: {i}" for i, n in enumerate(names)]
    taken = set(named)
    seen: Counter[str] = Counter()
    out = []
    for name in named:
        if seen[name] == 0:
            seen[name] = 1
            out.append(name)
            continue
        number = seen[name]
        while f"{name}.{number}" in taken:
            number += 1
        seen[name] = number + 1
        taken.add(f"{name}.{number}")
        out.append(f"{name}.{number}")
    return out


def table_columns(raw: list[str]) -> list[str]:
    """Column names a raw CSV header ends up with in the table.

    Names are made unique when the file is read, cleaned, and made unique once
    more, because cleaning can make two different headers equal.
    """
    return unique_names([clean_name(n) for n in unique_names(list(raw))])


def _unique(names: Column) -> Column:
    """Column form of :func:`unique_names`: names as they are if all differ, else one fold over the array.

    A name is repeated if it is found before its own place. It takes the least number that
    no name has, so the numbers given so far need not be kept.
    """
    named = F.transform(names, lambda n, i: F.when(n == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(n))

    def numbered(named: Column) -> Column:
        def add(out: Column, name: Column) -> Column:
            stem = F.concat(name, F.lit("."))
            taken = F.concat(named, out)
            # of as many numbers as there are names that begin alike and one more, one is free
            most = F.size(F.filter(taken, lambda t: F.startswith(t, stem))) + 1
            free = F.array_except(F.transform(F.sequence(F.lit(1), most), lambda k: F.concat(stem, k.cast("string"))), taken)[0]
            first = F.array_position(named, name) > F.size(out)
            return F.concat(out, F.array(F.when(first, name).otherwise(free)))

        folded = F.aggregate(named, F.array().cast("array<string>"), add)
        return F.when(F.size(F.array_distinct(named)) == F.size(named), named).otherwise(folded)

    # a lambda's variable is computed once, however often it is used
    return F.transform(F.array(named), numbered)[0]


def table_columns_of(headers: Column) -> Column:
    """Column form of :func:`table_columns` for a column of raw headers; a null name is empty."""
    raw = F.transform(headers, lambda n: F.coalesce(n, F.lit("")))
    return _unique(F.transform(_unique(raw), clean_header))
