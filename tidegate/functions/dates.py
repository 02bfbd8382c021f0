"""Date text, judged against an explicit list of layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"

# Accepted layouts, each with the shape that guards the parser.
DATE_LAYOUTS = (
    (r"^(1[3-9]|2\d|3[01])/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
    (r"^\d{1,2}-[A-Z][a-z]{2}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,8} \d{4}$", "d MMMM yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}$", "yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2},? \d{4}$", "MMM d yyyy"),
    (r"^[A-Z][a-z]{3,8} \d{1,2},? \d{4}$", "MMMM d yyyy"),
)
ISO_STAMP = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"


def timestamp_value(text: Column) -> Column:
    """Timestamp of a stripped text under any accepted layout, else NULL.

    The shape test comes first: it is cheap, and keeps the parser from raising
    and catching an exception for every text that is no date at all.
    """
    parsed = F.when(text.rlike(ISO_STAMP), text.try_cast("timestamp"))
    for shape, layout in DATE_LAYOUTS:
        plain = F.replace(text, F.lit(","), F.lit("")) if "," in shape else text
        parsed = parsed.when(text.rlike(shape), F.try_to_timestamp(plain, F.lit(layout)))
    return parsed


def date_value(text: Column) -> Column:
    """Date of a stripped text; the usual layout takes a shorter way."""
    usual = text.rlike(DATE_SHAPE)
    return F.when(usual, text.try_cast("date")).otherwise(timestamp_value(text).cast("date"))
