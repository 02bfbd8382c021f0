"""CSV rows as text, with their file and their position in it.

One scan reads any number of files by column position; names come from the
header registry. Rows get a position that grows through the file: the byte
offset of their split times 1024, plus their line number in the task. A split has
no more lines than bytes, so positions of a file's splits cannot overlap unless a
task reads a thousand full splits. They follow from the scan alone, before any
shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import decode_null
from tidegate.session import small_table, steady_splits
from tidegate.sources import records
from tidegate.sources.files import decoded_name

RAW = "_raw"
LINE_MASK = (1 << 33) - 1
OFFSET_SCALE = 1 << 10
# Positions per chunk of rows: those of 64 MB of text.
CHUNK_SPAN = (1 << 26) * OFFSET_SCALE
QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'


@dataclass(frozen=True)
class Layout:
    """How the fields of one file map to columns.

    ``width`` is the number of fields a row may have. If the first data row has
    more fields than the header, its surplus leading fields are row labels, which
    are skipped in every row.
    """

    path: str
    file: str
    columns: tuple[str, ...]
    first_width: int = 0
    multiline: bool = False

    @property
    def width(self) -> int:
        return max(len(self.columns), self.first_width)

    @property
    def skipped(self) -> int:
        return self.width - len(self.columns)

    def places(self, wanted: Sequence[str]) -> list[int]:
        """0-based field of each wanted column."""
        at = {c: i + self.skipped for i, c in enumerate(self.columns)}
        return [at[c] for c in wanted]


def field_names(width: int) -> list[str]:
    return [f"_c{i}" for i in range(width)]


def row_position() -> Column:
    line = F.monotonically_increasing_id().bitwiseAND(F.lit(LINE_MASK))
    return F.col("_metadata.file_block_start") * OFFSET_SCALE + line


def positional(rows: DataFrame) -> list[str]:
    """The positional columns of a scan without names."""
    return [c for c in rows.columns if c.startswith("_c")]


def as_pattern(path: str) -> str:
    """The path with characters escaped that a file pattern would interpret."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def count_fields(line: Column) -> Column:
    """Fields of a CSV record, not counting commas inside quotes."""
    bare = F.regexp_replace(line, QUOTED, "$1")
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def open_quote(text: Column) -> Column:
    """Whether a quoted field of a record is not closed by the record's end.

    Only a quote at the beginning of a field opens one; other quotes are text.
    """
    bare = F.regexp_replace(text, QUOTED, "$1")
    return F.coalesce(text.contains('"') & bare.rlike('(^|,)"'), F.lit(False))


def line_facts(spark: SparkSession, layouts: Sequence[Layout]) -> DataFrame:
    """``file, bad_bytes, open_quote, overlong`` of files with any of them, from their raw lines.

    The lines before the first open quote all begin outside of quotes, so it is found
    for certain; what follows it in that file is not judged by lines. Any number of
    fields may be counted here, and bytes are looked at before they are decoded.
    """
    widths = [(x.file, x.width) for x in layouts]
    guide = F.broadcast(small_table(spark, widths, "file string, width int"))
    lines = spark.read.text([as_pattern(x.path) for x in layouts]).select(
        decoded_name(F.col("_metadata.file_name")).alias("file"), "value"
    )
    line = F.col("value")
    commas = F.char_length(line) - F.char_length(F.replace(line, F.lit(","), F.lit("")))
    overlong = F.when(commas >= F.col("width"), count_fields(line) > F.col("width")).otherwise(False)
    found = {"bad_bytes": ~F.is_valid_utf8(line), "open_quote": open_quote(line), "overlong": overlong}
    facts = lines.join(guide, "file").select("file", *[v.alias(k) for k, v in found.items()])
    return facts.groupBy("file").agg(*[F.max(k).alias(k) for k in found]).where(" OR ".join(found))


def scan_fields(spark: SparkSession, paths: Sequence[str], width: int, multiline: bool = False) -> DataFrame:
    """``file, pos, _c0 … _c<width-1>, fields, open_quote`` of all data rows.

    Every field is text with null tokens decoded. Records that do not have
    exactly ``width`` fields keep their raw text, from which the real number of
    fields and an unclosed quote (a record that goes on in the next line) are
    told. A one-column file is read as two so that each record keeps its text.
    """
    steady_splits(spark)
    if multiline:
        return scan_records(spark, paths, width)
    read_width = max(width, 2)
    schema = ", ".join(f"`{c}` string" for c in field_names(read_width)) + f", `{RAW}` string"
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW)
        .option("columnPruning", False)
        .option("escape", '"')
        .option("maxColumns", max(20_480, read_width + 1))
        .csv([as_pattern(p) for p in paths])
    )
    return rows.select(
        decoded_name(F.col("_metadata.file_name")).alias("file"),
        row_position().alias("pos"),
        *[decode_null(F.col(c)).alias(c) for c in field_names(width)],
        F.when(F.col(RAW).isNull(), read_width).otherwise(count_fields(F.col(RAW))).alias("fields"),
        open_quote(F.col(RAW)).alias("open_quote"),
    )


def scan_records(spark: SparkSession, paths: Sequence[str], width: int) -> DataFrame:
    """The same columns of files whose records go on over line ends, by as many tasks as they have splits.

    A record with more fields than ``width`` is counted, not read, so it may have any number.
    """
    lines = records.read_lines(spark, [as_pattern(p) for p in paths], decoded_name(F.col("_metadata.file_name")), row_position())
    found = records.read_records(lines)
    commas = F.char_length("record") - F.char_length(F.replace("record", F.lit(","), F.lit("")))
    found = found.withColumn("fields", F.when(commas >= width, count_fields(F.col("record"))).otherwise(F.lit(width)))
    schema = ", ".join(f"`{c}` string" for c in field_names(max(width, 2)))
    options = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true", "lineSep": "\n", "maxColumns": str(max(20_480, width + 2))}
    parsed = F.when(F.col("fields") <= width, F.from_csv("record", schema, options))
    rows = found.withColumn("open_quote", open_quote(F.col("record"))).withColumn("_row", parsed)
    return rows.select(
        "file", "pos", *[decode_null(F.col("_row")[c]).alias(c) for c in field_names(width)], "fields", "open_quote"
    )


def scan_group(spark: SparkSession, layouts: Sequence[Layout], wanted: Sequence[str] | None = None) -> DataFrame:
    """Rows of files of one width: ``file, pos, <wanted columns>, overlong, open_quote``.

    Without ``wanted`` the fields stay positional, after the skipped ones.
    Files that share a column order are renamed in place; only a mix of orders
    looks its fields up per row, through a broadcast of one small row per file.
    """
    width = max(layout.width for layout in layouts)
    rows = scan_fields(spark, [layout.path for layout in layouts], width, layouts[0].multiline)
    uniform = len({layout.width for layout in layouts}) == 1
    orders = {tuple(layout.places(wanted)) if wanted else (layout.skipped,) for layout in layouts}
    if uniform and len(orders) == 1:
        (places,) = orders
        fields = [F.col(f"_c{p}").alias(c) for p, c in zip(places, wanted)] if wanted else None
        if fields is None:
            fields = [F.col(f"_c{i}").alias(f"_c{i - places[0]}") for i in range(places[0], width)]
        return rows.select("file", "pos", *fields, (F.col("fields") > width).alias("overlong"), "open_quote")
    listed = [
        (x.file, x.places(wanted) if wanted else list(range(x.skipped, x.width)), x.width) for x in layouts
    ]
    # At most one row per file of the batch, whose number is capped.
    guide = F.broadcast(small_table(spark, listed, "file string, places array<int>, width int"))
    values = F.array(*[F.col(c) for c in field_names(width)])
    names = list(wanted) if wanted else field_names(max(len(p) for _, p, _ in listed))
    place = F.get("places", F.lit(0))
    fields = []
    for i, c in enumerate(names):
        place = F.get("places", F.lit(i))
        fields.append(F.when(place.isNotNull(), F.get(values, place)).alias(c))
    overlong = F.col("fields") > F.col("width")
    return rows.join(guide, "file").select("file", "pos", *fields, overlong.alias("overlong"), "open_quote")


def scan(spark: SparkSession, layouts: Sequence[Layout], wanted: Sequence[str] | None = None) -> DataFrame:
    """Rows of any files, one scan per way of reading them (width, line mode).

    Files that fit one table have one width, or a few if some carry row labels.
    Positional scans of unrelated files share a single width.
    """
    groups: dict[tuple, list[Layout]] = {}
    for layout in layouts:
        groups.setdefault((layout.width if wanted else 0, layout.multiline), []).append(layout)
    parts = [scan_group(spark, group, wanted) for _, group in sorted(groups.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=wanted is None)
    return out


def scan_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The raw lines of files that cannot be read as CSV."""
    steady_splits(spark)
    lines = spark.read.text([as_pattern(p) for p in paths])
    return lines.select(
        decoded_name(F.col("_metadata.file_name")).alias("file"),
        row_position().alias("pos"),
        F.col("value").alias("line"),
    )


def file_verdict(open_quotes: int, overlong: int, multiline: bool) -> str:
    """``ok``, ``multiline`` (read again, whole records), or why a file cannot be loaded."""
    if open_quotes:
        return "unterminated quote" if multiline else "multiline"
    return "row longer than the header" if overlong else "ok"
