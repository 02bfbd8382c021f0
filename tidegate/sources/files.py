"""The landing folder: which files there are, which are new, what their headers say."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import table_columns
from tidegate.operators.gate import schema_key
from tidegate.sources.listing import file_system

def decoded_name(name: Column) -> Column:
    """A file name from its URL form, in which Spark's file metadata comes."""
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), plain).otherwise(name)


def pending_files(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files whose name is not checkpointed yet."""
    return files.join(processed.select("file").distinct(), "file", "left_anti")


def _open(path: str):
    system, inner = file_system(path)
    return system.open_input_stream(inner)


def fields_of(line: str, inside: bool) -> tuple[int, bool]:
    """Separators of a physical line, and whether a quoted field goes on after it.

    A quote opens a field only where the field begins; elsewhere it is text.
    """
    commas, at, begins = 0, 0, not inside
    while True:
        if inside:
            at = line.find('"', at) + 1
            if not at:
                return commas, True
            if line[at : at + 1] == '"':
                at += 1
            else:
                inside = begins = False
        elif begins and line[at : at + 1] == '"':
            inside, at = True, at + 1
        else:
            at = line.find(",", at) + 1
            if not at:
                return commas, False
            commas, begins = commas + 1, True


# Spark's readers cannot name such a file, so not even its lines are kept.
UNADDRESSABLE = "colon in the file name"
NOT_TEXT = "not UTF-8"


def read_head(path: str) -> tuple[list[str] | None, int, str | None]:
    """Header, width of the first data row and what is wrong, from the file's first lines.

    Text is decoded strictly. The header is kept; of the data row only the fields are
    counted, line by line, so a quote that never closes costs time but no memory.
    """
    csv.field_size_limit(sys.maxsize)
    if ":" in path.rsplit("/", 1)[-1]:
        return None, 0, UNADDRESSABLE
    try:
        with _open(path) as stream, io.TextIOWrapper(stream, encoding="utf-8-sig", errors="strict", newline="") as lines:
            head, commas, inside = [], 0, False
            for line in lines:
                if inside or line.strip():
                    head.append(line)
                    _, inside = fields_of(line, inside)
                    if not inside:
                        break
            if not head:
                return None, 0, "empty file"
            started = False
            for line in lines:
                if started or line.strip():
                    more, inside = fields_of(line, started and inside)
                    commas, started = commas + more, True
                    if not inside:
                        break
    except UnicodeDecodeError:
        return None, 0, NOT_TEXT
    except (csv.Error, OSError) as error:
        return None, 0, f"{type(error).__name__}: {error}"
    return next(csv.reader(head)), commas + 1 if started else 0, None


HEADER_SCHEMA = (
    "path string, file string, length long, header array<string>, columns array<string>, first_width int, problem string"
)


def _peek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [read_head(p) for p in batch.column("path").to_pylist()]
        peeked = {
            "header": pa.array([h for h, _, _ in heads], pa.list_(pa.string())),
            "columns": pa.array([None if h is None else table_columns(h) for h, _, _ in heads], pa.list_(pa.string())),
            "first_width": pa.array([w for _, w, _ in heads], pa.int32()),
            "problem": pa.array([p for _, _, p in heads], pa.string()),
        }
        yield pa.RecordBatch.from_arrays([*batch.columns, *peeked.values()], [*batch.schema.names, *peeked])


def header_registry(files: DataFrame) -> DataFrame:
    """One row per file: raw header, column names, schema key, and what is wrong with it.

    Tasks open their files and read only the first records.
    """
    tasks = files.sparkSession.sparkContext.defaultParallelism
    spread = files.select("path", "file", "length").repartition(tasks, "path")
    peeked = spread.mapInArrow(_peek, HEADER_SCHEMA)
    return peeked.withColumns(
        {
            "schema_key": schema_key(F.col("columns")),
            "renamed": F.col("columns") != F.col("header"),
            "multiline": F.exists("header", lambda name: name.contains("\n") | name.contains("\r")),
        }
    )
