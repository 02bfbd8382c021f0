"""The landing folder as a table and as a stream of its files, listed where tasks run.

Spark's own file sources list a folder on the driver and skip files without a byte. Here
the names never pass through the driver: a task lists the folder and hands on its rows.
Of a stream the driver keeps an offset, which says how many files there are and the time
and name of the newest; any other number or a newer file makes a micro-batch. Files that
come in with an old time are counted, so they are noticed too.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "tidegate_landing"
CSV_GLOB = "*.[cC][sS][vV]"
LISTING = "path string, file string, length long, modified timestamp"
BATCH_FILES = 10_000


def file_system(path: str):
    """The file system of a path or URI, and the path inside it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if rest else path
    if scheme in ("s3a", "s3n"):
        path = "s3:" + rest
    return fs.FileSystem.from_uri(path)


def _found(folder: str) -> Iterator:
    """The CSV files of a folder; hidden ones are still being written."""
    from pyarrow import fs

    system, inner = file_system(folder)
    for info in system.get_file_info(fs.FileSelector(inner)):
        if info.type == fs.FileType.File and info.base_name[:1] not in "._" and fnmatch.fnmatchcase(info.base_name, CSV_GLOB):
            yield info


def _rows(folder: str, upto: tuple | None = None) -> Iterator:
    """The files as Arrow batches; with ``upto``, a time and a name, no newer ones."""
    import pyarrow as pa

    found = [i for i in _found(folder) if upto is None or (i.mtime_ns, i.base_name) <= upto]
    base = folder.rstrip("/")
    for at in range(0, max(1, len(found)), BATCH_FILES):
        part = found[at : at + BATCH_FILES]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{base}/{i.base_name}" for i in part], pa.string()),
                pa.array([i.base_name for i in part], pa.string()),
                pa.array([i.size for i in part], pa.int64()),
                pa.array([i.mtime_ns // 1000 for i in part], pa.int64()).cast(pa.timestamp("us", tz="UTC")),
            ],
            ["path", "file", "length", "modified"],
        )


class _Folder(InputPartition):
    """A folder to be listed by a task, as far as a stream's offset goes."""

    def __init__(self, upto: tuple | None = None):
        super().__init__(0)
        self.upto = upto


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self):
        return [_Folder()]

    def read(self, partition):
        return _rows(self.folder)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"files": 0, "modified": -1, "name": ""}

    def latestOffset(self) -> dict:
        count, newest = 0, (-1, "")
        for info in _found(self.folder):
            count, newest = count + 1, max(newest, (info.mtime_ns, info.base_name))
        return {"files": count, "modified": newest[0], "name": newest[1]}

    def partitions(self, start: dict, end: dict):
        return [_Folder((end["modified"], end["name"]))]

    def read(self, partition):
        return _rows(self.folder, partition.upto)

    def commit(self, end: dict) -> None:
        pass


class Landing(DataSource):
    """``path, file, length, modified`` of the CSV files of a folder, empty ones too."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"])


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """``(path, file, length, modified)`` of every CSV file; contents are not read."""
    spark.dataSource.register(Landing)
    return spark.read.format(FORMAT).load(landing)


def stream_files(spark: SparkSession, landing: str) -> DataFrame:
    """The same listing as a stream: whenever the folder changes, all its files up to the newest."""
    spark.dataSource.register(Landing)
    return spark.readStream.format(FORMAT).load(landing)
