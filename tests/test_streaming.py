"""The stream over a landing folder: restart, re-arrival, nothing twice."""

from __future__ import annotations

import os

from tidegate.plans.ingest import Load, LoadConfig
from tidegate.session import settle
from tidegate.sinks import export
from tidegate.sinks import store as st
from tidegate.streaming import landing


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    config = LoadConfig(str(folder), str(tmp_path / "warehouse"))

    def run():
        landing.start(spark, config, str(tmp_path / "checkpoint")).awaitTermination()
        return [tuple(r) for r in Load(spark, config).table().select("id", "n").orderBy("id").collect()]

    (folder / "b.csv").write_text("n\n3\n4\n")
    (folder / "a.csv").write_text("n\n1\n2\n")
    assert run() == [(1, 1), (2, 2), (3, 3), (4, 4)]
    (folder / "c.csv").write_text("n\n5\nx\n")
    (folder / "d.csv").write_text("m\n5\n")
    assert run() == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    (folder / "a.csv").write_text("n\n9\n9\n9\n")  # came back changed: known by name
    assert run() == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    status = {r["file"]: r["status"] for r in Load(spark, config).store.finished(st.PROCESSED).collect()}
    assert status == {"a.csv": "loaded", "b.csv": "loaded", "c.csv": "loaded", "d.csv": "schema_mismatch"}


def test_empty_and_old_files_are_noticed(spark, tmp_path):
    """A file without a byte, one that comes in with an old time, and one still being written."""
    folder = tmp_path / "landing"
    folder.mkdir()
    config = LoadConfig(str(folder), str(tmp_path / "warehouse"), files_per_batch=1)

    def run():
        landing.start(spark, config, str(tmp_path / "checkpoint")).awaitTermination()
        return {r["file"]: r["status"] for r in Load(spark, config).store.finished(st.PROCESSED).collect()}

    (folder / "m.csv").write_text("n\n1\n")
    (folder / "empty.csv").write_text("")
    (folder / "_p.csv").write_text("n\n7\n")
    assert run() == {"empty.csv": "unreadable", "m.csv": "loaded"}
    (folder / "old.CSV").write_text("n\n2\n")
    os.utime(folder / "old.CSV", (1_000_000_000, 1_000_000_000))
    assert run() == {"empty.csv": "unreadable", "m.csv": "loaded", "old.CSV": "loaded"}
    assert run() == {"empty.csv": "unreadable", "m.csv": "loaded", "old.CSV": "loaded"}


def test_a_file_that_fails_is_struck_out(spark, tmp_path, monkeypatch):
    """Deleted after its header was read, named with a colon, or gone before it: the rest loads."""
    from tidegate.sources import files

    folder = tmp_path / "landing"
    folder.mkdir()
    for name in ("a.csv", "b b%.csv", "z:q.csv", "d.csv"):
        (folder / name).write_text("n\n1\n")
    peek = files.header_registry

    class Peeked:
        """The registry, settled before a file goes."""

        def __new__(cls, pending):
            rows = settle(peek(pending))
            (folder / "b b%.csv").unlink(missing_ok=True)
            return rows

    monkeypatch.setattr(files, "header_registry", Peeked)
    load = Load(spark, LoadConfig(str(folder), str(tmp_path / "warehouse")))
    load.run_all()
    status = {r["file"]: r["status"] for r in load.store.finished(st.PROCESSED).collect()}
    assert status == {"a.csv": "loaded", "b b%.csv": "unreadable", "d.csv": "loaded", "z:q.csv": "unreadable"}
    reasons = {r["file"]: r["reason"] for r in load.store.finished(st.BAD_FILES).collect()}
    assert set(reasons) == {"b b%.csv", "z:q.csv"} and reasons["z:q.csv"] == files.UNADDRESSABLE


def test_exports(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text('n,s\n1,"p, ""q"""\n2,\nx,"bad, row"\n3,z\n')
    run = Load(spark, LoadConfig(str(folder), str(tmp_path / "warehouse")))
    run.run_all()
    export.export_csv(run.table().drop("_src_file"), str(tmp_path / "csv"), spell_nulls=True)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", "1", 'p, "q"'), ("2", "2", "NULL"), ("4", "3", "z")]
    export.export_errors(run.store.finished(st.BAD_ROWS), ["n", "s"], str(tmp_path / "errors"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "errors")).collect()
    assert [r.asDict() for r in back] == [{"n": "x", "s": "bad, row", "error": "Column 'n' expects INT, got 'x'", "error_file": "error_a"}]
