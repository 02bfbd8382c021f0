"""Modes of a load: a catalog table hashed by id, a table per schema, error files."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidegate.plans.ingest import Load, LoadConfig
from tidegate.plans.routing import UNREAD, Router
from tidegate.sinks import export


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "landing"
    path.mkdir()
    return path


def test_catalog_table_joins_without_exchange(spark, folder, tmp_path):
    name = f"tidegate_{uuid.uuid4().hex}"
    config = LoadConfig(str(folder), str(tmp_path / "warehouse"), files_per_batch=1, catalog=name)
    load = Load(spark, config)
    for k in range(3):
        (folder / f"f{k}.csv").write_text("_run,day\n" + "\n".join(f"{k}{i},2024-01-0{i + 1}" for i in range(5)) + "\n")
    load.run_all()
    rows = load.table()
    assert rows.columns == ["id", "_run", "day", "_src_file"] and rows.count() == 15
    joined = rows.select("id", "day").hint("merge").join(rows.select("id", "_run"), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and joined.count() == 15
    # a run that died after publishing is done again, once
    load.store.remove("processed_files", 3)
    assert load.table().count() == 10
    load.run_all()
    assert [r["id"] for r in load.table().orderBy("id").collect()] == list(range(1, 16))
    # the table is gone: types and ids begin anew
    spark.sql(f"DROP TABLE `{name}`")
    load.store.remove_all(config.table)
    (folder / "g.csv").write_text("_run,day\nx,soon\n")
    load.run_all()
    assert [tuple(r) for r in load.table().collect()] == [(1, "x", "soon", "g.csv")]


def test_the_registry_keeps_lengths_of_text(spark, folder, tmp_path):
    (folder / "a.csv").write_text("n,short,long,none\n" + f"1,ab,{'x' * 300},\n2,cd,y,\n")
    load = Load(spark, LoadConfig(str(folder), str(tmp_path / "warehouse")))
    load.run_all()
    (row,) = load.store.finished("schema_registry").collect()
    want = [("n", "TINYINT", None), ("short", "VARCHAR(100)", 100), ("long", "VARCHAR(2000)", 2000), ("none", "VARCHAR(255)", 255)]
    assert [tuple(c) for c in row["columns"]] == want and load.registered_schema().types == {c: t for c, t, _ in want}


def test_a_schema_keeps_its_table(spark, folder, tmp_path):
    config = LoadConfig(str(folder), str(tmp_path / "warehouse"), files_per_batch=3)
    router = Router(spark, config)
    (folder / "b.csv").write_text("x,y\n1,2\n")
    (folder / "a.csv").write_text("m\n1\n")
    (folder / "c.csv").write_text("")
    assert router.run_all() == 3
    (folder / "d.csv").write_text("y,x\n4,3\n")
    (folder / "e.csv").write_text("q\n1\n")
    (folder / "A.csv").write_text("new,one\n1,2\n")
    (folder / "f.csv").write_text("m\n2\nword\n")
    assert router.run_all() == 4 and router.run_all() == 0
    tables = {r["schema_key"]: r["table_name"] for r in router.tables().collect()}
    assert tables == {"m": "tbl_1", "x|y": "tbl_2", "new|one": "tbl_3", "q": "tbl_4"}
    assert sorted(tuple(r) for r in router.load("tbl_2").table().select("id", "x", "y").collect()) == [(1, 1, 2), (2, 3, 4)]
    assert sorted(tuple(r) for r in router.load("tbl_1").table().select("id", "m").collect()) == [(1, 1), (2, 2)]
    assert [r["status"] for r in router.load(UNREAD).store.finished("processed_files").collect()] == ["unreadable"]


def test_error_files_of_each_run(spark, folder, tmp_path):
    config = LoadConfig(str(folder), str(tmp_path / "warehouse"), error_files=str(tmp_path / "errors"))
    (folder / "a.csv").write_text("n,s\n1,p\n2,q\nx, blank \n")
    Load(spark, config).run_all()
    (folder / "b.csv").write_text("n,s\n3,p\ny,\"a, b\"\n")
    Load(spark, config).run_all()
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "errors")).select("run", "error_file", "n", "s", F.length("error").alias("e"))
    assert sorted((r["run"], r["error_file"], r["n"], r["s"]) for r in back.collect()) == [(1, "error_a", "x", " blank "), (2, "error_b", "y", "a, b")]


def test_error_folders_hold_one_part_each_in_row_order(spark, tmp_path):
    rows = [(f"f{i % 6}.csv", i, json.dumps({"n": f"v{i}"}), "bad") for i in range(600)]
    mixed = spark.createDataFrame(rows, "file string, row_number long, payload string, error string").repartition(8, "row_number")
    export.export_errors(mixed, ["n"], str(tmp_path / "errors"))
    parts = [p for p in (tmp_path / "errors").glob("error_file=*/part-*.csv")]
    # a range may end within a file, so there may be a part more for each range
    assert 6 <= len(parts) <= 6 + 7
    for part in parts:
        numbers = [int(line.split(",")[0][1:]) for line in part.read_text().splitlines()[1:]]
        assert numbers and numbers == sorted(numbers)
    back = spark.read.option("header", True).csv(str(tmp_path / "errors")).collect()
    assert sorted((r["error_file"], r["n"]) for r in back) == sorted((f"error_f{i % 6}", f"v{i}") for i in range(600))


def test_bad_rows_keep_their_values_as_written(spark, folder, tmp_path):
    (folder / "a.csv").write_text('n,x,s\n1,1.50,p\n2, inf,"a ""q"""\nword,1.50, blank \n007,2,z\n')
    (folder / "b.csv").write_text('s,x,n\n"over\nlines",+1e2,none\n')
    load = Load(spark, LoadConfig(str(folder), str(tmp_path / "warehouse")))
    load.run_all()
    bad = {r["file"]: json.loads(r["payload"]) for r in load.store.finished("quarantine_rows").collect()}
    assert bad == {"a.csv": {"n": "word", "x": "1.50", "s": " blank "}, "b.csv": {"n": "none", "x": "+1e2", "s": "over\nlines"}}


def test_first_errors_and_samples_are_kept(spark, folder, tmp_path):
    (folder / "a.csv").write_text("n,s\n" + "".join(f"{i},v{i}\n" for i in range(20)) + "".join(f"bad{i},w\n" for i in range(8)))
    (folder / "b.csv").write_text("n,s\n7,\n")
    (folder / "c.csv").write_text("n,s\n")
    load = Load(spark, LoadConfig(str(folder), str(tmp_path / "warehouse"), chunk_span=1))
    load.run_all()
    notes = {r["file"]: (r["first_errors"], r["samples"]) for r in load.store.finished("file_notes").collect()}
    assert notes["a.csv"] == ([f"Column 'n' expects INT, got 'bad{i}'" for i in range(5)], {"n": ["0", "1", "2"], "s": ["v0", "v1", "v2"]})
    assert notes["b.csv"] == ([], {"n": ["7"], "s": ["NULL"]}) and set(notes) == {"a.csv", "b.csv"}


def test_boolean_columns_take_any_text_unless_strict(spark, folder, tmp_path):
    (folder / "a.csv").write_text("n,b\n1,True\n2,false\n")
    (folder / "b.csv").write_text("n,b\n3,yes\n4,perhaps\n")
    for strict, want in ((False, [True, False, True, None]), (True, [True, False, True])):
        load = Load(spark, LoadConfig(str(folder), str(tmp_path / f"warehouse-{strict}"), strict=strict))
        load.run_all()
        assert [r["b"] for r in load.table().orderBy("id").collect()] == want
