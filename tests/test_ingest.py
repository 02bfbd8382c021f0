"""Whole loads over small landing folders, against results worked out by hand."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidegate.plans.ingest import Load, LoadConfig
from tidegate.session import DEFAULTS, LISTING_TASKS, tune
from tidegate.sinks import store as st
from tidegate.sources import csv
from tidegate.sources.csv import Layout


def land(folder, **contents):
    folder.mkdir(exist_ok=True)
    for name, text in contents.items():
        (folder / name.replace("__", ".")).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


@pytest.fixture
def load(spark, tmp_path):
    def make(contents, **options):
        landing = land(tmp_path / "landing", **contents)
        return Load(spark, LoadConfig(landing, str(tmp_path / "warehouse"), **options))

    return make


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


NARROW = {
    "data_1__csv": "name,age \nAnn,31\nBo,26  \nCy,35\nDee,41\nEd,28\nFay,33\nGus,29",
    "data_2__csv": "name,age\nHal,45\nIda,32\nJim,38\nKay,27\nLou,30\n",
    "data_3__csv": "name,age \nMax,twenty \nNed,56\nOla,44 \nPam,88 \nRay,seven \nSue,6\n",
    "data_4__csv": "name,marks\nAnn,85\nBo,90\nCy,95\nDee,80\n",
}


def test_narrow_files(load):
    run = load(NARROW)
    assert run.run_all() == 4
    schema = run.registered_schema()
    assert schema.types == {"name": "VARCHAR(100)", "age": "TINYINT"}
    assert schema.key == "age|name"
    table = run.table()
    assert [r["id"] for r in table.orderBy("id").collect()] == [*range(1, 13), 14, 15, 16, 18]
    assert rows(table.where("id in (2, 14, 18)").select("id", "name", "age"), "id") == [
        (2, "Bo", 26), (14, "Ned", 56), (18, "Sue", 6)
    ]
    bad = run.store.finished(st.BAD_ROWS)
    assert rows(bad.select("file", "row_number", "error"), "row_number") == [
        ("data_3.csv", 2, "Column 'age' expects INT, got 'twenty '"),
        ("data_3.csv", 6, "Column 'age' expects INT, got 'seven '"),
    ]
    assert json.loads(bad.where("row_number = 2").first()["payload"]) == {"name": "Max", "age": "twenty "}
    files = run.store.finished(st.BAD_FILES)
    assert files.count() == 4
    first = files.orderBy("pos").first()
    assert first["reason"] == "Schema mismatch. Expected: age|name, Got: marks|name"
    assert json.loads(first["payload"]) == {"name": "Ann", "marks": "85"}
    assert rows(run.store.finished(st.PROCESSED).select("file", "status"), "file") == [
        ("data_1.csv", "loaded"), ("data_2.csv", "loaded"), ("data_3.csv", "loaded"), ("data_4.csv", "schema_mismatch")
    ]
    summary = run.store.finished(st.RUNS).drop("seconds", "run").first()
    assert tuple(summary) == (4, 3, 1, 0, 16, 2)


def test_colliding_and_odd_column_names(load):
    run = load({"a__csv": "A B,a_b,x.y,,days/week\n1,2,3,4,5\n", "b__csv": "a b,A_B,X.Y,,Days/Week\n6,7,oops,9,1.5\n6,7,8,9,10\n"})
    run.run_all()
    assert list(run.registered_schema().types) == ["a_b", "a_b.1", "x_y", "unnamed:_3", "days/week"]
    assert rows(run.table().drop("_src_file"), "id") == [(1, 1, 2, 3, 4, 5), (3, 6, 7, 8, 9, 10)]
    assert run.store.finished(st.BAD_ROWS).first()["error"] == "Column 'x_y' expects INT, got 'oops'"


# A wide table in the shape of the fixtures: numbers, one narrow integer column
# written with fractions, one beyond 64 bits, and text with commas.
WIDE_TEXT = [f"Text {i} (kind)" for i in range(15)]
WIDE_NUMBERS = [f"Number.{i}" for i in range(37)]


def wide_file(rows, faults=()):
    header = [*WIDE_NUMBERS, "Calories", "Burn (bc)", *WIDE_TEXT]
    lines = [",".join(header)]
    for r in range(rows):
        numbers = [str(round(r * 1.37 + i / 7 + 0.01, 6)) for i in range(37)]
        for row, column, word in faults:
            if row == r:
                numbers[column] = word
        texts = [f'"Quads, Glutes {i}"' if i % 5 == 0 else f"t{r}{i}" for i in range(15)]
        lines.append(",".join([*numbers, f"{1500 + r}.0", f"{r + 1}.25e+20", *texts]))
    return "\n".join(lines)


def test_wide_files(load):
    run = load(
        {
            "data_1__csv": wide_file(7),
            "data_2__csv": wide_file(6),
            "data_3__csv": wide_file(7, [(2, 5, "hello"), (2, 30, "again"), (5, 33, "hi")]),
            "data_4__csv": "name,age\nAl ,39 \nBo,77\nCy,78",
        }
    )
    run.run_all()
    types = run.registered_schema().types
    kinds = list(types.values())
    assert (kinds.count("DOUBLE"), kinds.count("SMALLINT"), kinds.count("VARCHAR(100)")) == (38, 1, 15)
    assert types["calories"] == "SMALLINT" and types["burn_bc"] == "DOUBLE"
    assert [r["id"] for r in run.table().select("id").orderBy("id").collect()] == [*range(1, 16), 17, 18, 20]
    assert rows(run.store.finished(st.BAD_ROWS).select("row_number", "error"), "row_number") == [
        (4, "Column 'number_5' expects FLOAT, got 'hello'"),
        (7, "Column 'number_33' expects FLOAT, got 'hi'"),
    ]
    held = [json.loads(r["payload"]) for r in run.store.finished(st.BAD_FILES).orderBy("pos").collect()]
    assert held == [{"name": "Al ", "age": "39"}, {"name": "Bo", "age": "77"}, {"name": "Cy", "age": "78"}]


def test_batches_continue_ids_and_rerun_is_a_no_op(load):
    run = load(NARROW, files_per_batch=1)
    assert run.run_all() == 4
    before = rows(run.table(), "id")
    assert [r[0] for r in before] == [*range(1, 13), 14, 15, 16, 18]
    assert run.run_all() == 0
    assert rows(run.table(), "id") == before


def test_unfinished_run_is_done_again(load, spark):
    run = load(NARROW)
    checkpoint, run._checkpoint = run._checkpoint, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        run.run_all()
    assert run.store.last_run() == 0
    assert run.registered_schema() is None
    run._checkpoint = checkpoint
    run.run_all()
    assert [r["id"] for r in run.table().orderBy("id").collect()] == [*range(1, 13), 14, 15, 16, 18]


def test_edge_files(load):
    run = load(
        {
            "a__csv": "name,note,n\nx,\"one\ntwo\",1\ny,plain,2\n",
            "b__csv": b"\xef\xbb\xbfname,note,n\r\n\r\nz,\"say \"\"hi\"\"\",3\r\n",
            "c__csv": "name,note,n\n",
            "d__csv": "",
            "e__csv": "name,note,n\nq,r,4\nq,r,5,6\n",
            "f__csv": "n,note,name\n7,swapped,w\nbad,word,v\n8\n",
            "g__csv": "id,name,note,n\n1,2,3,4\n",
            "h__csv": "name,note,n\nu,\"open,9\n",
            "i with space__CSV": "Name ,NOTE, n\nk,NULL,10\nk,,10\nk,N/A,10.0\n",
            "j__csv": "name,note,n\nlabel,m,hello,11\nlabel,o,bye,12\n",
        }
    )
    assert run.run_all() == 10
    status = dict(rows(run.store.finished(st.PROCESSED).select("file", "status"), "file"))
    assert status == {
        "a.csv": "loaded", "b.csv": "loaded", "c.csv": "loaded", "d.csv": "unreadable", "e.csv": "unreadable",
        "f.csv": "loaded", "g.csv": "reserved_column", "h.csv": "unreadable", "i with space.CSV": "loaded", "j.csv": "loaded",
    }
    reasons = {r["file"]: r["reason"] for r in run.store.finished(st.BAD_FILES).collect()}
    assert reasons == {
        "d.csv": "empty file", "e.csv": "row longer than the header", "g.csv": "Reserved column: id", "h.csv": "unterminated quote",
    }
    assert rows(run.table().select("id", "name", "note", "n"), "id") == [
        (1, "x", "one\ntwo", 1), (2, "y", "plain", 2), (3, "z", 'say "hi"', 3),
        (4, "w", "swapped", 7), (6, None, None, 8),
        (7, "k", None, 10), (8, "m", "hello", 11), (9, "o", "bye", 12),
    ]
    lines = run.store.finished(st.BAD_FILES).where("file = 'e.csv'").orderBy("pos").collect()
    assert [r["payload"] for r in lines] == ["name,note,n", "q,r,4", "q,r,5,6"]


def test_first_readable_file_defines_the_schema(load):
    run = load({"a__csv": "x,y\n1,2\n1,2,3\n", "b__csv": "p,q\n1,2\n", "c__csv": "x,y\n5,6\n"})
    run.run_all()
    assert run.registered_schema().first_file == "b.csv"
    status = dict(rows(run.store.finished(st.PROCESSED).select("file", "status"), "file"))
    assert status == {"a.csv": "unreadable", "b.csv": "loaded", "c.csv": "schema_mismatch"}


def test_order_of_columns_decides_the_first_error(load):
    run = load({"a__csv": "p,q\n1,2\n3,4\n", "b__csv": "q,p\nbad_q,bad_p\n", "c__csv": "p,q\nbad_p,bad_q\n"})
    run.run_all()
    assert rows(run.store.finished(st.BAD_ROWS).select("file", "error_column"), "file") == [("b.csv", "q"), ("c.csv", "p")]


def test_duplicates_stay_within_their_file(load):
    run = load({"a__csv": "k,v\n1,x\n01,x\n1.0,x\n1,x \n", "b__csv": "k,v\n1,x\n"})
    run.run_all()
    assert rows(run.table().select("id", "k", "v"), "id") == [(1, 1, "x"), (2, 1, "x "), (3, 1, "x")]
    audit = run.store.finished(st.AUDIT).orderBy("file").first()
    assert (audit["rows_in"], audit["duplicates_removed"], audit["rows_staged"]) == (4, 2, 2)


def test_missing_table_is_rebuilt(load, tmp_path):
    run = load(NARROW)
    run.run_all()
    import shutil

    shutil.move(str(tmp_path / "warehouse" / "main_data_table"), str(tmp_path / "gone"))
    land(tmp_path / "landing", data_5__csv="name,age\nUma,3000\nVic,1\n")
    run.run_all()
    assert run.registered_schema().types["age"] == "SMALLINT"
    assert rows(run.table().select("id", "name", "age"), "id") == [(1, "Uma", 3000), (2, "Vic", 1)]


@pytest.mark.parametrize("split, packed", [("97b", None), ("1000b", None), ("1000b", 3), ("64m", None)])
def test_result_does_not_depend_on_splits(load, spark, split, packed):
    lines = [f"{i % 700},w{i % 350}{'x' * (i % 5)}" + ("" if i % 11 else ",") for i in range(3000)]
    body = "k,v,z\n" + "\n".join(line if line.endswith(",") else line + ",ok" for line in lines)
    other = "k,v,z\n" + "\n".join(f"{'no' if i % 9 == 0 else i},w,{i}" for i in range(500))
    seen, expected = set(), []
    for i, line in enumerate(lines):
        key = line if line.endswith(",") else line + ",ok"
        if key not in seen:
            seen.add(key)
            expected.append(key.split(","))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    if packed:
        spark.conf.set("spark.sql.files.maxPartitionNum", packed)
    try:
        run = load({"a__csv": body, "b__csv": other}, chunk_span=512)
        run.run_all()
        got = rows(run.table().select("id", "k", "v", "z"), "id")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.maxPartitionNum")
    want = [(i, int(k), v, z or None) for i, (k, v, z) in enumerate(expected, 1)]
    want += [(len(expected) + i + 1, i, "w", str(i)) for i in range(500) if i % 9]
    assert got == want


def test_line_breaks_in_the_last_quoted_column(load):
    """The line after the break has the right number of commas, so only the open quote tells."""
    run = load({"a__csv": 'n,text\n1,"hello\nfoo, bar"\n2,plain\n', "b__csv": 'n,text\n3,"one, two"\n4,"say ""hi"", you"\n'})
    run.run_all()
    assert rows(run.table().select("id", "n", "text"), "id") == [(1, 1, "hello\nfoo, bar"), (2, 2, "plain"), (3, 3, "one, two"), (4, 4, 'say "hi", you')]
    assert run.store.finished(st.BAD_ROWS).isEmpty()


def test_stray_quotes_are_text(load):
    run = load({"a__csv": 'n,text,more\n1,5" pipe\n2,6" x 7",ok\n3,a"b\n'})
    run.run_all()
    assert rows(run.table().select("n", "text", "more"), "n") == [(1, '5" pipe', None), (2, '6" x 7"', "ok"), (3, 'a"b', None)]


@pytest.mark.parametrize("lines", [1, 5, 20_000])
def test_bytes_that_are_no_text_at_any_size(load, lines):
    good = "".join(f"{i},x\n" for i in range(lines)).encode()
    run = load({"a__csv": "n,größe\n1,ü\n", "b__csv": "n,größe\n".encode() + good + b"7,\xfc\n", "c__csv": "n,größe\n".encode("latin-1") + good})
    run.run_all()
    status = dict(rows(run.store.finished(st.PROCESSED).select("file", "status"), "file"))
    assert status == {"a.csv": "loaded", "b.csv": "unreadable", "c.csv": "unreadable"}


def test_any_number_of_fields_ends_in_quarantine(load):
    run = load({"a__csv": "x,y\n1,2\n", "b__csv": "x,y\n1,2\n" + ",".join("5" * 25_000) + "\n", "c__csv": "x,y\n3,4\n"})
    run.run_all()
    assert rows(run.table().select("id", "x", "y"), "id") == [(1, 1, 2), (2, 3, 4)]
    assert run.store.finished(st.BAD_FILES).first()["reason"] == "row longer than the header"


def test_long_headers_are_read(load):
    """More than 64 MB of header and first row."""
    name = "n" * 1000
    header = ",".join(f"{name}{i}" for i in range(3))
    run = load({"a__csv": f"{header}\n1,2,{'x' * (70 << 20)}\n"})
    assert files_head(run) == 3


def files_head(run):
    from tidegate.sources import files

    row = files.header_registry(run.pending()).first()
    assert row["problem"] is None and row["first_width"] == len(row["columns"])
    return len(row["columns"])


@pytest.mark.parametrize("batch", [1, 2, 100])
def test_values_do_not_depend_on_the_batch(load, batch):
    run = load(
        {"a__csv": "k,v\nx,1\ny,word\nz,2.50\n", "b__csv": "k,v\nx,1.0\ny,2\n", "c__csv": "k,v\nx,7\n", "d__csv": "k,v\nx,1e3\ny,007\n"},
        files_per_batch=batch,
    )
    run.run_all()
    assert run.registered_schema().types["v"] == "DOUBLE"
    assert rows(run.table().select("id", "v"), "id") == [(1, 1.0), (3, 2.5), (4, 1.0), (5, 2.0), (6, 7.0), (7, 1000.0), (8, 7.0)]


@pytest.mark.parametrize("batch", [1, 2, 100])
def test_text_columns_of_number_files_do_not_depend_on_the_batch(load, batch):
    run = load(
        {"a__csv": "v\nword\nother\n1.50\n", "b__csv": "v\n1.0\n2.5\n", "c__csv": "v\n7\n007\n", "d__csv": "v\n1e3\n9007199254740993\n", "e__csv": "v\nTRUE\nfalse\n"},
        files_per_batch=batch,
    )
    run.run_all()
    assert run.registered_schema().types["v"] == "VARCHAR(100)"
    got = rows(run.table().select("id", "_src_file", "v"), "id")
    assert [g[1:] for g in got] == [
        ("a.csv", "word"), ("a.csv", "other"), ("a.csv", "1.50"), ("b.csv", "1"), ("b.csv", "2.5"), ("c.csv", "7"),
        ("d.csv", "1000"), ("d.csv", "9.007199254740992E15"), ("e.csv", "True"), ("e.csv", "False"),
    ]


def test_rows_of_a_dead_run_stay_out(load, tmp_path):
    """The file of a run that died leaves, the number is used again, the file returns."""
    run = load({"a__csv": "k,v\n1,x\n", "b__csv": "k,v\n2,y\n"}, files_per_batch=1)
    checkpoint = run._checkpoint
    calls = []

    def dies_once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        checkpoint(*args)

    run._checkpoint = dies_once
    with pytest.raises(RuntimeError):
        run.run_all()
    landing = tmp_path / "landing"
    (landing / "b.csv").rename(tmp_path / "b.csv")
    land(landing, c__csv="other\n1\n")
    run.run_all()
    assert rows(run.table().select("k", "v"), "k") == [(1, "x")]
    (tmp_path / "b.csv").rename(landing / "b.csv")
    run.run_all()
    assert rows(run.table().select("id", "k", "v"), "id") == [(1, 1, "x"), (2, 2, "y")]


def test_staged_rows_go_and_ids_come_from_control_rows(load, tmp_path):
    run = load(NARROW, files_per_batch=1)
    run.run_all()
    warehouse = tmp_path / "warehouse"
    assert not list(warehouse.glob("staged/run=*")) and not list(warehouse.glob("chunk_tallies/run=*"))
    assert run.last_id() == run.table().agg({"id": "max"}).first()[0]
    assert [r["last_id"] for r in run.store.finished(st.LAST_IDS).orderBy("run").collect()] == [7, 12, 18]


def test_usual_date_layouts(load):
    dates = ["2024-01-05", "2024/01/05", "05-Jan-2024", "5 Jan 2024", "5 January 2024", "2024.01.05", "01/05/2024", "Jan 5, 2024"]
    run = load({"a__csv": "d\n" + "\n".join(["2024-01-05"] * 9) + "\n", "b__csv": "d\n" + "\n".join(f'"{d}"' for d in dates) + "\n2024/13/45\n"})
    run.run_all()
    assert run.registered_schema().types["d"] == "DATE"
    assert {str(r["d"]) for r in run.table().collect()} == {"2024-01-05"}
    assert run.table().where("_src_file = 'b.csv'").count() == len(dates)
    assert run.store.finished(st.BAD_ROWS).count() == 1


CLASHING = ["file", "pos", "copies", "overlong", "open_quote", "run", "_src_file", "ordinal", "_chunk", "_fault"]


def test_columns_may_have_any_name_but_id(load):
    header = ",".join(CLASHING)
    line = ",".join(str(i) for i in range(len(CLASHING)))
    run = load({"a__csv": f"{header}\n{line}\n{line}\n", "b__csv": f"{header}\n{line.replace('5', 'five')}\n{line}\n"}, files_per_batch=1)
    run.run_all()
    table = run.table()
    assert table.columns == ["id", *CLASHING, "_src_file_"]
    assert rows(table, "id") == [(1, *range(len(CLASHING)), "a.csv"), (3, *range(len(CLASHING)), "b.csv")]
    bad = run.store.finished(st.BAD_ROWS).first()
    assert bad["error"] == "Column 'run' expects INT, got 'five'" and json.loads(bad["payload"])["run"] == "five"


def test_long_lists_of_files_are_looked_up_by_few_tasks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(LISTING_TASKS + 60):
        (folder / f"f{i:03}.csv").write_text(f"n\n{i}\n")
    layouts = [Layout(str(p), p.name, ("n",), 1) for p in sorted(folder.iterdir())]
    session = spark.newSession()
    context = session.sparkContext
    context.setJobGroup("many-files", "")
    try:
        found = csv.scan(tune(session), layouts, ["n"]).agg(F.count("n"), F.sum("n")).first()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert tuple(found) == (len(layouts), sum(range(len(layouts))))
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("many-files") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= LISTING_TASKS


def test_a_session_keeps_its_own_number_of_listing_tasks(spark):
    session, (name,) = spark.newSession(), DEFAULTS
    session.conf.set(name, "7")
    assert tune(session).conf.get(name) == "7"
