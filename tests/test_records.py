"""Records over line ends, read by many splits, against a reader that goes through the file in order."""

from __future__ import annotations

import csv
import io
import random

import pytest

from tidegate.operators import ids
from tidegate.plans.ingest import Load, LoadConfig
from tidegate.sources import csv as source
from tidegate.sources import records
from tidegate.sources.csv import Layout
from tidegate.sources.records import open_after


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def sequential(text: str) -> list[list[str]]:
    """Records by Python's reader, which takes a quote inside an unquoted field as text too."""
    return [r for r in csv.reader(io.StringIO(text, newline="")) if any(f.strip() for f in r) or len(r) > 1][1:]


def field(draw: random.Random) -> str:
    plain = "".join(draw.choice(['a', 'b"', " ", "é", "x\ty"]) for _ in range(draw.randrange(6)))
    if plain.startswith('"') or draw.random() < 0.5:
        inner = "".join(draw.choice(["k", ",", "\n", "\r\n", '""', " ", "long words here "]) for _ in range(draw.randrange(9)))
        return f'"{inner}"'
    return plain


def written(draw: random.Random, rows: int, width: int) -> str:
    lines = [",".join(f"h{i}" for i in range(width))]
    lines += [",".join(["r%d" % n] + [field(draw) for _ in range(width - 1)]) for n in range(rows)]
    out = ""
    for line in lines:
        out += line + draw.choice(["\n", "\n", "\r\n", "\n\n"])
    return out if draw.random() < 0.7 else out.rstrip("\r\n")


@pytest.mark.parametrize("seed", range(4))
def test_records_of_many_splits(spark, small_splits, tmp_path, seed):
    draw = random.Random(seed)
    texts = {f"f{k}.csv": written(draw, draw.choice([1, 5, 40]), 3) for k in range(4)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    rows = source.scan_fields(spark, [str(tmp_path / n) for n in texts], 3, True)
    assert rows.rdd.getNumPartitions() > 4
    found = ids.number_rows(rows, "file", "pos", span=1 << 15).orderBy("file", ids.ORDINAL).collect()
    for name, text in texts.items():
        own = [r for r in found if r["file"] == name]
        want = sequential(text)
        assert [r[ids.ORDINAL] for r in own] == list(range(1, len(want) + 1))
        assert [[r[f"_c{i}"] or "" for i in range(3)] for r in own] == want and not any(r["open_quote"] or r["fields"] > 3 for r in own)
        assert len({r["pos"] >> 15 for r in own}) > 1 or len(want) < 40


@pytest.mark.parametrize(
    "line, outside, inside",
    [(b"a,b", False, True), (b'a,"b', True, False), (b'"', True, False), (b'""', False, True), (b'a"b', False, False), (b'"a"', False, False), (b'"a""', True, False), (b'x","y', True, True)],
)
def test_states_of_lines(line, outside, inside):
    assert (open_after(line, False), open_after(line, True)) == (outside, inside)


def test_a_record_as_long_as_many_splits(spark, small_splits, tmp_path):
    long = "\n".join(f"line {i}, with a comma" for i in range(60))
    (tmp_path / "a.csv").write_text(f'k,v\n1,"{long}"\n2,short\n3,"{long}"', newline="")
    rows = source.scan_fields(spark, [str(tmp_path / "a.csv")], 2, True).orderBy("pos").collect()
    assert [(r["_c0"], r["_c1"]) for r in rows] == [("1", long), ("2", "short"), ("3", long)]


def test_a_quote_that_never_closes(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,x\n2,"no end' + "\nmore text" * 30, newline="")
    rows = source.scan_fields(spark, [str(tmp_path / "a.csv")], 2, True).orderBy("pos").collect()
    assert [r["open_quote"] for r in rows] == [False, True]


def test_any_number_of_fields_over_line_ends(spark, tmp_path):
    """A million fields in a file with a quoted line end make it unreadable, and nothing else fails."""
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("k,v\n1,x\n2,y\n")
    (landing / "b.csv").write_text('k,v\n3,"over\nlines"\n' + ",".join("9" * 1_100_000) + "\n")
    (landing / "c.csv").write_text('k,v\n4,"two\nlines"\n')
    load = Load(spark, LoadConfig(str(landing), str(tmp_path / "warehouse")))
    load.run_all()
    status = {r["file"]: r["status"] for r in load.store.finished("processed_files").collect()}
    assert status == {"a.csv": "loaded", "b.csv": "unreadable", "c.csv": "loaded"}
    assert sorted((r["k"], r["v"]) for r in load.table().collect()) == [(1, "x"), (2, "y"), (4, "two\nlines")]


@pytest.fixture
def cores(spark):
    """Sets how many cores Spark believes to have, by which it would cut files."""
    name, cost = "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, "1")
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.unset(name)
    spark.conf.set(cost, before)


def test_executors_that_come_and_go_move_no_split(spark, cores, tmp_path):
    """Positions are those of splits, and later scans of a file must find them again."""
    text = written(random.Random(5), 300, 3)
    (tmp_path / "a.csv").write_text(text, encoding="utf-8", newline="")
    layout = Layout(str(tmp_path / "a.csv"), "a.csv", ("a", "b", "c"), 3, True)
    cores(3)
    rows = source.scan(spark, [layout], ["a", "b", "c"])
    cores(17)
    numbered = ids.number_rows(rows, "file", "pos", span=1 << 15)
    cores(40)
    found = numbered.orderBy(ids.ORDINAL).collect()
    assert [[r[c] or "" for c in "abc"] for r in found] == sequential(text)
    assert [r[ids.ORDINAL] for r in found] == list(range(1, len(found) + 1))


def test_bad_rows_are_found_again_while_executors_go(spark, cores, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    landing.mkdir()
    for f in "ab":
        (landing / f"{f}.csv").write_text("k,v\n" + "".join(f"{'x' if i % 50 == 7 else i},{f}{i}\n" for i in range(400)))
    scan, seen = source.scan, []

    def moving(*args):
        seen.append(args)
        cores(3 + 5 * len(seen))
        return scan(*args)

    monkeypatch.setattr(source, "scan", moving)
    load = Load(spark, LoadConfig(str(landing), str(tmp_path / "warehouse"), chunk_span=1 << 15))
    load.run_all()
    assert len(seen) > 2
    bad = load.store.finished("quarantine_rows").collect()
    assert sorted((r["file"], r["row_number"]) for r in bad) == [(f"{f}.csv", i + 2) for f in "ab" for i in range(400) if i % 50 == 7]
    assert load.table().count() == 2 * (400 - 8) and all(r["payload"] for r in bad)


@pytest.mark.parametrize("seed", range(2))
def test_more_splits_than_can_be_broadcast(spark, small_splits, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(records, "lookup", lambda df, *_: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        text = written(random.Random(seed), 200, 3)
        (tmp_path / "a.csv").write_text(text, encoding="utf-8", newline="")
        rows = source.scan_fields(spark, [str(tmp_path / "a.csv")], 3, True).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert [[r[f"_c{i}"] or "" for i in range(3)] for r in rows] == sequential(text)
