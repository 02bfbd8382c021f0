"""Operators on small tables, against rules worked out by hand or pandas."""

from __future__ import annotations

import random

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegate.functions import quantiles
from tidegate.functions.quantiles import exact_percentiles
from tidegate.operators import audit, clean, gate, ids, infer, profile, validate
from tidegate.sinks import export

INFERENCE = [
    ([None, None], "VARCHAR(255)"),
    (["77", "91", "twenty", "55"], "TINYINT"),
    (["22", "33", None, "44"], "TINYINT"),
    (["1", "x"], "VARCHAR(100)"),
    (["1", "2", "x"], "TINYINT"),
    (["127", "-128"], "TINYINT"),
    (["128", "0"], "SMALLINT"),
    (["32768", "0"], "INT"),
    (["2147483648", "0"], "BIGINT"),
    ([str(2**63 - 1), "0"], "BIGINT"),
    ([str(2**63), "0"], "DOUBLE"),
    ([str(2**63 - 1), None], "DOUBLE"),
    ([str(2**64), "-1"], "DOUBLE"),
    (["1.0", "2.0"], "TINYINT"),
    (["1952.0", "300.0"], "SMALLINT"),
    (["1.5", "2.0"], "DOUBLE"),
    (["1e20", "2e20"], "DOUBLE"),
    (["inf", "1"], "DOUBLE"),
    (["1_000", "2_000", "3"], "TINYINT"),
    (["1_000", "2_000", "x"], "VARCHAR(255)"),
    (["True", "false", "TRUE"], "BOOLEAN"),
    (["True", None], "VARCHAR(100)"),
    (["True", "1"], "VARCHAR(100)"),
    (["2024-01-02", "2024-13-45"], "DATE"),
    (["2024-01-02", None], "DATE"),
    (["2024-01-02", "2024-1-2"], "VARCHAR(100)"),
    (["x" * 50], "VARCHAR(100)"),
    (["x" * 51], "VARCHAR(200)"),
    (["x" * 100], "VARCHAR(200)"),
    (["x" * 101], "VARCHAR(500)"),
    (["x" * 255], "VARCHAR(500)"),
    (["x" * 256], "VARCHAR(2000)"),
    (["x" * 1000], "VARCHAR(2000)"),
    (["x" * 1001], "VARCHAR(65533)"),
]


def test_type_rules_in_one_wide_table(spark):
    """All cases as the columns of one table, so that wide tables are covered too."""
    height = max(len(v) for v, _ in INFERENCE)
    names = [f"c{i}" for i in range(len(INFERENCE))]
    for padded in range(1, height + 1):
        picked = [i for i, (v, _) in enumerate(INFERENCE) if len(v) == padded]
        if not picked:
            continue
        rows = [tuple(INFERENCE[i][0][r] for i in picked) for r in range(padded)]
        df = spark.createDataFrame(rows, ", ".join(f"{names[i]} string" for i in picked))
        got = infer.collect_types(infer.infer_schema(df))
        assert got == {names[i]: INFERENCE[i][1] for i in picked}


def test_typed_sources(spark):
    df = spark.sql(
        "SELECT id AS n, id * 1.0D AS whole, id / 3.0D AS part, current_timestamp() AS ts, current_date() AS d, id = 1 AS b, 'x' AS s, "
        "CASE WHEN id = 0 THEN double('NaN') ELSE 5.0D END AS gap FROM range(300)"
    )
    assert infer.collect_types(infer.infer_schema(df)) == {
        "n": "SMALLINT", "whole": "SMALLINT", "part": "DOUBLE", "ts": "DATETIME", "d": "DATE", "b": "BOOLEAN", "s": "VARCHAR(100)", "gap": "TINYINT",
    }


def test_ddl_creates_a_bucketed_table(spark):
    types = {"name": "VARCHAR(100)", "days/week": "TINYINT", "when": "DATE"}
    table = "tidegate_ddl_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    try:
        export.create_table(spark, table, types)
        rows = spark.sql("SELECT id, CAST(id AS STRING) AS name, CAST(1 AS TINYINT) AS `days/week`, DATE'2024-01-01' AS when FROM range(100)")
        export.append_table(rows, table)
        export.append_table(rows.select("when", "name", "days/week", "id"), table)
        assert spark.table(table).count() == 200
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
        assert described["Num Buckets"] == "3" and described["days/week"] == "tinyint"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_dedupe_keeps_the_first_and_blanks_matter_in_text(spark):
    rows = [("a", 3, "1", "x"), ("a", 1, "1.0", "x"), ("a", 2, " 1 ", "x "), ("b", 1, "1", "x"), ("a", 4, None, None), ("a", 5, None, None)]
    df = spark.createDataFrame(rows, "f string, pos long, n string, s string")
    kinds = clean.reading_kinds(df, "f", ["n", "s"])
    out = clean.dedupe_rows(kinds.apply(df), "f", "pos", ["n", "s"])
    got = sorted((r["f"], r["pos"], r["n"], r["s"], r["copies"]) for r in out.collect())
    assert got == [("a", 1, "1", "x", 2), ("a", 2, "1", "x ", 1), ("a", 4, None, None, 2), ("b", 1, "1", "x", 1)]


def test_columns_that_read_alike_take_their_type(spark):
    rows = [("a", "1", "1.50", "TRUE", "x", None), ("b", " 02 ", "1e1", "false", "1", None), ("b", "3", "inf", "True", "2", None)]
    df = spark.createDataFrame(rows, "f string, i string, d string, b string, s string, e string")
    out = clean.reading_kinds(df, "f", ["i", "d", "b", "s", "e"]).apply(df)
    assert out.dtypes[1:] == [("i", "bigint"), ("d", "double"), ("b", "boolean"), ("s", "string"), ("e", "string")]
    assert sorted(r["i"] for r in out.collect()) == [1, 2, 3]
    types = {"i": "TINYINT", "d": "SMALLINT", "b": "VARCHAR(100)", "s": "VARCHAR(100)", "e": "DATE"}
    checked = validate.check_rows(out, types)
    good = validate.good_rows(checked, types).orderBy("i").collect()
    assert [tuple(r) for r in good] == [(1, 1, "True", "x", None), (2, 10, "False", "1", None)]
    bad = validate.bad_rows(checked, types).first()
    assert (bad["error"], bad["b"]) == ("Column 'd' expects INT, got 'Infinity'", "True")


def test_a_column_may_read_differently_in_each_file(spark):
    rows = [("a", 1, "01"), ("a", 2, "1"), ("b", 1, "01"), ("b", 2, "x"), ("c", 1, "TRUE"), ("c", 2, "true"), ("d", 1, "1.50"), ("d", 2, "1.5")]
    df = spark.createDataFrame(rows, "f string, pos long, n string")
    out = clean.dedupe_rows(clean.reading_kinds(df, "f", ["n"]).apply(df), "f", "pos", ["n"])
    got = sorted((r["f"], r["n"], r["copies"]) for r in out.collect())
    assert got == [("a", "1", 2), ("b", "01", 1), ("b", "x", 1), ("c", "True", 2), ("d", "1.5", 2)]


def test_long_integers_keep_their_digits_beside_nulls(spark):
    df = spark.createDataFrame([("a", 1, "9007199254740993"), ("a", 2, None)], "f string, pos long, n string")
    out = clean.reading_kinds(df, "f", ["n"]).apply(df)
    assert {r["n"] for r in out.collect()} == {9007199254740993, None}


def sequential_ids(rows, base):
    """One file after the other, continuing from the last good id."""
    last, out = base, {}
    for name in sorted({f for f, _, _ in rows}):
        mine = sorted((p, good) for f, p, good in rows if f == name)
        given = [(p, good, last + i) for i, (p, good) in enumerate(mine, 1)]
        out.update({(name, p): (i, given_id) for i, (p, _, given_id) in enumerate(given, 1)})
        last = max([g for _, good, g in given if good], default=last)
    return out


@pytest.mark.parametrize("seed, span, partitions", [(1, 4, 1), (2, 64, 5), (3, 1, 13), (4, 10_000, 3)])
def test_ids_equal_a_sequential_model(spark, seed, span, partitions):
    rng = random.Random(seed)
    rows = []
    for f in range(6):
        size = 2500 if f == 2 else rng.randrange(0, 40)  # one hot file
        bad = 1.0 if f == 4 else 0.3
        rows += [(f"f{f}", p, rng.random() > bad) for p in rng.sample(range(size * 3 + 1), size)]
    df = spark.createDataFrame(rows, "f string, pos long, good boolean").repartition(partitions)
    out = ids.number_rows(df, "f", "pos", F.col("good"), base=100, span=span).collect()
    assert {(r["f"], r["pos"]): (r["ordinal"], r["id"]) for r in out} == sequential_ids(rows, 100)


def test_ids_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tidegate.session.BROADCAST_BYTES", 0)
    rows = [(f"f{i % 3}", i, i % 5 > 0) for i in range(200)]
    df = spark.createDataFrame(rows, "f string, pos long, good boolean")
    out = ids.number_rows(df, "f", "pos", F.col("good"), span=8).collect()
    assert {(r["f"], r["pos"]): (r["ordinal"], r["id"]) for r in out} == sequential_ids(rows, 0)


@pytest.mark.parametrize("buckets", [2, 7, 8192])
def test_percentiles_are_exact(spark, buckets):
    rng = np.random.default_rng(buckets)
    frame = pd.DataFrame(
        {
            "even": rng.random(997),
            "heavy": np.where(rng.random(997) < 0.4, 5.0, rng.exponential(1e6, 997)),
            "wide": rng.choice([-1e300, 1e-300, 0.0, 1e300, 3.5], 997),
            "whole": rng.integers(-1000, 1000, 997).astype(float),
            "one": np.full(997, 2.5),
            "gaps": np.where(rng.random(997) < 0.5, np.nan, rng.normal(size=997)),
        }
    )
    df = spark.createDataFrame(frame)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_percentiles(df, list(frame.columns), shares, buckets=buckets)
    for c in frame.columns:
        want = [frame[c].quantile(s) for s in shares]
        assert got[c] == pytest.approx(want, rel=1e-12), c


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_percentiles(df, ["x"], [0.5]) == {"x": [None]}


def test_infinite_values_have_ranks_too(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (3.0,), (float("inf"),)], "x double")
    assert exact_percentiles(df, ["x"], [0.0, 0.5, 1.0]) == {"x": [float("-inf"), 2.0, float("inf")]}


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 400
    out = pd.DataFrame(
        {
            "x": rng.normal(size=n).round(2),
            "y": rng.integers(0, 50, n).astype(float),
            "same": np.full(n, 3.0),
            "s": rng.choice(["a", "b", "c"], n),
            "t": [f"v{i % 37}" for i in range(n)],
        }
    )
    out.loc[::17, "x"] = np.nan
    out.loc[::23, "s"] = None
    out.loc[3, "x"] = 99.0
    return pd.concat([out, out.head(20)], ignore_index=True)


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame, "x double, y double, same double, s string, t string")


def as_dict(df, *values):
    return {r["column"]: tuple(r[v] for v in values) if len(values) > 1 else r[values[0]] for r in df.collect()}


def test_profile_of_columns(table, frame):
    assert as_dict(profile.column_nulls(table), "nulls") == frame.isnull().sum().to_dict()
    numbers = frame[["x", "y", "same"]]
    summary = as_dict(profile.numeric_summary(table), "min_value", "max_value", "mean", "median")
    for c in numbers:
        assert summary[c] == pytest.approx((frame[c].min(), frame[c].max(), frame[c].mean(), frame[c].median()))
    limits = {c: (frame[c].mean() - 3 * frame[c].std(), frame[c].mean() + 3 * frame[c].std()) for c in numbers}
    want = {c: int(((frame[c] < lo) | (frame[c] > hi)).sum()) for c, (lo, hi) in limits.items()}
    assert as_dict(profile.outliers(table), "outliers") == want
    assert as_dict(profile.distinct_values(table), "distinct_values") == {"s": 3, "t": 37}
    assert as_dict(profile.repeated_values(table), "duplicates") == {c: int(frame[c].duplicated().sum()) for c in frame}
    top = frame["s"].value_counts()
    assert as_dict(profile.column_modes(table), "mode", "occurrences") == {"s": (top.index[0], int(top.iloc[0]))}


def test_profile_of_values(table, frame):
    got = {(r["column"], r["value"]): r["n"] for r in profile.top_values(table).collect()}
    assert len([k for k in got if k[0] == "t"]) == 10
    assert {v: n for (c, v), n in got.items() if c == "s"} == frame["s"].value_counts().to_dict()
    bins = {}
    for r in profile.histogram(table).collect():
        bins.setdefault(r["column"], {})[r["bin"]] = r["n"]
    want, _ = np.histogram(frame["y"], bins=30)
    assert [bins["y"].get(i, 0) for i in range(30)] == want.tolist()
    assert bins["same"] == {0: len(frame)}
    assert sum(bins["x"].values()) == frame["x"].count()
    box = as_dict(profile.box_summary(table), "q1", "median", "q3", "low_fence", "high_fence", "outside")
    for c in ("x", "y", "same"):
        q1, q2, q3 = frame[c].quantile([0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert box[c] == pytest.approx((q1, q2, q3, low, high, int(((frame[c] < low) | (frame[c] > high)).sum())))


def test_correlation_is_pairwise_and_null_for_constants(spark, table, frame):
    want = frame[["x", "y", "same"]].corr()
    got = {(r["column_a"], r["column_b"]): r["r"] for r in profile.correlation(table).collect()}
    assert got["x", "y"] == pytest.approx(want.loc["x", "y"])
    assert got["x", "same"] is None and got["y", "same"] is None
    # far from zero, constant where both are there, infinite, and nothing at all
    rows = [(1e9 + i, 2e9 - i, 0.1 if i < 5 else None, None, float("inf") if i == 3 else float(i)) for i in range(10)] + [(None, 5.0, 7.3, None, 2.0)]
    odd = {(r["column_a"], r["column_b"]): r["r"] for r in profile.correlation(spark.createDataFrame(rows, "a double, b double, c double, d double, e double")).collect()}
    assert odd["a", "b"] == pytest.approx(-1) and odd["a", "c"] is None and odd["a", "d"] is None and np.isnan(odd["a", "e"]) and len(odd) == 10
    assert profile.correlation(table, ["x"]).collect() == []
    nothing = profile.correlation(spark.createDataFrame([], "a double, b int"))
    assert [r["r"] for r in nothing.collect()] in ([], [None])


def test_prints_tell_values_and_rows_apart(spark):
    long = "x" * 40
    rows = [(long, 0.0, [1.0, None], b"a"), (long, -0.0, [1.0, None], b"a"), (long + "y", float("nan"), None, b"a"), (long + "y", float("nan"), None, b"a"), (None, None, [], None), ("1:a", 1.0, [], b""), ("1", 1.0, [], b"")]
    df = spark.createDataFrame(rows, "s string, d double, a array<double>, b binary")
    assert df.select(profile.row_print(df, df.columns)).distinct().count() == 5
    digest = df.where(F.length("s") == 40).select(profile.printed(F.col("s")).alias("p")).first()["p"]
    odd = spark.createDataFrame([(long,), (long,), ("short",), (bytes(digest).hex(),), ("",)], "s string")
    assert as_dict(profile.distinct_values(odd), "distinct_values") == {"s": 4} and as_dict(profile.repeated_values(odd), "duplicates") == {"s": 1}
    score = profile.quality_score(df).first()
    assert score["uniqueness"] == pytest.approx(100 - 200 / 7) and score["completeness"] == pytest.approx(75)


def test_mode_rules_wide_columns_out(spark):
    df = spark.range(2000).selectExpr("concat('v', id % 10) AS ten", "concat('v', id % 11) AS eleven", "concat('v', id) AS wide")
    assert as_dict(profile.column_modes(df), "mode", "occurrences") == {"ten": ("v0", 200)}
    assert profile.column_modes(df, ["wide"]).collect() == [] and profile.column_modes(df.select(F.lit(1).alias("n"))).collect() == []


def test_everything_by_one_call(spark, table, frame):
    """The one call says what the single ones say, and whatever a table has no columns for is left out."""
    got = {(r["column"], r["metric"], r["text"]): r["value"] for r in profile.profile(table).collect()}
    box = as_dict(profile.box_summary(table), "q1", "q3", "low_fence", "high_fence", "outside")
    for c in ("x", "y", "same"):
        assert tuple(got[c, m, None] for m in ("q1", "q3", "low_fence", "high_fence", "outside")) == box[c]
        assert got[c, "median", None] == pytest.approx(frame[c].median())
    assert {(c, int(b)): n for (c, m, b), n in got.items() if m == "bin"} == {(r["column"], r["bin"]): r["n"] for r in profile.histogram(table).collect()}
    assert {(c, v): n for (c, m, v), n in got.items() if m == "top_value"} == {(r["column"], r["value"]): r["n"] for r in profile.top_values(table).collect()}
    assert got["x", "correlation", "y"] == pytest.approx(frame["x"].corr(frame["y"])) and got["x", "correlation", "same"] is None
    assert {m for _, m, _ in got} >= {"nulls", "duplicate_pct", "mean", "outliers", "distinct_values", "mode"}
    metrics = lambda df: {r.metric for r in profile.profile(df).collect()}
    assert not metrics(table.select("x")) & {"correlation", "distinct_values", "mode", "top_value"} and "bin" in metrics(table.select("x"))
    assert not metrics(table.select("s")) & {"correlation", "bin", "q1", "mean"}
    assert metrics(table.where("false")) & {"nulls", "outside", "correlation"} and not metrics(table.where("false")) & {"bin", "top_value", "mode"}


def test_profile_of_tables(spark, table, frame):
    totals = profile.table_totals(table).first()
    assert tuple(totals) == (len(frame), 5, int(frame.isnull().sum().sum()))
    score = profile.quality_score(table.withColumn("id", F.monotonically_increasing_id())).first()
    complete = 100 - frame.isnull().sum().sum() / frame.size * 100
    unique = 100 - frame.duplicated().sum() / len(frame) * 100
    assert tuple(score) == (pytest.approx(complete), pytest.approx(unique), pytest.approx((complete + unique) / 2), "green")
    stats = profile.table_stats({"small": spark.range(3), "big": table})
    assert [tuple(r) for r in stats.collect()] == [("big", len(frame), 5), ("small", 3, 1)]
    assert tuple(profile.table_stats_summary(stats).first()) == (2, len(frame) + 3, (len(frame) + 3) / 2)
    sizes = as_dict(profile.data_size(table), "bytes")
    assert sizes["x"] == 8 * len(frame) and sizes["t"] == int(frame["t"].str.len().sum())


def test_gate_and_router(spark):
    rows = [("b.csv", ["x", "y"]), ("a.csv", ["y", "x"]), ("c.csv", ["z"]), ("d.csv", ["id", "x", "y"])]
    registry = spark.createDataFrame(rows, "file string, columns array<string>").withColumn("schema_key", gate.schema_key(F.col("columns")))
    assert tuple(gate.main_schema(registry).first()) == ("a.csv", "x|y")
    judged = gate.judge_files(registry, F.lit("x|y"), columns="columns")
    got = {r["file"]: (r["status"], r["reason"]) for r in judged.collect()}
    assert got == {
        "a.csv": ("accepted", None),
        "b.csv": ("accepted", None),
        "c.csv": ("schema_mismatch", "Schema mismatch. Expected: x|y, Got: z"),
        "d.csv": ("reserved_column", "Reserved column: id"),
    }
    routed = {r["file"]: r["table_name"] for r in gate.route_by_schema(registry).collect()}
    assert routed == {"a.csv": "tbl_1", "b.csv": "tbl_1", "c.csv": "tbl_2", "d.csv": "tbl_3"}


def test_backlog_is_a_true_difference(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    done = spark.createDataFrame([("a",), ("a",), ("gone",)], "file string")
    assert tuple(audit.backlog(files, done).first()) == (3, 1, 2)


def test_errors_follow_the_column_order_of_the_file(spark):
    df = spark.createDataFrame([("x", "y", [0, 1]), ("x", "y", [1, 0]), ("1", "y", [0, 1]), ("1", "2", [1, 0])], "p string, q string, places array<int>")
    types = {"p": "INT", "q": "DOUBLE"}
    got = validate.check_rows(df, types, places="places").select(F.col(validate.FAULT)["column"].alias("c")).collect()
    assert [r["c"] for r in got] == ["p", "q", "q", None]


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_take_few_passes_for_any_spread(spark, seed):
    """Values over 600 decades, of either sign, with zeros, ties and infinities."""
    draw = np.random.default_rng(seed)
    values = np.sort(draw.choice([-1, 1], 1500) * 10.0 ** draw.uniform(-300, 300, 1500))
    values = np.concatenate([values, [0.0, -0.0, 5e-324, 1e308, -1e308, float("inf"), float("-inf")], values[:300], np.full(50, 0.1)])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    ranks = [0, 1, 400, 929, 1000, len(values) // 2, len(values) - 2, len(values) - 1]
    for few, scans in ((quantiles.FEW, 2), (0, quantiles.MOST_SCANS)):
        found = quantiles.Ranks(df, ["x"], few=few)
        assert {r: v for (_, r), v in found.at({"x": set(ranks)}).items()} == {r: float(np.sort(values)[r]) for r in ranks}
        assert found.scans <= scans


@pytest.mark.parametrize("few", [1 << 16, 3])
def test_ranks_keep_all_digits(spark, few):
    draw = np.random.default_rng(few)
    longs = [int(v) for v in draw.integers(-(2**63), 2**63 - 1, 300)] + [2**53 + 1, 2**53 + 2, 2**53 + 3, 2**63 - 1, -(2**63), 0, 0, -1, 1]
    prices = [Decimal(int(v)).scaleb(-2) for v in draw.integers(-(10**17), 10**17, len(longs))]
    df = spark.createDataFrame([(x, p, None if i % 3 else i) for i, (x, p) in enumerate(zip(longs, prices))], "x long, p decimal(18,2), i smallint").repartition(4)
    found = quantiles.Ranks(df, ["x", "p", "i"], buckets=1 << 8, few=few)
    ranks = set(range(0, len(longs), 17)) | {len(longs) - 1}
    got = found.at({"x": ranks, "p": ranks})
    assert {r: got["x", r] for r in ranks} == {r: sorted(longs)[r] for r in ranks} and {r: got["p", r] for r in ranks} == {r: sorted(prices)[r] for r in ranks}
    assert found.range("x") == (-(2**63), 2**63 - 1) and found.range("p") == (min(prices), max(prices)) and found.count("i") == len(longs[::3])
    assert found.mean("p") == pytest.approx(float(sum(prices)) / len(prices))
    wide = spark.createDataFrame([(2**53 + 1,), (2**53 + 3,), (2**53 + 4,), (2**53 + 5,)], "x long")
    row = profile.numeric_summary(wide).first()
    assert (row["least"], row["greatest"], row["middle"]) == ("9007199254740993", "9007199254740997", "9007199254740995.5")


def test_correlation_of_many_columns(spark):
    draw = np.random.default_rng(5)
    frame = pd.DataFrame(draw.normal(size=(60, 24)), columns=[f"c{i}" for i in range(24)])
    frame = frame.mask(draw.random(frame.shape) < 0.1)
    frame["flat"] = 1.0
    want = frame.corr()
    got = profile.correlation(spark.createDataFrame(frame)).collect()
    assert len(got) == 25 * 24 // 2
    for r in got:
        expected = want.loc[r["column_a"], r["column_b"]]
        assert (r["r"] is None and np.isnan(expected)) or r["r"] == pytest.approx(expected)
