"""Column helpers against Python and pandas, which define what they mean."""

from __future__ import annotations

import io
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegate.functions import dates, numbers, text
from tidegate.operators import validate

FLOAT_TEXTS = [
    "1", "-1", "+1", " 1 ", "1.", ".5", "1.5", "1e5", "1E+5", "1e-5", "1_000", "1__0", "_1", "1_", "1_0.5_0", "1e1_0",
    "inf", "-inf", "Infinity", "+INFINITY", "infin", "nan", "NaN", "-nan", "1d", "1f", "1D", "0x10", "0x1p3", "", " ",
    "e5", "1e", ".", "-", "+-1", "1 000", "1,000", "twenty", "1.5.2", "1e400", "-1e400", "\t7\n", " 7", "00012", "1e5.5",
]


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(spark, values, expression):
    rows = one_column(spark, values).select("i", expression.alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def python_float(value):
    try:
        return float(value.strip())
    except ValueError:
        return None


def test_vote_grammar_is_python_float(spark):
    got = evaluate(spark, FLOAT_TEXTS, numbers.votes_numeric(F.col("v")))
    assert got == [python_float(v) is not None for v in FLOAT_TEXTS]


def test_vote_value_is_python_float(spark):
    for value, got in zip(FLOAT_TEXTS, evaluate(spark, FLOAT_TEXTS, numbers.vote_value(F.col("v")))):
        want = python_float(value)
        assert got == want or (math.isnan(got) and math.isnan(want)), value


def test_reading_is_what_to_numeric_keeps(spark):
    got = evaluate(spark, FLOAT_TEXTS, numbers.reading_value(F.col("v")))
    want = pd.to_numeric(pd.Series([v.strip() for v in FLOAT_TEXTS]), errors="coerce").tolist()
    for value, g, w in zip(FLOAT_TEXTS, got, want):
        assert (g is None and math.isnan(w)) or g == w, value


@pytest.mark.parametrize("sql_type, low, high", [("TINYINT", -128, 127), ("SMALLINT", -32768, 32767), ("INT", -(2**31), 2**31 - 1), ("BIGINT", -(2**63), 2**63 - 1)])
def test_integer_values(spark, sql_type, low, high):
    texts = [str(low), str(high), str(low - 1), str(high + 1), "22.9", "-22.9", " 7 ", "1e2", "1_0", "1__0", "_1", "x", "inf", "nan", None, "\u00a07"]
    want = [low, high, None, None, 22, -22, 7, 100, 10, None, None, None, None, None, None, 7]
    assert evaluate(spark, texts, numbers.integer_value(F.col("v"), sql_type)) == want


def test_null_tokens_are_those_of_a_csv_reader(spark):
    tokens = [t for t in text.NULL_TOKENS if t]
    assert pd.read_csv(io.StringIO("a,b\n" + "\n".join(f"{t},x" for t in tokens)), dtype=str)["a"].isna().all()
    kept = ["-", "null ", "NONE", "NAN", " NULL", "na", "0"]
    assert not pd.read_csv(io.StringIO("a,b\n" + "\n".join(f"{t},x" for t in kept)), dtype=str)["a"].isna().any()
    assert evaluate(spark, [*text.NULL_TOKENS, *kept], text.decode_null(F.col("v"))) == [None] * len(text.NULL_TOKENS) + kept


HEADERS = [
    "x,x", "x,x,x.1,x", "x,x.1,x", "a,,b,", "Unnamed: 1,", "A B,a_b", "Weight (kg),Max.BPM, Age ", "days/week,X-Y",
    "a.b,a b,a(b", "(),x", ",", "x,X,x ", "id,ID",
]


@pytest.mark.parametrize("header", HEADERS)
def test_header_names_follow_two_readings(header):
    width = header.count(",") + 1
    row = ",".join("1" * width)
    frame = pd.read_csv(io.StringIO(f"{header}\n{row}\n"))
    frame.columns = [text.clean_name(c) for c in frame.columns]
    again = pd.read_csv(io.StringIO(frame.to_csv(index=False)))
    assert text.table_columns(header.split(",")) == list(again.columns)


def test_clean_header_column_matches_the_name_function(spark):
    names = [" Weight (kg) ", "Workout_Frequency (days/week)", "A.B C", "\tx ", "Ünïcode (É)", "()"]
    assert evaluate(spark, names, text.clean_header(F.col("v"))) == [text.clean_name(n) for n in names]


def test_table_columns_of_matches_the_name_function(spark):
    draw = random.Random(3)
    rows = [(h.split(","),) for h in HEADERS]
    rows += [([draw.choice(["a", "A", "a.1", "a_1", "", " a", "b", "a.1.1", "Unnamed: 1", "(a)"]) for _ in range(draw.randrange(12))],) for _ in range(200)]
    got = spark.createDataFrame(rows, "h array<string>").select("h", text.table_columns_of(F.col("h")).alias("c")).collect()
    assert len(got) == len(rows) and all(r["c"] == text.table_columns(r["h"]) for r in got)


def test_names_are_made_unique_by_one_fold_each(spark):
    wide = ["A"] * 300 + ["a.299", "b", "", None]
    rows = spark.createDataFrame([(wide,), (["b", "c"],), ([],), (None,)], "h array<string>")
    found = rows.select("h", text.table_columns_of(F.col("h")).alias("c"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 2
    for r in found.collect():
        assert r["c"] == (None if r["h"] is None else text.table_columns([n or "" for n in r["h"]]))


DATES = [
    ("2024-01-31", "2024-01-31"), ("2024-1-3", "2024-01-03"), ("2024-13-45", None), ("2023-02-29", None),
    ("10/02/1997", "1997-10-02"), ("31/12/1997", "1997-12-31"), ("13/13/1997", None), ("19970203", "1997-02-03"),
    ("19971350", None), ("Feb 3 1997", "1997-02-03"), ("February 3, 1997", "1997-02-03"), ("1997", "1997-01-01"),
    ("1997-02-03 10:11:12", "1997-02-03"), ("1997-02-03T10:11:12.5Z", "1997-02-03"), ("1997-02-03 10:11", "1997-02-03"),
    ("soon", None), ("", None), (" 2024-01-31 ", "2024-01-31"), ("2024-01-31x", None),
]


def test_dates(spark):
    got = evaluate(spark, [d for d, _ in DATES], dates.date_value(text.strip(F.col("v"))).cast("string"))
    assert got == [w for _, w in DATES]
    for value, want in DATES:
        if value:
            parsed = pd.to_datetime(value, errors="coerce", dayfirst=value.startswith("31"))
            assert (None if pd.isna(parsed) else parsed.strftime("%Y-%m-%d")) == want


def test_messages_and_strict_lengths(spark):
    rows = spark.createDataFrame([("x", "long text"), (None, "ok")], "n string, s string")
    types = {"n": "INT", "s": "VARCHAR(5)"}
    loose = validate.check_rows(rows, types).select(validate.fault_message().alias("e")).collect()
    assert [r["e"] for r in loose] == ["Column 'n' expects INT, got 'x'", None]
    strict = validate.check_rows(rows.where("n is null or s = 'ok'").union(spark.createDataFrame([("1", "too long")], rows.schema)), types, strict=True)
    assert {r["e"] for r in strict.select(validate.fault_message().alias("e")).collect()} == {None, "Column 's' expects VARCHAR(5), got 'too long'"}


def test_only_text_columns_take_every_row(spark):
    rows = spark.createDataFrame([("x",)], "s string")
    checked = validate.check_rows(rows, {"s": "VARCHAR(100)"})
    assert validate.good_rows(checked, {"s": "VARCHAR(100)"}).count() == 1
    assert validate.bad_rows(checked, {"s": "VARCHAR(100)"}).count() == 0
