import random

import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from plumbline.functions import measures, ordered, text
from plumbline.functions.formulas import formula_column, formula_variables


def one(spark, df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_strip_matches_python(spark, frame):
    cases = ["\t a \n", "\xa0x　", " ", "", "a b", "\x1cq"]
    assert one(spark, frame("v", [(c,) for c in cases]), text.strip(F.col("v"))) == [c.strip() for c in cases]
    assert one(spark, frame("v", [(c,) for c in cases]), text.has_value(F.col("v"))) == [bool(c.strip()) for c in cases]


@pytest.mark.parametrize("value,expected", [
    ("12,5", 12.5), ("12.5", 12.5), ("1e5", 1e5), ("5d", None), ("nan", None), ("inf", float("inf")), ("+3", 3.0),
    ("1.", 1.0), (".5", 0.5), ("1,2,3", None), ("0x10", None), (" 7 ", 7.0), ("\xa07\t", 7.0), ("", None), ("1_0", None),
    ("-Infinity", float("-inf")), ("5f", None), (None, None),
])
def test_number(spark, frame, value, expected):
    assert one(spark, frame("v", [(value,)]), text.to_number(F.col("v"))) == [expected]


def test_integer_text(spark, frame):
    cases = [("5", True), ("5\n6", False), (" +7\n", True), ("5.5", False), ("-0", True), ("٣", False)]
    assert one(spark, frame("v", [(c,) for c, _ in cases]), text.is_integer_text(F.col("v"))) == [e for _, e in cases]


@pytest.mark.parametrize("value,fmt,expected", [
    ("1.2.2026", "DD.MM.YYYY", "2026-02-01"), ("01.02.26", "DD.MM.YYYY", None), ("31.02.2026", "DD.MM.YYYY", None),
    ("29.11.0021", "DD.MM.YYYY", None), ("001.2.2026", "DD.MM.YYYY", None), ("1.2026", "MM.YYYY", "2026-01-01"),
    ("02-28-2020", "MM-DD-YYYY", "2020-02-28"), ("13-2020", "MM-YYYY", None), ("2026-01-15", "YYYY-MM-DD", "2026-01-15"),
    ("2026-01-15", "odd", None), (" 5.6.2000 ", "DD.MM.YYYY", "2000-06-05"), (None, "DD.MM.YYYY", None),
])
def test_date_by_format(spark, frame, value, fmt, expected):
    got = one(spark, frame("v f", [(value, fmt)]), text.to_date_in(F.col("v"), F.col("f")).cast("string"))
    assert got == [expected]


def test_missing_tokens(spark, frame, rows):
    got = rows(text.normalise_nulls(frame("v", [("NA",), ("n/a",), ("",), ("x",), ("None",)])))
    assert sorted(map(str, got)) == ["('x',)"] + ["(None,)"] * 4


def test_rounding_matches_python_and_pandas(spark):
    random.seed(3)
    values = [2.675, 1.005, 0.125, 0.375, 2.5, -0.125, 109480.665, 1e17] + [
        random.randint(-10**7, 10**7) / 1000 for _ in range(3000)]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = df.select("v", measures.round_exact(F.col("v"), 2).alias("e"), measures.round_scaled(F.col("v"), 2).alias("s")).toPandas()
    assert [round(float(v), 2) for v in got.v] == list(got.e)
    assert list(got.v.round(2)) == list(got.s)


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "n int, d int")
    assert one(spark, df, measures.percent(F.col("n"), F.col("d"))) == [33.33, None]


@pytest.mark.parametrize("formula", [
    "weight / ((height / 100) ** 2)", "9.57 * ln(max(weight, 1)) - -height", "round(weight / 3, 1) + abs(-height)",
    "min(weight, height, 3) * sqrt(height)", "2 * exp(0.01 * weight) - log(height)",
])
def test_formula_matches_python(spark, formula):
    import math
    scope = {"ln": math.log, "log": math.log, "sqrt": math.sqrt, "exp": math.exp, "min": min, "max": max,
             "abs": abs, "round": round}
    data = [(50.0, 170.0), (81.5, 1.0), (3.25, 200.0)]
    df = spark.createDataFrame(data, "weight double, height double")
    got = one(spark, df, formula_column(formula, F.col))
    assert got == pytest.approx([eval(formula, scope, {"weight": w, "height": h}) for w, h in data])


def test_formula_failures_and_limits(spark):
    df = spark.createDataFrame([(0.0, -8.0)], "a double, b double")
    assert one(spark, df, formula_column("1 / a", F.col)) == [None]
    assert one(spark, df, formula_column("b ** 0.5", F.col)) == [None]
    assert one(spark, df, formula_column("ln(a)", F.col)) == [float("-inf")]
    assert formula_variables("ln(max(x, 1)) + y") == ["x", "y"]
    for wrong in ("__import__('os')", "a.b", "open(a)", "a if b else 1", "[a]", "a < b", "'x' * 3"):
        with pytest.raises(ValueError):
            formula_variables(wrong)


@pytest.fixture(scope="module")
def hot_groups(spark):
    """A third of all rows in one group, gaps in the values, blocks of ten rows."""
    random.seed(7)
    data = [("hot" if i % 3 == 0 else f"g{random.randint(0, 40)}", i, None if random.random() < .6 else str(i),
             random.randint(0, 9)) for i in range(3000)]
    return spark.createDataFrame(data, "k string, row_ord bigint, v string, n int").repartition(7)


def test_blocked_running_count_equals_window(hot_groups, rows):
    got = ordered.running_count(hot_groups, ["k"], ["row_ord"], ordered.block_of(F.col("row_ord"), 10), "i")
    want = hot_groups.withColumn("i", F.row_number().over(W.partitionBy("k").orderBy("row_ord")))
    assert rows(got, "k", "row_ord", "i") == rows(want, "k", "row_ord", "i")


def test_blocked_fill_equals_window(hot_groups, rows):
    got = ordered.fill_forward(hot_groups, "k", ["v"], ["row_ord"], ordered.block_of(F.col("row_ord"), 10))
    want = hot_groups.withColumn("v", F.last("v", True).over(W.partitionBy("k").orderBy("row_ord")))
    assert rows(got, "k", "row_ord", "v") == rows(want, "k", "row_ord", "v")


def test_blocked_decreases_equal_window(hot_groups, rows):
    got = ordered.count_decreases(hot_groups, ["k"], "n", ["row_ord"], [ordered.block_of(F.col("row_ord"), 10)])
    want = hot_groups.withColumn("d", (F.col("n") < F.lag("n").over(W.partitionBy("k").orderBy("row_ord"))).cast("int")
                                 ).groupBy("k").agg(F.sum("d").alias("n_decreases"))
    assert rows(got, "k", "n_decreases") == rows(want, "k", "n_decreases")


def test_repeat_rows_in_chunks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 25)], "k string, n bigint")
    assert rows(ordered.repeat_rows(df, "n", "i", chunk=10)) == sorted(
        [("a", 1)] + [("b", i) for i in range(1, 26)], key=str)
