"""Closed-form checks of column functions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions import blocks, cleaning, dates, numeric, text
from rowloom.functions.ordinal import ORDINAL_MAPS, ordinal_map
from rowloom.operators import scale


def column(spark, values, dtype, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_bool_to_int_text(spark):
    values = ["true", "FALSE", "Yes", "no", "1", "0", "1.0", "Y", " true", None]
    got = column(spark, values, "string", cleaning.bool_to_int(F.col("x"), T.StringType()))
    assert got == [1, 0, 1, 0, 1, 0, 0, 0, 0, 0]


def test_bool_to_int_number_and_bool(spark):
    assert column(spark, [0.0, 2.0, -1.0, None], "double", cleaning.bool_to_int(F.col("x"), T.DoubleType())) == [0, 1, 1, 1]
    assert column(spark, [True, False, None], "boolean", cleaning.bool_to_int(F.col("x"), T.BooleanType())) == [1, 0, 0]


def test_cleaning_of_nan_inf_null(spark):
    values = [1.5, float("nan"), float("inf"), float("-inf"), None]
    assert column(spark, values, "double", cleaning.nonfinite_to(F.col("x"))) == [1.5, 0.0, 0.0, 0.0, 0.0]
    assert column(spark, values, "double", cleaning.nonfinite_to_null(F.col("x"))) == [1.5, None, None, None, None]


def test_to_number(spark):
    got = column(spark, ["1.5", " 2 ", "", "abc", "NaN", None, "1e3"], "string", cleaning.to_number(F.col("x")))
    assert got == [1.5, 2.0, None, None, None, None, 1000.0]


def test_null_tokens(spark):
    got = column(spark, ["", " ", "NA", "None", "NULL", "na", None], "string", cleaning.null_tokens(F.col("x")))
    assert got == [None, None, None, None, None, "na", None]


@pytest.mark.parametrize(
    "value, lenient, strict",
    [
        ("2021/07", (2021, 7), (2021, 7)),
        ("2021", (2021, 1), (2020, 1)),
        ("2021/13", (2021, 13), (2020, 1)),
        ("/05", (1900, 5), (2020, 1)),
        ("abc", (1900, 1), (2020, 1)),
        ("2021/x", (2021, 1), (2020, 1)),
        (None, (1900, 1), (2020, 1)),
    ],
)
def test_year_month(spark, value, lenient, strict):
    df = spark.createDataFrame([(value,)], "x string")
    assert tuple(df.select(*dates.lenient_year_month(F.col("x"))).first()) == lenient
    assert tuple(df.select(*dates.strict_year_month(F.col("x"))).first()) == strict


def test_clip_and_quarter(spark):
    months = [-3, 0, 1, 3, 4, 9, 12, 13]
    assert column(spark, months, "int", dates.clip_month(F.col("x"))) == [1, 1, 1, 3, 4, 9, 12, 12]
    assert column(spark, [1, 3, 4, 6, 7, 12], "int", dates.quarter_of(F.col("x"))) == [1, 1, 2, 2, 3, 4]


def test_flags_match_inside_words(spark):
    words = text.TITLE_KEYWORDS["package"]
    df = spark.createDataFrame([("SRE",), (None,), ("Data Scientist",)], "x string")
    rows = df.select(*text.keyword_flags(F.col("x"), words)).collect()
    assert rows[0]["is_senior"] == 1
    assert sum(rows[1]) == 0
    assert rows[2]["is_data_scientist"] == 1 and rows[2]["is_engineer"] == 0


def test_patterns_that_are_no_plain_words(spark):
    df = spark.createDataFrame([("a1c",), ("abc",)], "x string")
    assert [r[0] for r in df.select(text.has_any(F.col("x"), r"a\dc|zz")).collect()] == [True, False]


def test_regions_cover_all_codes():
    codes = [c for group in text.US_REGIONS.values() for c in group]
    assert [len(g) for g in text.US_REGIONS.values()] == [9, 12, 17, 13]
    assert len(set(codes)) == 51


def test_ordinal_map(spark):
    got = column(spark, ["Junior", "Guru", None], "string", ordinal_map(F.col("x"), ORDINAL_MAPS["level"]))
    assert got == [2, None, None]


def test_block_statistics_match_pandas(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(20, 7))
    data[0] = 0.0
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "i int, v array<double>")
    stats = df.select("i", *blocks.row_stats(F.col("v"), "b"), *blocks.row_quantiles(F.col("v"), "b"), *blocks.row_nonzero(F.col("v"), "b"))
    got = stats.orderBy("i").toPandas()
    want = pd.DataFrame(data)
    np.testing.assert_allclose(got["b_mean"], want.mean(axis=1))
    np.testing.assert_allclose(got["b_std"], want.std(axis=1))
    np.testing.assert_allclose(got["b_median"], want.median(axis=1))
    np.testing.assert_allclose(got["b_q25"], want.quantile(0.25, axis=1))
    np.testing.assert_allclose(got["b_iqr"], want.quantile(0.75, axis=1) - want.quantile(0.25, axis=1))
    assert got["b_non_zero_count"].tolist() == (want != 0).sum(axis=1).tolist()


def test_filled_block(spark):
    df = spark.createDataFrame([([1.0, None, float("nan")],)], "v array<double>")
    assert df.select(blocks.filled_block(F.col("v"))).first()[0] == [1.0, 0.0, 0.0]


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 23, 100, 399])
def test_quantile_bin_equals_qcut(spark, n):
    df = spark.range(1, n + 1).select(numeric.quantile_bin_of_rank(F.col("id"), n).alias("b"), "id").orderBy("id")
    got = [r["b"] for r in df.collect()]
    if n >= 6:
        assert got == pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False).tolist()
    assert min(got) == 0 and max(got) <= 4


def test_equal_width_bin_equals_cut(spark):
    values = [0.0, 1.0, 2.0, 2.5, 7.3, 9.99, 10.0]
    got = column(spark, values, "double", numeric.equal_width_bin(F.col("x"), 0.0, 10.0))
    assert got == pd.cut(pd.Series(values), 5, labels=False, include_lowest=True).tolist()
    assert column(spark, [3.0, 3.0], "double", numeric.equal_width_bin(F.col("x"), 3.0, 3.0)) == [0, 0]


@pytest.mark.parametrize("lam", [-1.0, 0.0, 0.7, 1.0, 2.0, 3.5])
def test_yeo_johnson(spark, lam):
    values = [-3.0, -0.5, 0.0, 0.5, 4.0]

    def closed(x):
        if x >= 0:
            return math.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam
        return -math.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam)

    got = column(spark, values, "double", numeric.yeo_johnson(F.col("x"), lam))
    np.testing.assert_allclose(got, [closed(x) for x in values])


def test_yeo_johnson_lambda_is_the_likelihood_maximum(spark):
    rng = np.random.default_rng(3)
    x = rng.lognormal(size=400)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = scale.fit_yeo_johnson(df, "x").first()["lam"]

    def likelihood(l):
        moved = np.log1p(x) if abs(l) < 1e-12 else ((x + 1) ** l - 1) / l
        return -len(x) / 2 * np.log(moved.var()) + (l - 1) * np.log1p(x).sum()

    grid = np.arange(-3, 3, 0.001)
    assert abs(lam - grid[np.argmax([likelihood(g) for g in grid])]) < 2e-3
    moved = scale.apply_yeo_johnson(df, scale.fit_yeo_johnson(df, "x"), "x", "z").toPandas()["z"]
    assert abs(moved.mean()) < 1e-9 and abs(moved.std(ddof=0) - 1) < 1e-9
