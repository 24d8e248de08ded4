"""Monotone curves in bounded parts."""

import numpy as np

from rowloom.operators import calibrate


def test_merged_falls_leave_the_curve_as_it_is():
    r = np.random.default_rng(1)
    for n in (1, 2, 5, 1000):
        p, y, w = np.sort(r.random(n)), r.integers(0, 2, n).astype(float), r.integers(1, 4, n).astype(float)
        want = calibrate.pool_adjacent_violators(p, p, y, w)
        got = calibrate.pool_adjacent_violators(*calibrate._merged_falls(p, p, y, w))
        assert got[0] == want[0] and got[1] == want[1] and got[3] == want[3]
        assert np.allclose(got[2], want[2], atol=1e-12)


def test_a_task_holds_a_bounded_part_of_a_slice(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = [(f"m{i % 2}", c, float(r.random()), int(r.integers(0, 2))) for i in range(3000) for c in (0, 1)]
    held = spark.createDataFrame(rows, "model string, class int, p double, y int")
    whole = calibrate.fit_isotonic(held).orderBy("model", "class", "no").collect()
    held_at_once = spark.sparkContext.accumulator(0)
    pool = calibrate._pool

    def counted(part):
        held_at_once.add(int(len(part) > 500))
        return pool(part)

    monkeypatch.setattr(calibrate, "SLICE_ROWS", 500)
    monkeypatch.setattr(calibrate, "_pool", counted)
    got = calibrate.fit_isotonic(held).orderBy("model", "class", "no").collect()
    assert held_at_once.value == 0
    assert [(g["model"], g["class"], g["no"], g["low"], g["high"]) for g in got] == [(w["model"], w["class"], w["no"], w["low"], w["high"]) for w in whole]
    assert np.allclose([g["fitted"] for g in got], [w["fitted"] for w in whole])


def test_ends_and_quantiles_of_odd_numbers(spark):
    """Counted in batches: gaps, infinities, whole numbers beyond doubles, decimals, columns of one value."""
    import math
    from decimal import Decimal

    from rowloom.operators.quantiles import exact_quantiles

    big = 2**62
    rows = [(None if i % 7 == 0 else float(i), -big + i if i % 2 else big - i, Decimal(i), 1.5, float("inf") if i % 3 == 0 else -float(i), None) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b long, c decimal(20, 2), d double, e double, f float").repartition(5)
    for limit in (10, 1_000_000):
        got = exact_quantiles(df, list("abcdef"), 0.5, one_task_rows=limit)
        a = sorted(r[0] for r in rows if r[0] is not None)
        e = sorted(r[4] for r in rows)
        assert got["a"] == a[(len(a) - 1) // 2] or math.isclose(got["a"], (a[len(a) // 2 - 1] + a[len(a) // 2]) / 2)
        b = sorted(r[1] for r in rows)
        assert math.isclose(got["b"], (float(b[499]) + float(b[500])) / 2, rel_tol=1e-12, abs_tol=1e4)
        assert got["c"] == 499.5 and got["d"] == 1.5 and got["f"] is None
        assert got["e"] == (e[499] + e[500]) / 2


def test_cells_make_no_row_per_column(spark):
    """A pass over many columns sends rows of cells, never a row for each value of each column."""
    from rowloom.operators import quantiles

    df = spark.range(0, 2000, 1, 2).selectExpr(*[f"cast(id as double) * {i + 1} as c{i}" for i in range(40)])
    plan = df.mapInArrow(quantiles._cell_counts([(i, 0.0, 1999.0 * (i + 1)) for i in range(40)], 32), "j int, cell int, n bigint, low_whole bigint, high_whole bigint, low_real double, high_real double")
    assert "Generate" not in plan._jdf.queryExecution().toString()
    assert plan.count() <= 2 * 40 * 32


def test_standard_state_of_constant_empty_and_far_columns(spark):
    from rowloom.operators.scale import fit_standard

    rows = [(0.1, None, 1e9 + i % 2, i, None if i % 3 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int, e double").repartition(7)
    got = fit_standard(df, list("abcde")).first().asDict()
    assert got["a__mean"] == 0.1 and got["a__sd"] == 1.0
    assert got["b__mean"] is None and got["b__sd"] == 1.0
    assert got["c__mean"] == 1e9 + 0.5 and abs(got["c__sd"] - 0.5) < 1e-9
    for c, x in (("d", np.arange(3000.0)), ("e", np.arange(0, 3000.0, 3))):
        assert np.isclose(got[f"{c}__mean"], x.mean(), rtol=1e-12) and np.isclose(got[f"{c}__sd"], x.std(), rtol=1e-12)


def test_small_methods_are_asked_for_and_given_back(spark):
    from rowloom.session import small_methods

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    with small_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name, None) == before


def test_permuted_copies_join_each_order_once(spark, monkeypatch):
    """Against plain Python; all repeats come from one chain of joins, and no copy carries another row's whole vector."""
    from hashlib import md5

    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    from rowloom.operators import models, select

    r = np.random.default_rng(3)
    x = r.random((200, 3))
    y = (x[:, 0] > x[:, 2]).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(200)], "id long, y int, x array<double>")
    df = df.select("id", "y", array_to_vector("x").alias("features"))
    seen = []

    def add(t):
        seen.append(t)
        v = vector_to_array("features")
        return t.withColumn("probs", F.array((F.get(v, F.lit(0)) <= F.get(v, F.lit(2))).cast("double"), (F.get(v, F.lit(0)) > F.get(v, F.lit(2))).cast("double")))

    unions = []
    union = DataFrame.unionByName
    monkeypatch.setattr(type(df), "unionByName", lambda a, *b, **c: unions.append(1) or union(a, *b, **c))
    got = {g["slot"]: g for g in select.permutation_importance(models.Fitted(2, add), df, "id", ["a", "b", "c"], repeats=3).collect()}
    order = [sorted(range(200), key=lambda i: (md5(f"{s}:{i}".encode()).hexdigest(), i)) for s in ("42", "42/0", "42/1", "42/2")]
    for slot in range(3):
        lost = []
        for o in order[1:]:
            z = x[order[0]].copy()
            z[:, slot] = x[o, slot]
            lost.append(1 - np.mean((z[:, 0] > z[:, 2]) == y[order[0]]))
        assert np.isclose(got[slot]["importance_mean"], np.mean(lost)) and np.isclose(got[slot]["importance_std"], np.std(lost))
    assert not unions and "z" not in seen[-1].columns


def test_shares_are_the_same_without_lambdas(spark):
    from pyspark.sql import functions as F

    from rowloom.operators import models

    rows = [(i, [0.0, 0.0, 0.0] if i % 4 == 0 else [float(i), 0.3 * i, 1e-300], 7) for i in range(40)] + [(99, [float("nan"), 1.0, 2.0], 7)]
    df = spark.createDataFrame(rows, "id int, x array<double>, `a.b` int")
    got = models.with_shares(df, F.transform("x", lambda v: v * 2), 3)
    want = df.withColumn("probs", models.normalised(F.transform("x", lambda v: v * 2), 3))
    assert got.columns == want.columns
    assert str(sorted(got.collect(), key=lambda r: r["id"])) == str(sorted(want.collect(), key=lambda r: r["id"]))
    plan = models.with_shares(df, F.col("x"), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_packed_vectors_are_single_only_where_that_is_exact():
    from rowloom.operators.neighbours import _matrix, _raw

    r = np.random.default_rng(4)
    for m, size in (
        (r.random((5, 3)).astype(np.float32).astype(np.float64), 4), (r.random((5, 3)), 8), (np.array([[1.0, np.nan]]), 8), (np.array([[1e300, -0.0]]), 8),
        (np.array([[np.inf, -0.0]]), 4),
    ):
        raw = _raw(m)
        assert len(raw) == size * m.size
        assert _matrix(raw, *m.shape).tobytes() == m.tobytes()
