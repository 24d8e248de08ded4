"""Values that must not get lost: unlisted classes, infinities, many categories, several models in one calibration."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.operators import calibrate, metrics, models, preparation, profile, quantiles, resample, scale, select, sizing


def test_unlisted_and_missing_classes_stay_in_the_report(spark):
    rows = [(0, 0), (1, 1), (0, -1), (1, -1), (2, -1), (None, 0)]
    df = spark.createDataFrame(rows, "y int, p int")
    cells = {(r["y"], r["p"]): r["n"] for r in metrics.confusion_matrix(df, [0, 1, 2]).collect()}
    assert sum(cells.values()) == 6 and cells[(None, 0)] == 1 and cells[(2, -1)] == 1 and cells[(2, 2)] == 0
    report = {r["label"]: r for r in metrics.classification_report(df, [0, 1, 2]).collect()}
    assert report["accuracy"]["precision"] == pytest.approx(2 / 6) and report["accuracy"]["support"] == 6
    assert report["none"]["support"] == 1
    assert metrics.accuracy(df).first()["accuracy"] == pytest.approx(2 / 6)
    wide = metrics.confusion_wide(df, [0, 1, 2])
    assert wide.columns == ["y", "p_-1", "p_0", "p_1", "p_2", "p_none"]


def test_roc_curve_starts_at_the_origin(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.4)], "y int, p double")
    points = sorted((r["fpr"], r["tpr"], -r["threshold"]) for r in metrics.roc_curve(df, "p", F.col("y") == 1).collect())
    assert points[0] == (0.0, 0.0, -math.inf) and points[-1][:2] == (1.0, 1.0)


def test_models_are_calibrated_apart(spark):
    rows = []
    for i in range(400):
        y = i % 2
        rows += [(i, "good", c, y, 1.0 if c == y else 0.0) for c in (0, 1)]
        rows += [(i, "poor", c, y, 0.9 if (i // 2) % 2 == c else 0.1) for c in (0, 1)]
    held = spark.createDataFrame(rows, "id long, model string, class int, y int, p double")
    for calibration in (calibrate.isotonic_calibration, calibrate.sigmoid_calibration):
        got = {(r["id"], r["model"], r["class"]): r["p"] for r in calibration(held, held, "id", 2).collect()}
        assert len(got) == len(rows)
        assert got[(0, "good", 0)] > 0.95 and got[(1, "good", 1)] > 0.95
        assert got[(0, "poor", 0)] == pytest.approx(0.5, abs=0.05)
    few = held.where((F.col("model") == "good") | (F.col("id") < 20))
    same = calibrate.isotonic_calibration(few, held, "id", 2).where("model = 'poor'")
    assert {round(r["p"], 6) for r in same.collect()} == {0.9, 0.1}
    gain = {(r["model"], r["class"]): r for r in calibrate.calibration_gain(
        held, calibrate.isotonic_calibration(held, held, "id", 2).join(held.select("id", "model", "class", "y"), ["id", "model", "class"]),
        F.col("y") == F.col("class")).collect()}
    assert gain[("poor", 0)]["brier_after"] < gain[("poor", 0)]["brier_before"]


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_quantiles_with_infinities(spark, limit):
    values = [float(v) for v in range(1001)] + [math.inf] * 200 + [-math.inf] * 100
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    at = (len(values) - 1) * 0.5
    want = sorted(values)[int(at)]
    assert quantiles.exact_quantiles(df, ["x"], 0.5, limit)["x"] == want
    assert quantiles.exact_quantiles(df, ["x"], 0.999, limit)["x"] == math.inf
    wide = spark.createDataFrame([(v,) for v in [-1.7e308, 1.7e308, *map(float, range(50))]], "x double")
    assert quantiles.exact_quantiles(wide, ["x"], 0.5, 5)["x"] == 24.5
    odd = spark.createDataFrame([(math.nan,)] * 30 + [(float(i),) for i in range(60)], "x double")
    assert quantiles.exact_quantiles(odd, ["x"], 0.5, limit)["x"] == 44.5


def test_bins_of_dates_do_not_depend_on_size(spark):
    df = spark.range(500).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 97).cast("int")).alias("d"))
    small = {r["id"]: r["bin"] for r in scale.quantile_bins(df, "d", "id", "bin").collect()}
    split = {r["id"]: r["bin"] for r in scale.quantile_bins(df, "d", "id", "bin", one_task_rows=20).collect()}
    assert small == split and len(set(small.values())) > 1


def test_preparation_of_very_many_categories(spark):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("x"), F.concat(F.lit("c"), F.col("id") % 300).alias("c"), (F.col("id") % 2 == 0).alias("b"), "id")
    prepared = preparation.FeaturePreparation(["x"], ["c"], ["b"]).fit(df)
    assert len(prepared.names) == 302
    new = df.limit(1).withColumn("c", F.lit("never seen")).unionByName(df.where("id = 7"))
    rows = {r["id"]: r["features"] for r in prepared.assemble(new).collect()}
    assert rows[7].size == 302 and rows[7].toArray()[prepared.names.index("c_c7")] == 1.0 and rows[7].toArray()[1:301].sum() == 1.0
    assert rows[0].toArray()[1:301].sum() == 0.0


def test_copies_of_a_rare_row_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(resample, "COPIES_A_ROW", 7)
    rows = [(i, "big", [float(i), 0.0]) for i in range(60)] + [(100, "small", [1.0, 5.0]), (101, "small", [2.0, 6.0])]
    df = spark.createDataFrame(rows, "id long, label string, vec array<double>")
    made = resample.smote(df, 1).collect()
    assert len(made) == 58 and len({(r["id"], r["copy"]) for r in made}) == 58


def test_importances_of_adaboost_and_models_without(spark):
    rng = np.random.default_rng(3)
    x = rng.random((300, 3))
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(i, Vectors.dense(v), int(v[1] > 0.5), i % 3) for i, v in enumerate(x)], ["id", "features", "y", "fold"])
    df = df.withColumn("y", F.col("y").cast("int"))
    fitted = models.adaboost(rounds=2, depth=1, rate=0.5)(df.drop("fold"), 2)
    assert int(np.argmax(fitted.importances)) == 1
    with pytest.raises(ValueError, match="no importances"):
        select.rfe_cv(df, models.mlp(), 2, "id", ["a", "b", "c"], folds=3, floor=1)


FITS = {
    "forest": models.random_forest(trees=3, depth=2), "logistic": models.logistic(iterations=5), "boosting": models.gradient_boosting(rounds=2),
    "margins": models.linear_svc(iterations=5), "adaboost": models.adaboost(rounds=2), "mlp": models.mlp(iterations=5),
}


@pytest.mark.parametrize("name", FITS)
def test_a_stored_model_scores_alike(spark, tmp_path, name):
    from pyspark.ml.linalg import Vectors

    x = np.random.default_rng(5).random((200, 4))
    rows = [(i, Vectors.dense(v), int(v[0] * 3)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "features", "y"]).withColumn("y", F.col("y").cast("int"))
    fitted = FITS[name](df, 3)
    loaded = models.load_fitted(spark, fitted.write(spark, str(tmp_path / "m")))
    before, after = ({r["id"]: (r["probs"], r["prediction"]) for r in m.score(df).collect()} for m in (fitted, loaded))
    assert before == after and loaded.importances == fitted.importances and loaded.k == 3
    with pytest.raises(ValueError, match="no parts"):
        models.Fitted(3, lambda t: t).write(spark, str(tmp_path / "rule"))


def test_a_stored_preparation_keeps_many_categories(spark, tmp_path):
    df = spark.range(900).select((F.col("id") * 1.0).alias("x"), F.concat(F.lit("c"), F.col("id") % 300).alias("c"), (F.col("id") % 2 == 0).alias("b"), "id")
    fitted = preparation.FeaturePreparation(["x"], ["c"], ["b"]).fit(df)
    loaded = preparation.FeaturePreparation.read(spark, fitted.write(str(tmp_path / "p")))
    assert loaded.names == fitted.names
    before, after = ({r["id"]: r["features"] for r in p.assemble(df).collect()} for p in (fitted, loaded))
    assert before == after


def test_distinct_counts_without_expansion(spark):
    rows = [(0.0, "a", None, [1, 2]), (-0.0, None, None, [1, 2]), (math.nan, "b", None, None), (math.nan, "a", None, [3])]
    df = spark.createDataFrame(rows, "x double, t string, n int, a array<int>")
    counted = profile.count_distinct(df, df.columns)
    got = {r["column_name"]: (r["n_distinct"], r["n_distinct_with_null"]) for r in counted.collect()}
    assert got == {"x": (2, 2), "t": (2, 3), "n": (0, 1), "a": (2, 3)}
    assert "Expand" not in counted._jdf.queryExecution().toString()
    assert {r["n_distinct"] for r in profile.count_distinct(df.limit(0), ["x", "t"]).collect()} == {0}


def test_scores_of_test_rows_need_no_shuffle(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(i, Vectors.dense([i / 90]), i % 2, i % 3) for i in range(90)], ["id", "features", "y", "fold"])
    df = df.withColumn("y", F.col("y").cast("int"))
    _, tested = models.oof_predict(df, models.logistic(iterations=3), 2, "id", "m", df.drop("fold", "y"), 3)
    plan = tested._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and tested.count() == 180


def test_states_do_not_follow_their_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0,), (3.0,)], "x double").write.parquet(path)
    fitted = scale.fit_standard(spark.read.parquet(path), ["x"])
    spark.createDataFrame([(100.0,)], "x double").write.mode("append").parquet(path)
    assert fitted.first()["x__mean"] == 2.0


def test_medians_of_many_columns_send_few_rows(spark, monkeypatch):
    """All columns share the cells of a pass, and what is left of all of them fits the one task."""
    columns = [f"c{i}" for i in range(60)]
    mixed = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_000)).alias(c) if i % 2 else (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_000)) / 7).alias(c) for i, c in enumerate(columns)]
    df = spark.range(3000).select(*mixed).persist()
    monkeypatch.setattr(quantiles, "_ALL_CELLS", 4096)
    seen = []
    whole = quantiles._cells
    monkeypatch.setattr(quantiles, "_cells", lambda d, parts: seen.append(whole(d, parts)) or seen[-1])
    got = quantiles.exact_quantiles(df, columns, 0.5, one_task_rows=6000)
    want = df.agg(*[F.expr(f"percentile({c}, 0.5)").alias(c) for c in columns]).first()
    assert all(abs(got[c] - want[c]) < 1e-9 for c in columns)
    assert seen and all(sum(len(cells) for cells in one.values()) <= 4096 for one in seen)


def test_more_hot_keys_than_a_broadcast_holds(spark, monkeypatch):
    rows = [(k, i) for k in range(40) for i in range(3 + k)]
    df, table = spark.createDataFrame(rows, "k long, i long"), spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 5)
    for how in ("left", "inner"):
        got = sizing.split_join(df, table, "k", how, hot_rows=4).select("k", "i", "v").collect()
        want = [(k, i, k * 10 if k % 2 == 0 else None) for k, i in rows if how == "left" or k % 2 == 0]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
