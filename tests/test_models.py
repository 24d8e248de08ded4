"""Models, calibration, ensembles, selection and reduction by their defining properties."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rowloom.operators import calibrate, ensemble, models, reduce, select, splits
from rowloom.operators.preparation import FeaturePreparation

NAMES = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture(scope="module")
def table(spark):
    """Three classes that depend on the first two of six features."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 6))
    y = (x[:, 0] + 0.2 * rng.normal(size=300) > 0.4).astype(int) + (x[:, 1] + 0.2 * rng.normal(size=300) > 0.3).astype(int)
    rows = [(i, int(y[i]), x[i].tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, x array<double>").repartition(3)
    out = df.select("id", "y", array_to_vector("x").alias("features")).persist()
    out.count()
    return out


FITS = {
    "random_forest": models.random_forest(trees=10, depth=5),
    "entropy": models.random_forest(trees=5, impurity="entropy", min_leaf=3, subset="log2"),
    "logistic": models.logistic(),
    "l1": models.logistic(c=0.5, l1_ratio=1.0),
    "gradient_boosting": models.gradient_boosting(rounds=4),
    "adaboost": models.adaboost(rounds=6, cut_every=3),
    "mlp": models.mlp(iterations=60),
    "linear_svc": models.linear_svc(iterations=20),
}


@pytest.mark.parametrize("name", list(FITS))
def test_probabilities_sum_to_one_and_beat_the_majority(spark, table, name):
    scored = FITS[name](table, 3).score(table)
    assert scored.columns == [*table.columns, "probs", "prediction"]
    rows = scored.collect()
    probs = np.array([r["probs"] for r in rows])
    np.testing.assert_allclose(probs.sum(axis=1), 1.0, atol=1e-9)
    assert (probs >= 0).all() and probs.argmax(axis=1).tolist() == [r["prediction"] for r in rows]
    y = np.array([r["y"] for r in rows])
    assert (probs.argmax(axis=1) == y).mean() > np.bincount(y).max() / len(y) + 0.1


def test_logistic_gradient_is_zero(spark, table):
    """At the optimum the penalised gradient vanishes, also with class weights."""
    weighted = splits.apply_class_weight(table, splits.balanced_class_weight(table, "y"), "y")
    fitted = models.logistic(c=2.0, iterations=500)(weighted, 3)
    rows = fitted.score(weighted).collect()
    x = np.array([r["features"].toArray() for r in rows])
    w = np.array([r["weight"] for r in rows])
    error = np.array([r["probs"] for r in rows]) - np.eye(3)[[r["y"] for r in rows]]
    gradient = (w[:, None] * error).T @ x / w.sum()
    # The penalty acts on standardised slots.
    mean = (w[:, None] * x).sum(0) / w.sum()
    sd = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / w.sum())
    penalty = fitted.parts[0].coefficientMatrix.toArray() * sd**2 / (2.0 * len(rows))
    assert np.abs(gradient + penalty).max() < 2e-3


def test_importances_find_the_two_features(spark, table):
    for name in ("random_forest", "gradient_boosting", "logistic", "linear_svc"):
        ranked = select.importance_table(FITS[name](table, 3), NAMES, table).collect()
        assert {r["feature"] for r in ranked[:2]} == {"a", "b"}, name


def test_permutation_importance(spark, table):
    fitted = FITS["random_forest"](table, 3)
    got = select.permutation_importance(fitted, table, "id", NAMES, repeats=3).collect()
    assert {r["feature"] for r in got[:2]} == {"a", "b"}
    assert len(got) == 6 and all(r["importance_std"] >= 0 for r in got)
    assert got[-1]["importance_mean"] < 0.05 < got[1]["importance_mean"]


def test_selection_thresholds(spark):
    rows = [(0, "a", 0.5), (1, "b", 0.3), (2, "c", 0.15), (3, "d", 0.05)]
    scores = spark.createDataFrame(rows, "slot int, feature string, importance double")
    names = lambda df: sorted(r["feature"] for r in df.collect())
    assert names(select.select_by_importance(scores, "mean")) == ["a", "b"]
    assert names(select.select_by_importance(scores, "median")) == ["a", "b"]
    assert names(select.select_by_importance(scores, 0.1)) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        select.select_by_importance(scores, 0.9)
    assert names(select.select_topn(scores, 3)) == ["a", "b", "c"]
    assert select.missing_features(scores, ["a", "c"]) == ["b", "d"]


def test_rfe_keeps_the_floor(spark, table):
    folded = splits.stratified_kfold(table, "id", "y", 2)
    rows = select.rfe_cv(folded, models.logistic(iterations=20), 3, "id", NAMES, folds=2, floor=2, step=0.3).collect()
    sizes = [r["n_features"] for r in rows]
    assert sizes[0] == 6 and min(sizes) == 2 and sum(r["best"] for r in rows) == 1
    smallest = min(rows, key=lambda r: r["n_features"])
    assert set(smallest["features"]) == {"a", "b"}


def test_out_of_fold_rows_and_test_means(spark, table):
    folded = splits.stratified_kfold(table.where("id < 240"), "id", "y", 3)
    test = table.where("id >= 240")
    held, tested = models.oof_predict(folded, models.logistic(), 3, "id", "m", test, 3)
    assert held.count() == 240 * 3 and held.select("id").distinct().count() == 240
    sums = tested.groupBy("id").agg(F.sum("p").alias("s"), F.count("*").alias("n")).collect()
    assert len(sums) == 60 and all(abs(r["s"] - 1) < 1e-9 and r["n"] == 3 for r in sums)
    assert models.cv_score(models.fold_accuracy(held, "id", 3)).first()["cv_mean"] > 0.6


def test_param_search_skips_stored_and_stops(spark, table):
    folded = splits.stratified_kfold(table, "id", "y", 2)
    stored = spark.createDataFrame([("c=1.0", 2.0)], "params string, score double")
    fitted = []

    def make(c):
        fitted.append(c)
        return models.logistic(c=c, iterations=10)

    grid = [{"c": 1.0}, {"c": 0.1}, {"c": 10.0}, {"c": 100.0}]
    rows = models.param_search(folded, make, grid, 3, "id", stored, patience=2, folds=2).collect()
    assert fitted == [0.1, 10.0] and len(rows) == 3
    assert [r["params"] for r in rows if r["best"]] == ["c=1.0"]


def test_stacking_uses_probabilities_only(spark, table):
    folded = splits.stratified_kfold(table, "id", "y", 2)
    parts = [models.oof_predict(folded, FITS[n], 3, "id", n, folds=2)[0] for n in ("logistic", "random_forest")]
    held = parts[0].unionByName(parts[1])
    meta = ensemble.fit_stacking(held, "id", ["logistic", "random_forest"], 3, models.logistic())
    level = ensemble.level_one(held, "id", ["logistic", "random_forest"], 3, ["y"])
    rows = meta.score(level).collect()
    assert len(rows[0]["features"]) == 6
    assert np.mean([r["prediction"] == r["y"] for r in rows]) > 0.6


def long_rows(spark, probs, y, model="m"):
    rows = [(i, int(y[i]), model, c, float(probs[i, c])) for i in range(len(y)) for c in range(probs.shape[1])]
    return spark.createDataFrame(rows, "id long, y int, model string, class int, p double").repartition(3)


def pav(x, y):
    """Brute force: greatest over starts of the least mean over ends."""
    order = np.argsort(x, kind="stable")
    xs = np.unique(x)
    w = np.array([(x == v).sum() for v in xs])
    m = np.array([y[x == v].mean() for v in xs])
    fit = [max(min(np.average(m[j:k + 1], weights=w[j:k + 1]) for k in range(i, len(xs))) for j in range(i + 1)) for i in range(len(xs))]
    assert len(order) == len(x)
    return dict(zip(xs, fit))


def test_isotonic_calibration_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    raw = rng.integers(1, 12, size=(210, 3)).astype(float)
    y = np.array([rng.choice(3, p=r / r.sum()) for r in raw])
    probs = raw / 40
    held = long_rows(spark, probs, y)
    got = {(r["id"], r["class"]): r["p"] for r in calibrate.isotonic_calibration(held, held, "id", 3).collect()}
    curves = [pav(probs[:, c], (y == c).astype(float)) for c in range(3)]
    for i in range(210):
        moved = np.array([curves[c][probs[i, c]] for c in range(3)])
        want = moved / moved.sum() if moved.sum() > 0 else np.full(3, 1 / 3)
        np.testing.assert_allclose([got[(i, c)] for c in range(3)], want, atol=1e-9)


def test_sigmoid_calibration_is_monotone_and_sums_to_one(spark):
    rng = np.random.default_rng(13)
    raw = rng.random((300, 2)) + 0.01
    probs = raw / raw.sum(axis=1, keepdims=True)
    y = (rng.random(300) < probs[:, 1] ** 2).astype(int)
    held = long_rows(spark, probs, y)
    rows = calibrate.sigmoid_calibration(held, held, "id", 2).collect()
    got = np.zeros((300, 2))
    for r in rows:
        got[r["id"], r["class"]] = r["p"]
    np.testing.assert_allclose(got.sum(axis=1), 1.0)
    order = np.argsort(probs[:, 1])
    assert (np.diff(got[order, 1]) >= -1e-9).all()


def test_calibration_needs_enough_rows(spark):
    probs = np.full((50, 2), 0.5)
    probs[:, 0] = 0.3
    held = long_rows(spark, probs, np.zeros(50, dtype=int))
    for calibration in (calibrate.isotonic_calibration, calibrate.sigmoid_calibration):
        assert {r["p"] for r in calibration(held, held, "id", 2).collect()} == {0.3, 0.5}


def test_votes(spark):
    rows = [(1, "a", 0, 0.6), (1, "a", 1, 0.4), (1, "b", 0, 0.1), (1, "b", 1, 0.9), (1, "c", 0, 0.55), (1, "c", 1, 0.45)]
    long = spark.createDataFrame(rows, "id long, model string, class int, p double")
    assert ensemble.hard_vote(long, "id", 2).first()["prediction"] == 0
    plain = {r["class"]: r["p"] for r in ensemble.soft_vote(long, "id").collect()}
    assert plain[1] == pytest.approx((0.4 + 0.9 + 0.45) / 3)
    board = spark.createDataFrame([("a", 0.8), ("b", 0.7), ("c", 0.7)], "model string, cv_score double")
    weights = {r["model"]: r["weight"] for r in ensemble.vote_weights(board).collect()}
    assert sum(weights.values()) == pytest.approx(1) and weights["a"] > 0.99
    heavy = {r["class"]: r["p"] for r in ensemble.soft_vote(long, "id", ensemble.vote_weights(board)).collect()}
    assert heavy[0] == pytest.approx(0.6, abs=1e-4)


def test_per_class_vote_without_mass(spark):
    rows = [(1, "a", 0, 0.0), (1, "b", 1, 0.0), (2, "a", 0, 0.2), (2, "b", 1, 0.6)]
    long = spark.createDataFrame(rows, "id long, model string, class int, p double")
    chosen = spark.createDataFrame([("a", 0), ("b", 1)], "model string, class int")
    got = {(r["id"], r["class"]): r["p"] for r in ensemble.per_class_vote(long, chosen, "id").collect()}
    assert got[(1, 0)] == got[(1, 1)] == 0.5 and got[(2, 1)] == pytest.approx(0.75)


def test_qualification_falls_back_to_the_best(spark):
    board = spark.createDataFrame([("a", 0.5, 0.6), ("b", 0.7, 0.4)], "model string, cv_score double, holdout_acc double")
    assert [r["model"] for r in ensemble.qualify_models(board, 0.72).collect()] == ["b"]
    passed = {r["model"]: r["is_best"] for r in ensemble.qualify_models(board, 0.4).collect()}
    assert passed == {"a": True, "b": False}
    assert [(r["model"], r["rank"]) for r in ensemble.leaderboard(board).collect()] == [("a", 1), ("b", 2)]


@pytest.fixture(scope="module")
def block(spark):
    rng = np.random.default_rng(14)
    data = rng.normal(size=(200, 8)) @ rng.normal(size=(8, 8)) + 3
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "id long, v array<double>").repartition(3)
    return data, df


def test_pca_matches_the_covariance(spark, block):
    data, df = block
    state = reduce.fit_pca(df, "v", 4)
    rows = state.orderBy("component").collect()
    values, sides = np.linalg.eigh(np.cov(data.T))
    order = np.argsort(values)[::-1][:4]
    np.testing.assert_allclose([r["share"] for r in rows], values[order] / values.sum())
    loadings = np.array([r["loadings"] for r in rows])
    np.testing.assert_allclose(loadings @ loadings.T, np.eye(4), atol=1e-9)
    np.testing.assert_allclose(np.abs(loadings @ sides[:, order]), np.eye(4), atol=1e-6)
    scores = np.array([r[0] for r in df.select(reduce.project(state, "v")).collect()])
    np.testing.assert_allclose(scores.mean(axis=0), 0, atol=1e-9)
    assert all(max(row, key=abs) > 0 for row in loadings)


def test_svd_matches_numpy(spark, block):
    data, df = block
    state = reduce.fit_svd(df, "v", 3)
    loadings = np.array([r["loadings"] for r in state.orderBy("component").collect()])
    right = np.linalg.svd(data)[2][:3]
    np.testing.assert_allclose(np.abs(loadings @ right.T), np.eye(3), atol=1e-6)
    got = {r["id"]: r["s"] for r in df.select("id", reduce.project(state, "v").alias("s")).collect()}
    np.testing.assert_allclose(got[5], loadings @ data[5], atol=1e-9)


def test_kmeans_assigns_the_nearest_centre(spark, block):
    data, df = block
    model = reduce.fit_kmeans(df, "v", 5)
    centres = np.array(model.clusterCenters())
    for r in reduce.apply_kmeans(model, df, "v").collect():
        dist = ((centres - data[r["id"]]) ** 2).sum(axis=1)
        assert dist[r["cluster"]] == pytest.approx(dist.min())


def test_states_do_not_see_test_rows(spark):
    """The fitted state comes from train alone; new values in test fall into no flag."""
    train = spark.createDataFrame([(1, 1.0, "a", True), (2, 3.0, "b", None), (3, None, None, False)], "id int, x double, c string, f boolean")
    test = spark.createDataFrame([(4, 1000.0, "zzz", True), (5, None, None, None)], "id int, x double, c string, f boolean")
    fitted = FeaturePreparation(["x"], ["c"], ["f"]).fit(train)
    assert fitted.names == ["x", "c_Unknown", "c_a", "c_b", "f"]
    assert fitted.medians.first()["x"] == 2.0 and fitted.scales.first()["x__mean"] == 2.0
    rows = {r["id"]: r for r in fitted.transform(test).collect()}
    assert (rows[4]["c_hot"].toArray().tolist(), rows[4]["f"]) == ([0, 0, 0], 1)
    assert (rows[5]["x"], rows[5]["c_hot"].toArray().tolist(), rows[5]["f"]) == (0.0, [1, 0, 0], 0)
