"""Neighbours in rounds, category dictionaries, large states on streams, monotone curves, resampling inside folds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.operators import calibrate, encode, ensemble, models, neighbours, resample, sizing
from rowloom.operators.preparation import FeaturePreparation
from rowloom.plans import fixtures as fx


def test_rounds_rule_out_cells_and_carry_their_bound(spark):
    """On evenly spread directions only little can be ruled out; on clusters most of it."""
    flat = fx.vectors(spark, "/root/testdata/sf0.01")
    state = neighbours.knn_rounds(flat, flat, 5, pivots=60).agg(F.sum("needed").alias("needed"), F.sum("pairs").alias("pairs")).first()
    assert 0 < state["needed"] < state["pairs"]
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 6)) * 30
    rows = [(i, i % 3, (centres[i % 20] + rng.normal(size=6)).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>")
    state = neighbours.knn_rounds(df, df, 5, pivots=40).agg(F.sum("needed").alias("needed"), F.sum("pairs").alias("pairs")).first()
    assert state["needed"] < 0.2 * state["pairs"]


@pytest.mark.parametrize("most", [1, 1024])
def test_chunks_that_visit_blocks_in_many_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(neighbours, "MOST_BLOCKS_A_ROUND", most)
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 40)
    rng = np.random.default_rng(4)
    data = rng.normal(size=(120, 3))
    df = spark.createDataFrame([(i, 0, x.tolist()) for i, x in enumerate(data)], "id long, label int, vec array<double>")
    got = {}
    for r in neighbours.knn_join(df, df, 3, pivots=4, block_rows=20).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    dist = np.sqrt(((data[:, None] - data) ** 2).sum(2))
    np.fill_diagonal(dist, np.inf)
    want = np.argsort(dist, axis=1)[:, :3]
    assert all([got[i][k] for k in (1, 2, 3)] == want[i].tolist() for i in range(120))


def test_more_labels_than_cells_may_be(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MOST_CELLS", 5)
    rows = [(i, i % 30, [float(i), float(i % 7)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>")
    got = neighbours.knn_join(df, df, 2, within=True).collect()
    assert len(got) == 600 and all(r["label"] == r["neighbour_label"] and r["id"] != r["neighbour"] for r in got)


def test_no_rows_have_no_neighbours(spark):
    empty = spark.createDataFrame([], "id long, label int, vec array<double>")
    one = spark.createDataFrame([(1, 0, [1.0])], "id long, label int, vec array<double>")
    assert neighbours.knn_join(one, empty, 2).collect() == [] and neighbours.knn_join(one, one, 2).collect() == []
    assert neighbours.knn_by_hashing(one, empty, 2, 3, 2).collect() == []


def test_a_million_categories_prepare_store_and_load(spark, tmp_path):
    df = spark.range(1_000_000).select((F.col("id") * 1.0).alias("x"), F.concat(F.lit("c"), F.col("id")).alias("c"), "id")
    fitted = FeaturePreparation(["x"], ["c"], []).fit(df)
    loaded = FeaturePreparation.read(spark, fitted.write(str(tmp_path / "p")))
    assert loaded.width == 1_000_001
    new = spark.createDataFrame([(0.0, "c17", 1), (0.0, "never seen", 2), (0.0, None, 3)], "x double, c string, id long")
    rows = {r["id"]: r["features"] for r in loaded.assemble(new).collect()}
    slot = loaded.name_table(spark).where("feature = 'c_c17'").first()["slot"]
    assert rows[1].size == 1_000_001 and rows[1][slot] == 1.0
    assert [i for i in rows[2].indices if i] == [] and [i for i in rows[3].indices if i] == []


def test_one_schema_at_any_number_of_categories(spark):
    schemas = []
    for k in (2, 500):
        df = spark.range(1000).select((F.col("id") * 1.0).alias("x"), (F.col("id") % k).cast("string").alias("c"))
        schemas.append(FeaturePreparation(["x"], ["c"], []).fit(df).transform(df).dtypes)
    assert schemas[0] == schemas[1]


def test_a_stream_joins_a_state_above_the_bounds(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select("id", (F.col("id") % 50).cast("string").alias("k"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    table = spark.range(40).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("w"))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    joined = sizing.lookup(stream, table, "k")
    query = (
        joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("id", "k", "w").collect()), key=repr)
    want = sorted(map(tuple, sizing.lookup(rows, table, "k").select("id", "k", "w").collect()), key=repr)
    assert got == want and len(got) == 300


def brute_isotonic(points):
    """Greatest over starts of the least mean over ends, at each score."""
    scores = sorted(points)
    out = []
    for i in range(len(scores)):
        best = -1.0
        for a in range(i + 1):
            least = min(
                sum(points[s][0] for s in scores[a:b + 1]) / sum(points[s][1] for s in scores[a:b + 1]) for b in range(i, len(scores))
            )
            best = max(best, least)
        out.append((scores[i], best))
    return out


def test_curves_of_many_slices_equal_brute_force(spark, monkeypatch):
    """Scores repeat and do not; null scores, classes of one score, and slices that are pooled two at a time."""
    monkeypatch.setattr(calibrate, "SLICES_AT_ONCE", 2)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        p = float(rng.choice([rng.random(), round(rng.random(), 1)]))
        rows.append((i, "m", 0, int(rng.random() > p), p))
        rows.append((i, "m", 1, int(rng.random() > 0.5), 0.5))
    rows.append((999, "m", 0, 0, None))
    held = spark.createDataFrame(rows, "id int, model string, class int, y int, p double")
    curves = calibrate.fit_isotonic(held)
    new = held.where("class = 0 AND p IS NOT NULL").unionByName(spark.createDataFrame(
        [(2000, "m", 0, 0, -1.0), (2001, "m", 0, 0, 2.0), (2002, "m", 0, 0, None)], "id int, model string, class int, y int, p double"
    ))
    got = {r["id"]: r["p"] for r in calibrate.apply_isotonic(curves, new, "id").collect()}
    points = {}
    for i, _, c, y, p in rows:
        if c == 0 and p is not None:
            hit, n = points.get(p, (0, 0))
            points[p] = (hit + (y == 0), n + 1)
    curve = dict(brute_isotonic(points))
    for i, _, c, _, p in rows:
        if c == 0 and p is not None:
            assert abs(got[i] - curve[p]) < 1e-9
    assert got[2000] == pytest.approx(min(curve.values())) and got[2001] == pytest.approx(max(curve.values())) and got[2002] is None


def test_union_dictionary_has_no_slot_for_missing_values(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    right = spark.createDataFrame([("b",), (None,)], "v string")
    codes, size = encode.one_hot_union_dictionary(left, right, "v")
    rows = {r["id"]: r["h"].toArray().tolist() for r in encode.apply_dictionary(left, codes, size, "v", "h", missing=None).collect()}
    assert rows == {1: [1.0, 0.0], 2: [0.0, 0.0]}


def test_no_held_out_row_has_a_synthetic_neighbour(spark):
    rows = [(i, int(i % 10 == 0), [float(i), float(i % 13)], i % 3) for i in range(90)]
    folded = spark.createDataFrame(rows, "id long, label int, vec array<double>, fold int")
    for f in range(3):
        made = resample.smote(folded.where(F.col("fold") != f).drop("fold")).collect()
        assert made and all(r["id"] % 3 != f and r["neighbour"] % 3 != f for r in made)
    counts = {}
    for r in resample.balanced_folds(folded, 3).collect():
        if not r["synthetic"]:
            assert int(r["id"]) % 3 != r["fold"]
        counts[r["fold"], r["label"]] = counts.get((r["fold"], r["label"]), 0) + 1
    assert all(counts[f, 0] == counts[f, 1] for f in range(3))


def test_models_see_balanced_parts_and_score_only_own_rows(spark):
    rows = [(i, int(i % 10 == 0), float(i % 10 == 0) + i / 1000, i % 3) for i in range(180)]
    df = spark.createDataFrame(rows, "id long, y int, x double, fold int")
    train = df.select("id", "y", "fold", models_vector(df))
    seen = []

    def fit(part, k):
        seen.append({r["y"]: r["count"] for r in part.groupBy("y").count().collect()})
        return models.Fitted(k, lambda t: t.withColumn("probs", F.array(F.lit(0.5), F.lit(0.5))))

    held, _ = models.oof_predict(train, fit, 2, "id", "even", folds=3, resample=resample.balanced_training("id"))
    assert all(c[0] == c[1] for c in seen) and held.select("id").distinct().count() == 180


def models_vector(df):
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.array("x")).alias("features")


def test_votes_of_rows_shuffle_nothing(spark):
    rows = fx.pseudo_arrays(spark, "/root/testdata/sf0.001")
    voted = [
        ensemble.vote_rows(rows, "id", {"ada": 0.2, "bob": 0.8}, 3), ensemble.hard_vote_rows(rows, "id", ["ada", "bob"], 3),
        ensemble.per_class_rows(rows, "id", {0: "ada", 1: "bob", 2: "ada"}, 3), ensemble.stack_rows(rows, "id", ["ada", "cyd"], ["y"]),
    ]
    assert all("Exchange" not in v._jdf.queryExecution().executedPlan().toString() for v in voted)
    assert len(voted[3].first()["features"]) == 6


def test_wide_blocks_find_the_exact_subspace(spark):
    from rowloom.operators import reduce

    rng = np.random.default_rng(0)
    data = rng.normal(size=(300, 5)) * [9, 7, 5, 3, 2] @ rng.normal(size=(5, 64)) + 0.01 * rng.normal(size=(300, 64)) + 4
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(data)], "id int, vec array<double>").repartition(3)
    for exact, centred in ((reduce.fit_pca(df, "vec", 5), True), (reduce.fit_svd(df, "vec", 5), False)):
        wide = reduce.fit_wide(df, "vec", 5, centred=centred)
        a, b = (np.array([r["loadings"] for r in t.orderBy("component").collect()]) for t in (exact, wide))
        assert np.allclose(np.abs((a * b).sum(axis=1)), 1, atol=1e-6)
        shares = [[r["share"] for r in t.orderBy("component").collect()] for t in (exact, wide)]
        assert np.allclose(*shares, atol=1e-6)


def test_twenty_thousand_slots(spark):
    from rowloom.operators import reduce

    strength = F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.sin(i * 0.01) * F.col("a") + F.cos(i * 0.05) * F.col("b"))
    rows = spark.range(40).select((F.sin("id") * 5).alias("a"), F.cos(F.col("id") * 3).alias("b")).select(strength.alias("vec"))
    state = reduce.fit_wide(rows, "vec", 2, oversample=4, passes=3).orderBy("component").collect()
    assert len(state) == 2 and len(state[0]["loadings"]) == 20_000 and sum(r["share"] for r in state) > 0.999


def test_boosting_learns_what_one_cut_cannot_and_is_stored(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector

    from rowloom.operators import boosting

    rng = np.random.default_rng(2)
    rows = [(i, int(a > 0.5) + int(b > 0.3), a, b) for i, (a, b) in enumerate(rng.random((600, 2)).tolist())]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double").withColumn("features", array_to_vector(F.array("a", "b")))
    fitted = boosting.boosting(rounds=15, depth=2, step=0.5)(df, 3)
    scored = fitted.score(df)
    assert scored.where("prediction = y").count() >= 570
    assert all(abs(sum(r["probs"]) - 1) < 1e-9 for r in scored.collect())
    loaded = models.load_fitted(spark, fitted.write(spark, str(tmp_path / "m")))
    before, after = ({r["id"]: list(r["probs"]) for r in m.score(df).collect()} for m in (fitted, loaded))
    assert before == after and loaded.importances == fitted.importances


def test_ranges_draw_within_bounds_and_searches_continue(spark, tmp_path):
    space = {"a": ("int", 2, 5), "b": ("float", -1.0, 1.0), "c": ("log", 0.01, 100.0), "d": ("choice", ["x", "y"])}
    drawn = [models.sampled(space, t) for t in range(200)]
    assert {s["a"] for s in drawn} == {2, 3, 4, 5} and {s["d"] for s in drawn} == {"x", "y"}
    assert all(-1 <= s["b"] < 1 and 0.01 <= s["c"] < 100 for s in drawn) and sum(s["c"] < 1 for s in drawn) > 70
    with pytest.raises(ValueError, match="no range"):
        models.sampled({"a": ("odd", 1)}, 0)
    df = spark.createDataFrame([(i, i % 2, i % 3) for i in range(60)], "id int, y int, fold int").withColumn("features", F.array(F.col("y").cast("double")))
    fits = []

    def make(a):
        def fit(part, k):
            fits.append(a)
            right = F.when(F.lit(a > 2), F.col("features")[0].cast("int")).otherwise(1 - F.col("features")[0].cast("int"))
            return models.Fitted(k, lambda t: t.withColumn("probs", F.array((right == 0).cast("double"), (right == 1).cast("double"))))
        return fit

    store = str(tmp_path / "trials")
    found = models.range_search(df, make, {"a": ("int", 1, 5)}, 6, 2, store).collect()
    assert any(r["stopped"] and len(r["accuracies"]) == 1 and r["score"] is None for r in found) and sum(r["best"] for r in found) == 1
    n = len(fits)
    assert models.range_search(df, make, {"a": ("int", 1, 5)}, 6, 2, store).collect() == found and len(fits) == n
    models.range_search(df, make, {"a": ("int", 1, 5)}, 8, 2, store)
    assert n < len(fits) <= n + 6
