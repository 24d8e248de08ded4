"""Short passes in few tasks, curves and hash buckets in bounded memory, and what a run leaves on disk."""

import os

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rowloom.operators import calibrate, encode, models, neighbours, ranking
from rowloom.plans import lifecycle


def test_passes_of_margins_have_as_many_tasks_as_their_numbers_need(spark, monkeypatch):
    rows = [(Vectors.dense([i % 7 - 3.0, i % 5 - 2.0]), int(i % 7 > 3)) for i in range(600)]
    df = spark.createDataFrame(rows, ["features", "y"])
    df = df.withColumn("y", df["y"].cast("int")).repartition(40)
    asked, real = [], models.LinearSVC

    class Counted(real):
        def fit(self, dataset, params=None):
            asked.append((dataset.rdd.getNumPartitions(), dataset.count()))
            return super().fit(dataset, params)

    monkeypatch.setattr(models, "LinearSVC", Counted)
    got = {}
    for values in (1 << 22, 200, 1):
        monkeypatch.setattr(models, "PASS_VALUES", values)
        scored = models.linear_svc(iterations=10)(df, 2).score(df)
        got[values] = [tuple(r) for r in scored.groupBy("y", "prediction").count().orderBy("y", "prediction").collect()]
    assert [n for n, _ in asked] == [1, 1, 6, 6, 40, 40] and {n for _, n in asked} == {600}
    assert got[1] == got[200] == got[1 << 22]


def test_hash_buckets_are_compared_part_by_part(spark, monkeypatch):
    """Rows of a bucket beyond the first ones are ruled out by a bound; the nearest are those of a plain ranking."""
    r = np.random.default_rng(4)
    d = np.vstack([r.standard_normal((700, 6)), np.zeros((40, 6)), r.standard_normal((60, 6)) * 1e3])
    q, q_id, d_id = np.vstack([d[::9], r.standard_normal((5, 6))]), np.arange(94) * 9, np.arange(800)
    monkeypatch.setattr(neighbours, "FIRST_ROWS", 16)
    compared, exact = [], neighbours._pairwise
    monkeypatch.setattr(neighbours, "_pairwise", lambda a, b, m: compared.append(len(a)) or exact(a, b, m))
    for rows in (1 << 20, 64):
        monkeypatch.setattr(neighbours, "BLOCK_ROWS", rows)
        for metric in ("euclidean", "manhattan", "chebyshev", "minkowski3"):
            for k in (1, 5):
                got = neighbours._nearest_by_parts(q, q_id, d, d_id, k, metric)
                far = np.stack([exact(np.repeat(x[None], len(d), 0), d, metric) for x in q])
                for i in range(len(q)):
                    own = [j for j in np.lexsort((d_id, far[i])) if d_id[j] != q_id[i]][:k]
                    assert got[1][got[0] == i].tolist() == own and got[2][got[0] == i].tolist() == far[i][own].tolist()
    short = neighbours._nearest_by_parts(q[:3], q_id[:3], d[:3], d_id[:3], 5, "euclidean")
    assert np.bincount(short[0]).tolist() == [2, 3, 3]
    assert neighbours._nearest_by_parts(q[:0], q_id[:0], d, d_id, 5, "euclidean")[0].tolist() == []


def test_hashed_rows_travel_packed_and_are_not_broadcast(spark):
    r = np.random.default_rng(5)
    single = r.standard_normal((300, 8)).astype(np.float32).astype(float)
    rows = [(i, i % 3, (v if i % 2 else v + 1e-12).tolist()) for i, v in enumerate(single)]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>")
    asks = df.where("id < 100")
    for queries, data in ((df, df), (asks, df)):
        near = neighbours.knn_by_hashing(queries, data, 4, tables=12, bits=2, block_rows=32)
        got = {(g["id"], g["rank"]): (g["neighbour"], g["distance"]) for g in near.collect()}
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroups" in plan and "BuildLeft" not in plan  # only the counts of the buckets are sent
        want = neighbours.knn_join(queries, data, 4).collect()
        hit = sum(got.get((w["id"], w["rank"])) == (w["neighbour"], w["distance"]) for w in want)
        assert hit > 0.9 * len(want) and len(got) == len(want)


def test_shares_are_made_without_lists_of_a_row(spark):
    rows = [(1, "a", 0, 0.2), (1, "a", 1, 0.6), (1, "a", 1, 0.6), (2, "a", 0, None), (2, "a", 1, 0.5), (3, "b", 0, 0.0), (3, "b", 1, 0.0), (None, "b", 0, 0.3), (4, None, 1, 0.1)]
    done = calibrate._renormalise(spark.createDataFrame(rows, "id long, model string, class int, p double"), "id", 2)
    got = sorted(((r["id"], r["model"], r["class"], round(r["p"], 12)) for r in done.collect()), key=repr)
    share = lambda i, m, p: 0.5 if i in (2, 3) else round(p / {1: 1.4, None: 0.3, 4: 0.1}[i], 12)
    assert got == sorted(((i, m, c, share(i, m, p)) for i, m, c, p in rows), key=repr)
    assert "ObjectHashAggregate" not in done._jdf.queryExecution().executedPlan().toString()


def test_more_rows_are_more_slices(spark, monkeypatch):
    stored, store = [], ranking.durable
    monkeypatch.setattr(ranking, "durable", lambda df: stored.append(df.rdd.getNumPartitions()) or store(df))
    monkeypatch.setattr(ranking, "SLICE_ROWS", 50)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        df = spark.range(2000).selectExpr("id", "id % 2 AS g", "id * 7 % 2000 AS at")
        got = ranking.running_totals(df, ["g"], [df["at"].asc()], {"n": F.lit(1).cast("long")}, one_task_rows=100).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    place = {g: {at: i + 1 for i, at in enumerate(sorted(i * 7 % 2000 for i in range(2000) if i % 2 == g))} for g in (0, 1)}
    assert stored == [40] and all(r["n"] == place[r["g"]][r["at"]] for r in got)


def test_a_run_stores_narrow_columns_and_leaves_few(spark, tmp_path, monkeypatch):
    rows = [(i, "ABC"[i % 3], float(i % 7), float(i % 5), f"job {i % 4}", "xy"[i % 2]) for i in range(240)]
    df = spark.createDataFrame(rows, "obs int, kind string, u double, v double, job string, side string")
    roles = lifecycle.Roles(key="obs", target="kind", numeric=["u", "v"], categorical=["side"], title="job", top_pairs=3)
    kept, write = [], lifecycle.written

    def noted(rows, label):
        out = write(rows, label)
        kept.append((label, rows.columns, out[1]))
        return out

    monkeypatch.setattr(lifecycle, "written", noted)
    monkeypatch.setattr(lifecycle, "KEPT_BYTES", 0)
    fits = {"logistic": models.logistic(iterations=5), "tree": models.random_forest(trees=2, depth=3)}
    done = lifecycle.run(df, df.drop("kind"), roles, fits, str(tmp_path / "out"), folds=2, bar=0.0)
    assert sorted(r["obs"] for r in spark.read.option("header", True).csv(done.predictions).select(F.col("obs").cast("int")).collect()) == list(range(240))
    assert {label for label, _, _ in kept} == {"labelled", "features", "folds", "holdout", "test", "held", "tested", "level", "new-level", "stacked"}
    assert not any("features" in columns or any("_x_" in c for c in columns) for label, columns, _ in kept if "level" not in label)
    there = {label: os.path.isdir(path.removeprefix("file:")) for label, _, path in kept}
    assert there == {label: label != "features" for label in there}
    assert done.report.count() > 0 and done.leaderboard.count() == 4 and done.features.count() > 6


def test_vectors_of_categories_are_made_once_for_each(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")], "id int, c string")
    codes, size = encode.fit_dictionary(df.where("id < 4"), "c", missing=None)
    hot = encode.apply_dictionary(df, codes, size, "c", "h", missing=None)
    assert {r["id"]: r["h"].toArray().tolist() for r in hot.collect()} == {1: [1, 0], 2: [0, 1], 3: [0, 0], 4: [0, 0], 5: [1, 0]}
    assert hot.schema["h"].metadata["ml_attr"]["num_attrs"] == size
    top = hot._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert "concat" not in top and "code#" not in top
