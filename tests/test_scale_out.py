"""Operators cut into slices, blocks and chunks give what one task would give, hot groups included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowloom.operators import encode, metrics, neighbours, quantiles, ranking, resample, scale, sizing, splits


def hot_table(spark, n=900):
    """A third of the rows share one key, and many values tie."""
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 11}", float((i * 7919) % 13), (i * 31) % 2) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k string, v double, y int").repartition(5)


def as_map(df, key="id"):
    return {r[key]: r for r in df.collect()}


def test_rank_first_across_slices(spark):
    df = hot_table(spark)
    one = as_map(ranking.rank_first(df, "v", "id"))
    many = as_map(ranking.rank_first(df, "v", "id", one_task_rows=10))
    assert {k: r["rank"] for k, r in one.items()} == {k: r["rank"] for k, r in many.items()}
    assert sorted(r["rank"] for r in many.values()) == list(range(1, 901))


def test_running_totals_within_groups_across_slices(spark):
    df = hot_table(spark)
    sums = {"s": F.col("y").cast("double"), "n": F.lit(1).cast("long")}
    one = as_map(ranking.running_totals(df, ["k"], [F.col("id").desc()], sums))
    many = as_map(ranking.running_totals(df, ["k"], [F.col("id").desc()], sums, one_task_rows=10))
    assert one == many


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id long, k string")
    many = ranking.running_totals(df, ["k"], [F.col("id")], {"n": F.lit(1).cast("long")}, one_task_rows=5)
    got = {(r["k"], r["n"]) for r in many.collect()}
    assert got == {(k, n) for k in (None, "a") for n in range(1, 21)}


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_folds_do_not_depend_on_partitions(spark, partitions):
    df = hot_table(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = {r["id"]: r["fold"] for r in splits.stratified_kfold(df, "id", "k").collect()}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        shuffled = df.orderBy(F.desc("v")).repartition(3)
        got = {r["id"]: r["fold"] for r in splits.stratified_kfold(shuffled, "id", "k").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want


def test_folds_keep_class_shares(spark):
    folds = splits.stratified_kfold(hot_table(spark), "id", "k").groupBy("k", "fold").count().collect()
    for k in {r["k"] for r in folds}:
        sizes = [r["count"] for r in folds if r["k"] == k]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_three_way_split_shares(spark):
    counts = splits.three_way_split(hot_table(spark), "id", "k", 0.2, 0.1).groupBy("split").count().collect()
    got = {r["split"]: r["count"] for r in counts}
    assert abs(got["test"] - 180) <= 6 and abs(got["val"] - 90) <= 6 and sum(got.values()) == 900


def test_sample_of_many_rows_equals_hash_order(spark):
    df = spark.range(25_000).withColumnRenamed("id", "key")
    few = {r["key"] for r in splits.sample_n(df, "key", 10_000).collect()}
    many = {r["key"] for r in splits.sample_n(df, "key", 10_001).collect()}
    assert len(few) == 10_000 and len(many) == 10_001 and few < many


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_by_narrowing(spark, q):
    rng = np.random.default_rng(5)
    n = 4001
    frame = {
        "smooth": rng.normal(size=n),
        "skewed": rng.lognormal(4, 3, size=n),
        "hot": np.where(np.arange(n) % 3 == 0, 5.0, rng.normal(size=n)),
        "halves": np.where(np.arange(n) < 2000, 0.0, 1.0),
    }
    rows = list(zip(*[v.tolist() for v in frame.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame)).repartition(4)
    got = quantiles.exact_quantiles(df, list(frame), q, one_task_rows=50)
    for c, values in frame.items():
        assert got[c] == pytest.approx(np.quantile(values, q), rel=1e-9, abs=1e-12)


def test_quantile_between_two_hot_values(spark):
    df = spark.createDataFrame([(float(i % 2),) for i in range(1000)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], 0.5, one_task_rows=10)["x"] == 0.5


@pytest.mark.parametrize("limit", [5, 60, 10_000])
@pytest.mark.parametrize("n", [6, 23, 399, 1000])
def test_quantile_bins_by_cuts_equal_ranks(spark, n, limit):
    """Half of the rows share one value, and keys do not follow the row order."""
    rows = [((i * 7919) % 100003, 5.0 if i % 2 else float((i * 31) % 97)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(3)
    got = {r["id"]: r["b"] for r in scale.quantile_bins(df, "v", "id", "b", one_task_rows=limit).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    want = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False).tolist()
    assert [got[k] for k, _ in order] == want


def test_quantile_bins_keep_null(spark):
    df = spark.createDataFrame([(i, None if i > 9 else float(i)) for i in range(12)], "id long, v double")
    got = {r["id"]: r["b"] for r in scale.quantile_bins(df, "v", "id", "b").collect()}
    assert got[10] is None and got[11] is None and got[0] == 0 and got[9] == 4


def test_rows_at_ranks_of_large_keys(spark):
    big = 2**60
    df = spark.createDataFrame([(big + i, 1.0) for i in range(500)], "id long, v double").repartition(4)
    got = quantiles.rows_at_ranks(df, "v", "id", [1, 250, 500], one_task_rows=7)
    assert got == [(1.0, big), (1.0, big + 249), (1.0, big + 499)]


def test_quantile_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"])["x"] is None


def test_ordered_target_means_across_slices(spark):
    df = hot_table(spark)
    one = as_map(encode.ordered_target_means(df, "k", "y", "id", "e"))
    many = as_map(encode.ordered_target_means(df, "k", "y", "id", "e", one_task_rows=10))
    assert {k: round(r["e"], 9) for k, r in one.items()} == {k: round(r["e"], 9) for k, r in many.items()}


def test_split_join_keeps_every_row(spark):
    df = hot_table(spark)
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, w int")
    plain = sorted(map(tuple, df.join(table, "k", "left").select("id", "k", "w").collect()))
    split = sorted(map(tuple, sizing.split_join(df, table, "k", "left", hot_rows=100).select("id", "k", "w").collect()))
    assert plain == split
    inner = sizing.split_join(df, table, "k", "inner", hot_rows=100)
    assert inner.count() == df.join(table, "k").count()


def test_split_join_keeps_null_keys(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "hot") for i in range(100)], "id long, k string")
    table = spark.createDataFrame([("hot", 1)], "k string, w int")
    joined = sizing.split_join(df, table, "k", "left", hot_rows=10)
    assert joined.count() == 100 and joined.where("w IS NULL").count() == 50


def test_measured_size(spark):
    df = spark.range(100)
    assert sizing.size_of(df.select(F.lit("abc").alias("s"))) == (100, 100 * 27)


def brute(data, ids, k, metric, labels=None):
    out = {}
    for i in range(len(data)):
        gap = np.abs(data - data[i])
        dist = {"euclidean": np.sqrt((gap**2).sum(1)), "manhattan": gap.sum(1), "chebyshev": gap.max(1)}[metric]
        rows = [(round(dist[j], 9), ids[j]) for j in range(len(data)) if j != i and (labels is None or labels[i] == labels[j])]
        out[ids[i]] = sorted(rows)[:k]
    return out


def vectors(spark, data, labels):
    rows = [(i, int(labels[i]), data[i].tolist()) for i in range(len(data))]
    return spark.createDataFrame(rows, "id long, label int, vec array<double>").repartition(4)


def clustered(n=240, d=6, seed=2):
    """Clusters, and a third of the rows as copies of one point."""
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, d)) + 8 * rng.integers(0, 4, size=(n, 1))
    data[::3] = data[0]
    return data, rng.integers(0, 3, size=n)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
@pytest.mark.parametrize("within", [False, True])
def test_knn_join_equals_brute_force(spark, metric, within):
    data, labels = clustered()
    df = vectors(spark, data, labels)
    got = {}
    # Small blocks, so that the cell of the copies is cut into many.
    for r in neighbours.knn_join(df, df, 4, metric, within, pivots=12, block_rows=16).collect():
        got.setdefault(r["id"], []).append((round(r["distance"], 9), r["neighbour"]))
    want = brute(data, list(range(len(data))), 4, metric, labels if within else None)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_knn_join_between_two_tables(spark):
    data, labels = clustered()
    df = vectors(spark, data, labels)
    asks = df.where("id >= 200")
    got = {}
    for r in neighbours.knn_join(asks, df.where("id < 200"), 3, pivots=9, block_rows=20).collect():
        got.setdefault(r["id"], []).append((round(r["distance"], 9), r["neighbour"]))
    for i in range(200, 240):
        dist = np.sqrt(((data[:200] - data[i]) ** 2).sum(1))
        assert sorted(got[i]) == sorted((round(x, 9), j) for j, x in enumerate(dist))[:3]


def test_knn_votes_with_distance_zero(spark):
    df = spark.createDataFrame(
        [(1, 10, 0.0), (1, 20, 0.001), (1, 20, 0.001), (2, 10, 0.5), (2, 20, 0.4)], "id long, neighbour_label int, distance double"
    )
    got = {r["id"]: r["prediction"] for r in neighbours.knn_classify(df, "distance").collect()}
    assert got == {1: 10, 2: 20}
    assert {r["id"]: r["prediction"] for r in neighbours.knn_classify(df).collect()} == {1: 20, 2: 10}


def test_smote_rows_lie_between_neighbours_of_their_class(spark):
    data, _ = clustered(120)
    labels = np.array([0] * 80 + [1] * 30 + [2] * 10)
    df = vectors(spark, data, labels)
    made = resample.smote(df, k=3).collect()
    assert len(made) == (80 - 30) + (80 - 10)
    near = brute(data, list(range(120)), 3, "euclidean", labels)
    for r in made:
        assert labels[r["id"]] == labels[r["neighbour"]] == r["label"]
        assert r["neighbour"] in [n for _, n in near[r["id"]]]
        assert 0 <= r["u"] < 1
        np.testing.assert_allclose(r["vec"], data[r["id"]] + r["u"] * (data[r["neighbour"]] - data[r["id"]]))
    again = resample.smote(df.repartition(1), k=3).collect()
    key = lambda r: (r["id"], r["copy"])
    assert sorted(made, key=key) == sorted(again, key=key)


def test_smote_of_a_class_with_one_row(spark):
    data, _ = clustered(20)
    df = vectors(spark, data, np.array([0] * 19 + [1]))
    made = resample.smote(df, k=3).collect()
    assert len(made) == 18 and all(r["vec"] == data[19].tolist() for r in made)


def test_tomek_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    data, labels = rng.normal(size=(80, 3)), rng.integers(0, 2, size=80)
    df = vectors(spark, data, labels)
    near = {i: v[0][1] for i, v in brute(data, list(range(80)), 1, "euclidean").items()}
    want = {(i, j) for i, j in near.items() if near[j] == i and labels[i] != labels[j] and i < j}
    assert {(r["id"], r["other"]) for r in resample.tomek_links(df).collect()} == want
    left = {r["id"] for r in resample.remove_tomek(df).collect()}
    assert left == set(range(80)) - {x for p in want for x in p}


def test_smote_tomek_equals_both_steps(spark):
    rng = np.random.default_rng(6)
    data, labels = rng.normal(size=(40, 2)), np.array([0] * 28 + [1] * 12)
    df = vectors(spark, data, labels)
    rows = {r["id"]: r for r in resample.oversample(df, 3).collect()}
    ids = sorted(rows)
    near = {i: v[0][1] for i, v in brute(np.array([rows[i]["vec"] for i in ids]), ids, 1, "euclidean").items()}
    gone = {i for i in ids if near[near[i]] == i and rows[i]["label"] != rows[near[i]]["label"]}
    assert {r["id"] for r in resample.smote_tomek(df, 3).collect()} == set(ids) - gone


def auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_with_ties_across_slices(spark):
    rng = np.random.default_rng(8)
    y, p = rng.integers(0, 2, 600), rng.integers(0, 40, 600) / 40
    df = spark.createDataFrame([("a" if i % 3 else "b", int(y[i]), float(p[i])) for i in range(600)], "g string, y int, p double")
    for limit in (1_000, 5):
        got = {r["g"]: r["auc"] for r in metrics.roc_auc(df, ["g"], "p", F.col("y") == 1, one_task_rows=limit).collect()}
        mask = np.arange(600) % 3 != 0
        assert got["a"] == pytest.approx(auc(y[mask], p[mask])) and got["b"] == pytest.approx(auc(y[~mask], p[~mask]))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert metrics.roc_auc(df, [], "p", F.col("y") == 1).first()["auc"] is None


def test_report_of_a_class_without_rows(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "y int, p int")
    rows = {r["class"]: r for r in metrics.per_class_report(df, [0, 1, 2]).collect()}
    assert (rows[2]["precision"], rows[2]["recall"], rows[2]["f1"], rows[2]["support"]) == (0, 0, 0, 0)
    assert rows[1]["precision"] == 0.5 and rows[1]["recall"] == 1.0
