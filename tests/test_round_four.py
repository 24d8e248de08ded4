"""Faults of the round-three findings that must not come back."""

import inspect

import numpy as np
import pytest

from pyspark.sql import functions as F

from rowloom.operators import calibrate, models, neighbours


def _brute(data, k, metric):
    out = []
    for i, x in enumerate(data):
        gap = np.abs(data - x)
        p = neighbours._order(metric)
        d = gap.max(axis=1) if p == np.inf else (gap**p).sum(axis=1)
        d[i] = np.inf
        out.append(np.argsort(d, kind="stable")[:k].tolist())
    return out


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski3", "minkowski2.5"])
@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_sieve_rules_out_most_pairs_and_no_near_one(metric, shift):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1500, 24))
    data[7] *= 1000
    data += shift
    sieve = neighbours._Sieve(data[:64], metric)
    rows, asks = sieve.rows(data), sieve.asks(data[:50])
    near = neighbours._distances(data[:50], data, metric)
    bound = np.sort(near, axis=1)[:, 20]
    size = float(np.sqrt((rows.astype(np.float64) ** 2).sum(1).max()))
    passed = sieve.passes(asks, data[:50], rows, size, bound)
    assert passed[near <= bound[:, None]].all()
    # One row far away widens the error that is allowed for; without it most pairs are ruled out.
    some = np.delete(np.arange(1500), 7)
    rows = rows[some]
    passed = sieve.passes(asks, data[:50], rows, float(np.sqrt((rows.astype(np.float64) ** 2).sum(1).max())), bound)
    assert passed.mean() < 0.5


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski3"])
def test_a_chunk_reads_its_blocks_one_by_one(spark, monkeypatch, metric):
    """Data of many blocks, one chunk: few rounds, each block once, with an outlier, a copy and a shift."""
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 4096)
    rng = np.random.default_rng(5)
    data = rng.normal(size=(1200, 10)) + 1000
    data[3] = 1e7
    data[11] = data[10]
    df = spark.createDataFrame([(i, i % 3, x.tolist()) for i, x in enumerate(data)], "id long, label int, vec array<double>")
    state = neighbours.knn_rounds(df, df, 4, metric, pivots=30, block_rows=25).collect()
    assert len(state) == 1 and len(state[0]["seen"]) == len(set(state[0]["seen"])) > 30
    got = {i: state[0]["near"][4 * j:4 * j + 4] for j, i in enumerate(state[0]["ids"])}
    assert [got[i] for i in range(1200)] == _brute(data, 4, metric)


def test_normalised_computes_its_parts_once(spark):
    """Parts were computed again for each use inside the lambda: 49 s for 150,000 rows of hashes."""
    parts = F.array(*[F.expr(f"CAST(crc32(CAST(id + {c} AS STRING)) % 7 AS DOUBLE)") for c in range(3)])
    df = spark.range(50).select("id", models.normalised(parts, 3).alias("p"), parts.alias("raw"))
    alone = spark.range(50).select(models.normalised(parts, 3).alias("p"))
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Project", 1)[1].count("crc32") <= 2 * 3
    for r in df.collect():
        total = sum(r["raw"])
        assert r["p"] == pytest.approx([x / total for x in r["raw"]] if total else [1 / 3] * 3)
    assert spark.range(1).select(models.normalised(F.lit(None).cast("array<double>"), 3).alias("p")).first()["p"] is None


def test_buckets_are_cut_into_few_blocks():
    """A bucket of 11,250 rows was sent three times from either side, 48 tables over."""
    assert inspect.signature(neighbours.knn_by_hashing).parameters["block_rows"].default >= 11_250


def test_sigmoid_curves_of_all_classes_share_one_count(spark):
    rows = [(i, m, c, (i * 7 + c) % 3, ((i * 37 + c * 11) % 100) / 100) for i in range(300) for m in ("a", "b") for c in range(3)]
    held = spark.createDataFrame(rows, "id long, model string, class int, y int, p double")
    got = calibrate.fit_sigmoids(held, ["a", "b"], 3)
    assert sorted(got) == [(m, c) for m in ("a", "b") for c in range(3)]
    assert got["b", 1] == pytest.approx(calibrate.fit_sigmoid(held, "b", 1), abs=1e-6)
