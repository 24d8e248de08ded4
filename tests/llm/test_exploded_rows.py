"""Rows made by an explode are not broadcast, however few bytes Spark takes them for."""

from pyspark.sql import functions as F

from rowloom.llm import fingerprints


def test_fingerprints_of_all_tables_stay_where_they_are(spark, monkeypatch):
    half = (1 << 63) - 1
    prints = spark.range(3000).select(F.xxhash64("id").bitwiseAND(F.lit(half)).alias("high"), F.xxhash64("id", F.lit(1)).bitwiseAND(F.lit(half)).alias("low"))
    near = prints.limit(50).select("high", F.col("low").bitwiseXOR(F.lit(7)).alias("low"))
    plans, store = [], fingerprints.durable

    def stored(df):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(fingerprints, "durable", stored)
    monkeypatch.setattr(fingerprints, "BUCKET_PRINTS", 4)
    counted = fingerprints.count_within_radius(prints.unionByName(near), 6)
    assert sorted(r["n_within"] for r in counted.collect()) == [1] * 100
    plans.append(counted._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plans[0]
    assert not any("BroadcastHashJoin" in plan for plan in plans)
