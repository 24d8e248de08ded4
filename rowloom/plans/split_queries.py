"""Splits, folds, samples and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.operators import splits
from rowloom.operators.resample import class_distribution as distribution
from rowloom.plans.registry import query, rnd, rounded
from rowloom.sources.files import table

HASHED = (
    "WITH h AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus "
    "ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS r, "
    "count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) "
)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


@query("stratified_split", HASHED + "SELECT o_orderkey, o_orderstatus, CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM h")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified_split(_orders(spark, sf), "o_orderkey", "o_orderstatus")


@query(
    "three_way_split",
    HASHED + ", s AS (SELECT *, floor(n * 0.2 + 0.5) AS t FROM h) SELECT o_orderkey, o_orderstatus, CASE WHEN r <= t THEN 'test' "
    "WHEN r <= t + floor((n - t) * CAST(0.125 AS DOUBLE) + 0.5) THEN 'val' ELSE 'train' END AS split FROM s",
)
def three_way_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.three_way_split(_orders(spark, sf), "o_orderkey", "o_orderstatus")


@query("stratified_kfold", HASHED + "SELECT o_orderkey, o_orderstatus, CAST((r - 1) % 5 AS INTEGER) AS fold FROM h")
def stratified_kfold(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified_kfold(_orders(spark, sf), "o_orderkey", "o_orderstatus")


@query("sample_n", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 1000")
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return splits.sample_n(_orders(spark, sf), "o_orderkey", 1000)


_WEIGHT = "(SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders) * count(*))"


@query("balanced_class_weight", f"SELECT o_orderstatus, count(*) AS n, {rnd(_WEIGHT, 'weight')} FROM orders GROUP BY o_orderstatus")
def balanced_class_weight(spark: SparkSession, sf: str) -> DataFrame:
    return splits.balanced_class_weight(_orders(spark, sf), "o_orderstatus").select("o_orderstatus", "n", rounded("weight"))


@query(
    "emphasis_weight",
    f"WITH w AS (SELECT o_orderstatus, {_WEIGHT} * CASE WHEN o_orderstatus = 'P' THEN 1.2 ELSE 1 END AS weight FROM orders GROUP BY o_orderstatus) "
    "SELECT o_orderkey, " + rnd("weight", "weight") + " FROM orders JOIN w USING (o_orderstatus)",
)
def emphasis_weight(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    weights = splits.balanced_class_weight(orders, "o_orderstatus", {"P": 1.2})
    return splits.apply_class_weight(orders, weights, "o_orderstatus").select("o_orderkey", rounded("weight"))


@query("class_distribution", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distribution(table(spark, sf, "embeddings"))
