"""Cleaning and imputation on orders with missing and malformed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import blocks, cleaning
from rowloom.operators import impute, profile, schema
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded
from rowloom.sources.files import table

WITH = f"WITH {fx.MESSY_SQL} "


@query("drop_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return schema.drop_columns(
        table(spark, sf, "orders"),
        ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "salary_category"],
    )


@query("null_tokens", WITH + "SELECT obs, CASE WHEN price_text IN ('', ' ', 'NA', 'None', 'NULL') THEN NULL ELSE price_text END AS price_text FROM messy")
def null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return fx.messy_orders(spark, sf).select("obs", cleaning.null_tokens(F.col("price_text")).alias("price_text"))


@query("to_numeric_coerce", WITH + "SELECT obs, TRY_CAST(price_text AS DOUBLE) AS price FROM messy")
def to_numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    return fx.messy_orders(spark, sf).select("obs", cleaning.to_number(F.col("price_text")).alias("price"))


@query(
    "impute_median",
    WITH + "SELECT obs, " + rnd("coalesce(price, (SELECT median(price) FROM messy))", "price", 4)
    + ", coalesce(nothing, CAST(0 AS DOUBLE)) AS nothing FROM messy",
)
def impute_median(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", "price", "nothing")
    filled = impute.apply_fill(df, impute.fit_median(df, ["price", "nothing"]))
    return filled.select("obs", rounded("price", digits=4), "nothing")


@query("impute_mean", WITH + "SELECT obs, " + rnd("coalesce(price, (SELECT avg(price) FROM messy))", "price", 4) + " FROM messy")
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", "price")
    return impute.apply_fill(df, impute.fit_mean(df, ["price"])).select("obs", rounded("price", digits=4))


@query("impute_constant", WITH + "SELECT obs, coalesce(status, 'Unknown') AS status, coalesce(priority, 'Unknown') AS priority FROM messy")
def impute_constant(spark: SparkSession, sf: str) -> DataFrame:
    return impute.fill_constant(fx.messy_orders(spark, sf).select("obs", "status", "priority"), ["status", "priority"])


@query("impute_bool", WITH + "SELECT obs, coalesce(flag_number, CAST(0 AS DOUBLE)) AS flag_number, coalesce(flag_bool, FALSE) AS flag_bool FROM messy")
def impute_bool(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", "flag_number", "flag_bool")
    return impute.fill_constant(impute.fill_constant(df, ["flag_number"], 0.0), ["flag_bool"], False)


@query(
    "impute_zero",
    "SELECT vec_id, i AS slot, " + rnd("CASE WHEN (vec_id + i) % 5 = 0 THEN 0 ELSE CAST(embedding[i] AS DOUBLE) END", "value")
    + " FROM embeddings, unnest(generate_series(1, len(embedding))) t(i)",
)
def impute_zero(spark: SparkSession, sf: str) -> DataFrame:
    """A numeric block in which every fifth entry is missing or no number."""
    holes = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x, i: F.when((F.col("vec_id") + i + 1) % 5 != 0, x).when(i % 2 == 0, F.lit(float("nan"))),
    )
    filled = table(spark, sf, "embeddings").select("vec_id", blocks.filled_block(holes).alias("block"))
    long = filled.select("vec_id", F.posexplode("block").alias("slot", "value"))
    return long.select("vec_id", (F.col("slot") + 1).cast("long").alias("slot"), rounded("value"))


@query(
    "bool_to_int",
    WITH + "SELECT obs, CASE WHEN lower(flag_text) IN ('true', 'yes', '1') THEN 1 ELSE 0 END AS flag_text, "
    "CASE WHEN flag_bool THEN 1 ELSE 0 END AS flag_bool, "
    "CASE WHEN coalesce(other_number <> 0, TRUE) THEN 1 ELSE 0 END AS other_number FROM messy",
)
def bool_to_int(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf)
    types = {f.name: f.dataType for f in df.schema.fields}
    names = ["flag_text", "flag_bool", "other_number"]
    return df.select("obs", *[cleaning.bool_to_int(F.col(c), types[c]).alias(c) for c in names])


@query(
    "bool_like_check",
    WITH + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} NOT IN (0, 1)) = 0 AS is_boolean, "
        f"count(*) FILTER (WHERE {c} NOT IN (0, 1)) AS n_other, "
        f"CASE WHEN count(*) FILTER (WHERE {c} NOT IN (0, 1)) = 0 THEN CAST(0 AS DOUBLE) ELSE median({c}) END AS fill FROM messy"
        for c in ("flag_number", "other_number")
    ),
)
def bool_like_check(spark: SparkSession, sf: str) -> DataFrame:
    return impute.bool_like_check(fx.messy_orders(spark, sf), ["flag_number", "other_number"])


@query(
    "bool_like_fill",
    WITH + "SELECT obs, CAST(coalesce(flag_number, 0) AS INTEGER) AS flag_number, "
    "coalesce(other_number, (SELECT median(other_number) FROM messy)) AS other_number FROM messy",
)
def bool_like_fill(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", "flag_number", "other_number")
    return impute.apply_bool_like(df, impute.bool_like_check(df, ["flag_number", "other_number"]))


_FINITE = "CASE WHEN isnan(wild) OR isinf(wild) THEN NULL ELSE wild END"


@query("clean_nonfinite", WITH + f"SELECT obs, coalesce({_FINITE}, CAST(0 AS DOUBLE)) AS wild FROM messy")
def clean_nonfinite(spark: SparkSession, sf: str) -> DataFrame:
    return fx.messy_orders(spark, sf).select("obs", cleaning.nonfinite_to(F.col("wild")).alias("wild"))


@query(
    "clean_nonfinite_median",
    WITH + f", f AS (SELECT obs, {_FINITE} AS wild FROM messy) SELECT obs, "
    + rnd("coalesce(wild, (SELECT median(wild) FROM f))", "wild", 4) + " FROM f",
)
def clean_nonfinite_median(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", "wild")
    return impute.clean_nonfinite_median(df, ["wild"]).select("obs", rounded("wild", digits=4))


_PROFILED = ["constant", "nothing", "status", "flag_number", "other_number", "price"]
_WITH_NULL = "count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"


@query(
    "constant_columns",
    WITH + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({_WITH_NULL.format(c=c)} AS BIGINT) AS n_distinct, "
        f"CASE WHEN {_WITH_NULL.format(c=c)} <= 1 THEN 'constant' "
        f"WHEN {_WITH_NULL.format(c=c)} <= 3 AND '{c}' IN ('flag_number', 'other_number') THEN 'low_cardinality' ELSE 'ok' END AS flag FROM messy"
        for c in _PROFILED
    ),
)
def constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.constant_columns(fx.messy_orders(spark, sf), _PROFILED, ["flag_number", "other_number"])


@query(
    "null_profile",
    WITH + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM messy"
        for c in ("price", "status", "priority", "posted", "flag_text", "nothing")
    ),
)
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(fx.messy_orders(spark, sf), ["price", "status", "priority", "posted", "flag_text", "nothing"])
