"""Inputs of the registered queries, derived from the given tables.

The tables hold no missing or malformed values, so these are put in by rules on the row key. Each
rule is one expression text that Spark and the comparison engine both read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.blocks import bound
from rowloom.functions.keys import hash_int
from rowloom.functions.text import US_REGIONS
from rowloom.operators.models import predicted_class
from rowloom.sources.files import table

YEAR_MONTH = (
    "concat(CAST(year(o_orderdate) AS STRING), '/', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'))"
)

MESSY_ORDERS = {
    "obs": "o_orderkey",
    "price": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END",
    "price_text": (
        "CASE o_orderkey % 11 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN 'None' "
        "WHEN 4 THEN 'NULL' WHEN 5 THEN ' ' ELSE CAST(o_totalprice AS STRING) END"
    ),
    "wild": (
        "CASE o_orderkey % 13 WHEN 0 THEN CAST('Infinity' AS DOUBLE) WHEN 1 THEN CAST('NaN' AS DOUBLE) "
        "WHEN 2 THEN CAST('-Infinity' AS DOUBLE) WHEN 3 THEN NULL ELSE o_totalprice END"
    ),
    "flag_text": (
        "CASE o_orderkey % 9 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'yes' WHEN 3 THEN 'no' "
        "WHEN 4 THEN '1' WHEN 5 THEN '0' WHEN 6 THEN '1.0' WHEN 7 THEN 'Y' ELSE NULL END"
    ),
    "flag_number": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "other_number": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(2.5 AS DOUBLE) WHEN 2 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "flag_bool": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice > 200000 END",
    "status": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END",
    "priority": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END",
    "posted": (
        "CASE o_orderkey % 10 WHEN 0 THEN '2021' WHEN 1 THEN '2021/13' WHEN 2 THEN '/05' WHEN 3 THEN 'abc' "
        f"WHEN 4 THEN NULL ELSE {YEAR_MONTH} END"
    ),
    "constant": "1",
    "nothing": "CAST(NULL AS DOUBLE)",
}

JOB_TITLES = {
    "partkey": "p_partkey",
    "title": (
        "CASE p_partkey % 12 WHEN 0 THEN NULL WHEN 1 THEN concat('Senior SWE ', p_name) "
        "WHEN 2 THEN concat(p_name, ' Data Scientist') WHEN 3 THEN concat('Jr. ', p_name, ' Analyst') "
        "WHEN 4 THEN 'VP of Sales' WHEN 5 THEN concat('Principal Architect, ', p_name) "
        "WHEN 6 THEN 'Entry level PROGRAMMER' WHEN 7 THEN 'Expert Consultant' WHEN 8 THEN 'SRE' "
        "WHEN 9 THEN concat('Head of ', p_brand) WHEN 10 THEN 'Web Developer' ELSE p_name END"
    ),
}

# The codes of all regions in one text, two letters each, so that both engines cut them alike; the last place is no state.
STATE_CODES = "".join(code for codes in US_REGIONS.values() for code in codes) + "ZZ"
CUSTOMER_STATES = {
    "custkey": "c_custkey",
    "state": f"CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE substr('{STATE_CODES}', CAST(1 + 2 * (c_custkey % 52) AS INT), 2) END",
}

ORDINALS = {
    "obs": "o_orderkey",
    "level": "CASE o_orderkey % 6 WHEN 0 THEN 'Entry' WHEN 1 THEN 'Junior' WHEN 2 THEN 'Mid' WHEN 3 THEN 'Senior' WHEN 4 THEN 'Executive' ELSE 'Guru' END",
    "education": "CASE o_orderkey % 7 WHEN 0 THEN 'High School' WHEN 1 THEN 'Associates' WHEN 2 THEN 'Bachelors' WHEN 3 THEN 'Masters' WHEN 4 THEN 'PhD' WHEN 5 THEN 'Professional' ELSE NULL END",
    "age_bucket": "CASE o_orderkey % 6 WHEN 0 THEN '20-29' WHEN 1 THEN '30-39' WHEN 2 THEN '40-49' WHEN 3 THEN '50-59' WHEN 4 THEN '60+' ELSE '10-19' END",
    "years_experience_bucket": "CASE o_orderkey % 7 WHEN 0 THEN '0-2' WHEN 1 THEN '3-5' WHEN 2 THEN '6-10' WHEN 3 THEN '11-15' WHEN 4 THEN '16-20' WHEN 5 THEN '21+' ELSE 'none' END",
}

LINE_FLAGS = {
    "is_open": "CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INT)",
    "is_cheaper": "CAST(CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS INT)",
    "is_taxed": "CAST(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END AS INT)",
    "is_bulk": "CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS INT)",
}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def derive(spark: SparkSession, sf: str, source: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf, source).selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])


def messy_orders(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "orders", MESSY_ORDERS)


MESSY_SQL = f"messy AS (SELECT {select_list(MESSY_ORDERS)} FROM orders)"
TITLES_SQL = f"titles AS (SELECT {select_list(JOB_TITLES)} FROM part)"
STATES_SQL = f"states AS (SELECT {select_list(CUSTOMER_STATES)} FROM customer)"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The embedding table as (id, label, vec)."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vec")
    )


VECTORS_SQL = "vectors AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"

# A hash split of orders into train and test; the share of test rows is 1/5 on average.
IS_TEST = "substr(md5(concat('split:', CAST(o_orderkey AS STRING))), 1, 1) IN ('0', '1', '2')"


def order_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders with their customer's segment, as train and test."""
    orders = table(spark, sf, "orders").withColumn("is_test", F.expr(IS_TEST))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey", "c_acctbal")
    joined = orders.join(customer, "o_custkey")
    return joined.where(~F.col("is_test")).drop("is_test"), joined.where("is_test").drop("is_test")


PARTS_SQL = (
    f"joined AS (SELECT o.*, c.c_mktsegment, c.c_nationkey, c.c_acctbal, {IS_TEST} AS is_test "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey), "
    "train AS (SELECT * EXCLUDE (is_test) FROM joined WHERE NOT is_test), "
    "test AS (SELECT * EXCLUDE (is_test) FROM joined WHERE is_test)"
)

# How strongly each pseudo-model favours the true class.
MODEL_BONUS = {"ada": 300, "bob": 700, "cyd": 1200}
STATUS_CODE = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
FOLD = "CAST(o_orderkey % 5 AS INT)"


def pseudo_probabilities(spark: SparkSession, sf: str, models: list[str] = ("ada", "bob", "cyd")) -> DataFrame:
    """Long probabilities (id, y, fold, model, class, p) made from hashes of all orders."""
    orders = table(spark, sf, "orders").selectExpr("o_orderkey AS id", f"CAST({STATUS_CODE} AS INT) AS y", f"{FOLD} AS fold")

    # Placed by id while rows are narrow: the groupings by id that follow need no further shuffle.
    named = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(MODEL_BONUS[m]).alias("bonus")) for m in models]))
    rows = orders.repartition("id").select("*", named.alias("m"))

    def raw(c: int):
        hashed = hash_int(F.md5(F.concat_ws(":", "m.model", F.col("id").cast("string"), F.lit(str(c))))) % 1000 + 1
        return hashed + F.when(F.col("y") == c, F.col("m.bonus")).otherwise(0)

    raws = rows.select("id", "y", "fold", F.col("m.model").alias("model"), F.array(*[raw(c) for c in range(3)]).alias("raws"))
    total = F.get("raws", F.lit(0)) + F.get("raws", F.lit(1)) + F.get("raws", F.lit(2))
    return raws.select("id", "y", "fold", "model", F.posexplode(F.transform("raws", lambda r: r / total)).alias("class", "p"))


def pseudo_arrays(spark: SparkSession, sf: str, models: list[str] = ("ada", "bob", "cyd")) -> DataFrame:
    """The same probabilities as one row per order: (id, y, fold, scores), an array of classes under each model's name."""
    orders = table(spark, sf, "orders").selectExpr("o_orderkey AS id", f"CAST({STATUS_CODE} AS INT) AS y", f"{FOLD} AS fold")

    def raw(model: str, c: int):
        hashed = hash_int(F.md5(F.concat_ws(":", F.lit(model), F.col("id").cast("string"), F.lit(str(c))))) % 1000 + 1
        return hashed + F.when(F.col("y") == c, MODEL_BONUS[model]).otherwise(0)

    raws = orders.select("id", "y", "fold", *[F.array(*[raw(m, c) for c in range(3)]).alias(m) for m in models])

    def shares(model: str):
        # Bound, or the hashes behind the three numbers are computed again for each of them.
        return bound(F.col(model), lambda own: F.transform(own, lambda r: r / (F.get(own, F.lit(0)) + F.get(own, F.lit(1)) + F.get(own, F.lit(2)))))

    cells = [x for m in models for x in (F.lit(m), shares(m))]
    return raws.select("id", "y", "fold", F.create_map(*cells).alias("scores"))


_RAW = (
    "CAST('0x' || substr(md5(concat_ws(':', m.model, CAST(o.o_orderkey AS STRING), CAST({c} AS STRING))), 1, 8) AS BIGINT) % 1000 + 1 "
    f"+ CASE WHEN {STATUS_CODE} = {{c}} THEN m.bonus ELSE 0 END"
)
_BONUS_ROWS = ", ".join(f"('{m}', {b})" for m, b in MODEL_BONUS.items())
PROBS_SQL = (
    f"raws AS (SELECT o.o_orderkey AS id, CAST({STATUS_CODE} AS INTEGER) AS y, CAST(o.o_orderkey % 5 AS INTEGER) AS fold, m.model, "
    + ", ".join(f"({_RAW.format(c=c)}) AS r{c}" for c in range(3))
    + f" FROM orders o CROSS JOIN (VALUES {_BONUS_ROWS}) m(model, bonus)), "
    "probs AS (SELECT id, y, fold, model, CAST(k.class AS INTEGER) AS class, "
    "CASE k.class WHEN 0 THEN r0 WHEN 1 THEN r1 ELSE r2 END / (r0 + r1 + r2) AS p "
    "FROM raws CROSS JOIN (VALUES (0), (1), (2)) k(class))"
)


def calls(spark: SparkSession, sf: str, model: str = "bob") -> DataFrame:
    """Labels and predictions (id, y, p) of one pseudo-model, straight from its three scores."""
    probs = pseudo_probabilities(spark, sf, [model])
    return predicted_class(probs, ["id", "y"], 3).withColumnRenamed("prediction", "p")


CALLS_SQL = (
    PROBS_SQL + ", calls AS (SELECT id, y, CASE WHEN r0 >= r1 AND r0 >= r2 THEN 0 WHEN r1 >= r2 THEN 1 ELSE 2 END AS p "
    "FROM raws WHERE model = 'bob')"
)
