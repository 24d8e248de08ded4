"""Joins by key, counts, shares, statistics, ranks and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import profile, ranking, schema
from rowloom.operators.sizing import lookup
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded
from rowloom.sources.files import table


@query(
    "align_join",
    "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def align_join(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and labels are brought together by key, never by position."""
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(table(spark, sf, "labels"), "doc_id", "left")


@query(
    "state_lookup_join",
    "SELECT o.o_orderkey, c.total FROM orders o LEFT JOIN "
    "(SELECT o_custkey, " + rnd("max(o_totalprice)", "total", 2) + " FROM orders GROUP BY o_custkey) c USING (o_custkey)",
)
def state_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    """A fitted value per customer; the table is broadcast only when its measured size allows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    fitted = orders.groupBy("o_custkey").agg(rounded(F.max("o_totalprice"), "total", 2))
    return lookup(orders.drop("o_totalprice"), fitted, "o_custkey").select("o_orderkey", "total")


@query(
    "semi_anti_membership",
    "SELECT 'in' AS side, doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) "
    "UNION ALL SELECT 'out', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def semi_anti_membership(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels")
    inside = documents.join(labels, "doc_id", "left_semi").select(F.lit("in").alias("side"), "doc_id")
    return inside.unionByName(documents.join(labels, "doc_id", "left_anti").select(F.lit("out").alias("side"), "doc_id"))


@query("value_counts", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(table(spark, sf, "part"), "p_name")


@query(
    "value_share",
    "SELECT l_returnflag, count(*) AS n, " + rnd("count(*) * 100.0 / (SELECT count(*) FROM lineitem)", "pct") + " FROM lineitem GROUP BY l_returnflag",
)
def value_share(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_share(table(spark, sf, "lineitem"), "l_returnflag").select("l_returnflag", "n", rounded("pct"))


_DISTINCT = ["status", "priority", "price", "nothing", "flag_text"]


@query(
    "count_distinct",
    f"WITH {fx.MESSY_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, "
        f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct_with_null FROM messy"
        for c in _DISTINCT
    ),
)
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return profile.count_distinct(fx.messy_orders(spark, sf), _DISTINCT)


@query(
    "column_stats",
    "SELECT " + ", ".join([
        "max(l_extendedprice) AS max", "min(l_extendedprice) AS min", rnd("avg(l_extendedprice)", "mean", 4),
        rnd("stddev_samp(l_extendedprice)", "std", 4), rnd("median(l_extendedprice)", "median", 4),
        rnd("avg(l_extendedprice) FILTER (WHERE l_returnflag = 'A')", "mean_where", 4),
        "max(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS max_where",
    ]) + " FROM lineitem",
)
def column_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = profile.column_stats(table(spark, sf, "lineitem"), "l_extendedprice", F.col("l_returnflag") == "A")
    exact = ["max", "min", "max_where"]
    return stats.select(*exact, *[rounded(c, digits=4) for c in stats.columns if c not in exact])


_NUMERIC = ["l_quantity", "l_extendedprice", "l_tax", "l_linenumber", "l_suppkey"]


@query(
    "corr_with_target",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + rnd(f"abs(corr({c}, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END))", "abs_corr") + " FROM lineitem"
        for c in _NUMERIC
    ),
)
def corr_with_target(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").withColumn("hit", (F.col("l_returnflag") == "A").cast("int"))
    return profile.corr_with_target(line, _NUMERIC, "hit").select("column_name", rounded("abs_corr"))


@query(
    "corr_block_top10",
    f"WITH {fx.VECTORS_SQL} SELECT CAST(i - 1 AS INTEGER) AS slot, " + rnd("abs(corr(vec[i], label))", "abs_corr")
    + " FROM vectors, unnest(generate_series(1, 64)) t(i) GROUP BY i ORDER BY abs(corr(vec[i], label)) DESC, i LIMIT 10",
)
def corr_block_top10(spark: SparkSession, sf: str) -> DataFrame:
    """The ten slots of the block that go with the label most closely."""
    return profile.block_corr_with_target(fx.vectors(spark, sf), "vec", "label", 10).select("slot", rounded("abs_corr"))


@query("rank_first", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rank FROM orders")
def rank_first(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ranking.rank_first(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "rank")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topk(spark: SparkSession, sf: str) -> DataFrame:
    return profile.topk(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 100)


@query("sort_desc", "SELECT o_custkey, " + rnd("sum(o_totalprice)", "total", 2) + " FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey")
def sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(rounded(F.sum("o_totalprice"), "total", 2))
    return totals.orderBy(F.desc("total"), "o_custkey")


def _nations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    return customer, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))


@query("distinct_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def distinct_union(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_union(*_nations(spark, sf), "nation")


@query("except_values", "SELECT o_custkey AS key FROM orders EXCEPT SELECT s_suppkey FROM supplier")
def except_values(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
    return profile.except_values(orders, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key")), "key")


@query(
    "concat_rows",
    "SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def concat_rows(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    supplier = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"))
    return schema.concat_rows(customer, supplier)
