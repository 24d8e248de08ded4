"""Encoders fitted on train orders and applied to test orders."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import encode
from rowloom.operators.preparation import FeaturePreparation, feature_names
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded
from rowloom.session import shared_path
from rowloom.sources.files import table

MESSY = f"WITH {fx.MESSY_SQL}"
CODES_SQL = (
    "codes AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code "
    "FROM (SELECT DISTINCT coalesce(status, 'Unknown') AS label FROM messy))"
)


@query("label_encode", f"{MESSY}, {CODES_SQL} SELECT obs, code FROM messy JOIN codes ON coalesce(status, 'Unknown') = label")
def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", "status")
    return encode.apply_labels(df, encode.fit_labels(df, "status"), "status").select("obs", "code")


@query("label_map", f"{MESSY}, {CODES_SQL} SELECT label, code FROM codes")
def label_map(spark: SparkSession, sf: str) -> DataFrame:
    return encode.fit_labels(fx.messy_orders(spark, sf), "status")


@query(
    "label_decode",
    f"{MESSY}, {CODES_SQL}, p AS (SELECT obs, CAST(obs % 7 AS INTEGER) - 1 AS p FROM messy) "
    "SELECT obs, label, concat('class_', CAST(p AS VARCHAR)) AS generic FROM p "
    "JOIN codes ON code = least(greatest(p, 0), (SELECT max(code) FROM codes))",
)
def label_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Codes from -1 to 5, so that both ends are clipped."""
    df = fx.messy_orders(spark, sf)
    called = df.select("obs", (F.col("obs") % 7 - 1).cast("int").alias("p"))
    decoded = encode.decode_labels(called, encode.fit_labels(df, "status"), "p")
    return encode.decode_labels(decoded, None, "p", "generic").select("obs", "label", "generic")


# The nations of suppliers with a high balance are the fitted set; other nations are unseen.
SEEN_SQL = "seen AS (SELECT DISTINCT s_nationkey AS nation FROM supplier WHERE s_acctbal > 4000)"


@query(
    "unseen_to_default",
    f"WITH {SEEN_SQL}, top AS (SELECT s_nationkey AS m FROM supplier WHERE s_acctbal > 4000 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) "
    "SELECT c_custkey, CASE WHEN c_nationkey IN (SELECT nation FROM seen) THEN c_nationkey ELSE (SELECT m FROM top) END AS nation, "
    "CASE WHEN c_nationkey IN (SELECT nation FROM seen) THEN CAST(c_nationkey AS VARCHAR) ELSE 'Unknown' END AS nation_text FROM customer",
)
def unseen_to_default(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' nations against the nations of suppliers with a high balance."""
    suppliers = table(spark, sf, "supplier").where("s_acctbal > 4000").select(F.col("s_nationkey").alias("nation"))
    seen = suppliers.distinct()
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    filled = encode.unseen_to(customer, seen, "nation", F.lit(encode.mode_of(suppliers, "nation")), "filled")
    text = filled.withColumn("nation", F.col("nation").cast("string"))
    named = encode.unseen_to(text, seen.select(F.col("nation").cast("string")), "nation", "Unknown", "nation_text")
    return named.select("c_custkey", F.col("filled").alias("nation"), "nation_text")


@query("unseen_report", f"WITH {SEEN_SQL} SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_nationkey NOT IN (SELECT nation FROM seen)")
def unseen_report(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "supplier").where("s_acctbal > 4000").select(F.col("s_nationkey").alias("nation")).distinct()
    return encode.unseen_values(table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")), seen, "nation")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "one_hot",
    "SELECT c_custkey, " + ", ".join(f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS segment_{v}" for v in _SEGMENTS) + " FROM customer",
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    values = encode.wide_values(customer, "c_mktsegment")
    return customer.select("c_custkey", *encode.one_hot("c_mktsegment", values, "segment"))


@query(
    "one_hot_vector",
    "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS slot, CAST((SELECT count(DISTINCT p_name) FROM part) AS INTEGER) AS width FROM part",
)
def one_hot_vector(spark: SparkSession, sf: str) -> DataFrame:
    """Any number of categories as one sparse vector; shown as the slot that is set."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    codes, size = encode.fit_dictionary(part, "p_name")
    hot = encode.apply_dictionary(part, codes, size, "p_name", "hot")
    return hot.select("p_partkey", *_slot_and_width("hot"))


def _slot_and_width(vector: str) -> list[Column]:
    """The slot that a sparse vector sets, and its size, without making it dense."""
    text = F.to_json(F.struct(F.col(vector).alias("v")))
    return [F.get_json_object(text, "$.v.indices[0]").cast("int").alias("slot"), F.get_json_object(text, "$.v.size").cast("int").alias("width")]


@query(
    "one_hot_many",
    "WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE md5(CAST(o_orderkey % 5000 AS VARCHAR)) END AS c FROM orders), "
    "k AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS slot FROM (SELECT DISTINCT c FROM t WHERE c IS NOT NULL AND o_orderkey % 3 > 0)) "
    "SELECT o_orderkey, CAST(slot AS INTEGER) AS slot, CAST((SELECT count(*) FROM k) AS INTEGER) AS width FROM t LEFT JOIN k USING (c)",
)
def one_hot_many(spark: SparkSession, sf: str) -> DataFrame:
    """Thousands of categories, fitted on two thirds of the rows; a value that is new or missing sets no slot."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE md5(CAST(o_orderkey % 5000 AS STRING)) END").alias("c"))
    codes, size = encode.fit_dictionary(rows.where("o_orderkey % 3 > 0"), "c", missing=None)
    hot = encode.apply_dictionary(rows, codes, size, "c", "hot", missing=None)
    return hot.select("o_orderkey", *_slot_and_width("hot"))


@query(
    "one_hot_union_many",
    "WITH k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM (SELECT CAST(o_custkey AS VARCHAR) AS v FROM orders UNION SELECT CAST(c_custkey AS VARCHAR) FROM customer)) "
    "SELECT o_orderkey, CAST(slot AS INTEGER) AS slot, CAST((SELECT count(*) FROM k) AS INTEGER) AS width FROM orders JOIN k ON v = CAST(o_custkey AS VARCHAR)",
)
def one_hot_union_many(spark: SparkSession, sf: str) -> DataFrame:
    """The customers of either table as slots."""
    left = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("v"))
    right = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("v"))
    codes, size = encode.one_hot_union_dictionary(left, right, "v")
    return encode.apply_dictionary(left, codes, size, "v", "hot").select("o_orderkey", *_slot_and_width("hot"))


@query(
    "one_hot_union",
    f"{MESSY} SELECT obs, " + ", ".join(f"CASE WHEN status = '{v}' THEN 1 ELSE 0 END AS state_{v}" for v in ("A", "F", "N", "O", "P", "R")) + " FROM messy",
)
def one_hot_union(spark: SparkSession, sf: str) -> DataFrame:
    """Columns for the values of either table; the filled-in 'Unknown' has none."""
    left = fx.messy_orders(spark, sf).select("obs", "status")
    right = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("status"))
    values = encode.one_hot_union_values(left, right, "status")
    return left.fillna("Unknown", subset=["status"]).select("obs", *encode.one_hot("status", values, "state"))


@query(
    "dummies",
    "WITH k AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS r FROM part GROUP BY p_brand), "
    "c AS (SELECT p_partkey, CASE WHEN r <= 4 THEN p_brand ELSE 'Other' END AS v FROM part JOIN k USING (p_brand)) "
    "SELECT p_partkey, v AS p_brand, 1 AS flag, (SELECT count(DISTINCT v) FROM c) AS n_columns FROM c",
)
def dummies(spark: SparkSession, sf: str) -> DataFrame:
    """Capped at the four most frequent brands; shown long, as the column that is 1 in each row."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    capped = encode.apply_group_rare(part, encode.fit_top_categories(part, "p_brand", 4), "p_brand", "v", "Other")
    values = encode.wide_values(capped, "v")
    wide = capped.select("p_partkey", *encode.one_hot("v", values, "p_brand"))
    long = wide.unpivot(["p_partkey"], [f"`p_brand_{v}`" for v in values], "column_name", "flag").where("flag = 1")
    name = F.regexp_replace("column_name", "^p_brand_", "")
    return long.select("p_partkey", name.alias("p_brand"), "flag", F.lit(len(values)).cast("long").alias("n_columns"))


_TE = (
    f"WITH {fx.PARTS_SQL}, p AS (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS prior FROM train), "
    "s AS (SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS m, count(*) AS n FROM train GROUP BY o_custkey), "
    "e AS (SELECT o_custkey, prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0))) + m / (1 + exp(-(n - 20) / 10.0)) AS encoded FROM s, p) "
)


def _status_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    hit = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y")
    return tuple(p.select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"), hit) for p in fx.order_parts(spark, sf))


@query("target_encode", _TE + "SELECT o_orderkey, " + rnd("coalesce(encoded, (SELECT prior FROM p))", "encoded") + " FROM test LEFT JOIN e USING (o_custkey)")
def target_encode(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _status_parts(spark, sf)
    state = encode.fit_target_means(train, "cust", "y")
    return encode.apply_target_means(test, state, "cust", "encoded").select("o_orderkey", rounded("encoded"))


_ORD = f"WITH {fx.PARTS_SQL}, t AS (SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS y FROM train) "


@query(
    "ordered_target_encode",
    _ORD + "SELECT o_orderkey, " + rnd(
        "(coalesce(sum(y) OVER w, 0) + (SELECT avg(y) FROM t)) / (count(y) OVER w + 1)", "encoded"
    ) + " FROM t WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
)
def ordered_target_encode(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _status_parts(spark, sf)
    return encode.ordered_target_means(train, "cust", "y", "o_orderkey", "encoded").select("o_orderkey", rounded("encoded"))


@query(
    "ordered_target_encode_test",
    _ORD + ", s AS (SELECT o_custkey, (sum(y) + (SELECT avg(y) FROM t)) / (count(*) + 1) AS encoded FROM t GROUP BY o_custkey) "
    "SELECT test.o_orderkey, " + rnd("encoded", "encoded") + " FROM test LEFT JOIN s USING (o_custkey)",
)
def ordered_target_encode_test(spark: SparkSession, sf: str) -> DataFrame:
    """New rows take the totals of all training rows."""
    train, test = _status_parts(spark, sf)
    state = encode.fit_ordered_totals(train, "cust", "y")
    return encode.lookup(test, state, "cust").select("o_orderkey", rounded("encoded"))


def preparation_for(spark: SparkSession, sf: str) -> tuple[FeaturePreparation, DataFrame]:
    """A fitted preparation of messy orders, and the table it was fitted on."""
    df = fx.messy_orders(spark, sf).select("obs", "price", "other_number", "status", "flag_bool")
    return FeaturePreparation(["price", "other_number"], ["status"], ["flag_bool"]).fit(df), df


_PREPARED = (
    f"{MESSY}, m AS (SELECT median(price) AS m1, median(other_number) AS m2 FROM messy), "
    "f AS (SELECT obs, coalesce(price, m1) AS price, coalesce(other_number, m2) AS other_number, coalesce(status, 'Unknown') AS status, coalesce(CAST(flag_bool AS INTEGER), 0) AS flag_bool FROM messy, m), "
    "s AS (SELECT avg(price) AS a1, stddev_pop(price) AS d1, avg(other_number) AS a2, stddev_pop(other_number) AS d2 FROM f) "
    "SELECT obs, " + rnd("(price - a1) / d1", "price") + ", " + rnd("(other_number - a2) / d2", "other_number") + ", "
    + ", ".join(f"CASE WHEN status = '{v}' THEN 1 ELSE 0 END AS status_{v}" for v in ("F", "O", "P", "Unknown")) + ", flag_bool FROM f, s"
)


def _spread_out(fitted: FeaturePreparation, out: DataFrame) -> DataFrame:
    """The few categories of the status as columns."""
    names = [n for n in fitted.names if n.startswith("status_")]
    hot = vector_to_array("status_hot")
    flags = [hot[i].cast("int").alias(n) for i, n in enumerate(names)]
    return out.select("obs", rounded("price"), rounded("other_number"), *flags, "flag_bool")


_PREPARED_MANY = (
    "WITH t AS (SELECT o_orderkey AS obs, o_totalprice AS price, CAST(o_orderkey % {k} AS VARCHAR) AS kind FROM orders), "
    "s AS (SELECT avg(price) AS a, stddev_pop(price) AS d FROM t), "
    "k AS (SELECT kind, row_number() OVER (ORDER BY kind) AS slot FROM (SELECT DISTINCT kind FROM t)) "
    "SELECT obs, " + rnd("(price - a) / d", "price") + ", CAST(slot AS INTEGER) AS slot, CAST((SELECT count(*) FROM k) + 1 AS INTEGER) AS width FROM t JOIN k USING (kind), s"
)


def _register_sizes(k: int) -> None:
    @query(f"feature_preparation_{k}", _PREPARED_MANY.format(k=k))
    def prepared(spark: SparkSession, sf: str) -> DataFrame:
        """A preparation of any number of categories, stored and read back, as assembled vectors of one schema."""
        rows = table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("obs"), F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % k).cast("string").alias("kind")
        )
        fitted = FeaturePreparation(["price"], ["kind"], []).fit(rows)
        loaded = FeaturePreparation.read(spark, fitted.write(shared_path(spark, "preparation")))
        text = F.to_json(F.struct(F.col("features").alias("v")))
        return loaded.assemble(rows).select(
            "obs", rounded(F.get_json_object(text, "$.v.values[0]").cast("double"), "price"),
            F.get_json_object(text, "$.v.indices[1]").cast("int").alias("slot"), F.get_json_object(text, "$.v.size").cast("int").alias("width"),
        )


for _k in (5, 5000):
    _register_sizes(_k)


@query("feature_preparation", _PREPARED)
def feature_preparation(spark: SparkSession, sf: str) -> DataFrame:
    fitted, df = preparation_for(spark, sf)
    return _spread_out(fitted, fitted.transform(df))


@query("preparation_store", _PREPARED)
def preparation_store(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a preparation that was stored and read back."""
    fitted, df = preparation_for(spark, sf)
    loaded = FeaturePreparation.read(spark, fitted.write(shared_path(spark, "preparation")))
    return _spread_out(loaded, loaded.transform(df))


@query(
    "feature_names",
    f"{MESSY}, v AS (SELECT DISTINCT 'status_' || coalesce(status, 'Unknown') AS feature FROM messy), "
    "n AS (SELECT 1 AS part, 'price' AS feature UNION ALL SELECT 2, 'other_number' UNION ALL SELECT 3, feature FROM v UNION ALL SELECT 4, 'flag_bool') "
    "SELECT CAST(row_number() OVER (ORDER BY part, feature) - 1 AS INTEGER) AS slot, feature FROM n",
)
def names_of_features(spark: SparkSession, sf: str) -> DataFrame:
    fitted, df = preparation_for(spark, sf)
    prefixed = [f"num__{n}" if n in fitted.numeric else f"cat__{n}" for n in fitted.names]
    return feature_names(df, prefixed)


@query(
    "normalise_predictions",
    f"{MESSY}, {CODES_SQL}, p AS (SELECT obs, CASE WHEN obs % 4 = 0 THEN CAST(obs % 3 AS VARCHAR) WHEN obs % 4 = 1 THEN 'none' ELSE status END AS p FROM messy) "
    "SELECT obs, coalesce(code, TRY_CAST(p AS INTEGER), -1) AS code FROM p LEFT JOIN codes ON label = p",
)
def normalise_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions that are labels, numbers as text, or neither."""
    df = fx.messy_orders(spark, sf)
    mixed = F.expr("CASE WHEN obs % 4 = 0 THEN CAST(obs % 3 AS STRING) WHEN obs % 4 = 1 THEN 'none' ELSE status END")
    called = df.select("obs", mixed.alias("p"))
    return encode.normalise_predictions(called, encode.fit_labels(df, "status"), "p").select("obs", "code")


@query(
    "cardinality_info",
    "SELECT 8 AS position, 'l_returnflag' AS column_name, count(DISTINCT l_returnflag) AS n_distinct FROM lineitem UNION ALL "
    "SELECT 9, 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem UNION ALL "
    "SELECT 3, 'l_linenumber', count(DISTINCT l_linenumber) FROM lineitem UNION ALL SELECT -1, 'job_state', 2",
)
def cardinality_info(spark: SparkSession, sf: str) -> DataFrame:
    return encode.cardinality_info(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber", "job_state"])
