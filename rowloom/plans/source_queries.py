"""Files, schemas, fitted state, and scoring of whole inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import encode, models, schema
from rowloom.operators.sizing import lookup
from rowloom.plans import fixtures as fx
from rowloom.plans.model_queries import RULE, RULE_FEATURES
from rowloom.plans.registry import query, rnd, rounded
from rowloom.session import shared_path
from rowloom.sources import files, state
from rowloom.streaming.score import score_stream

ORDER_TYPES = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING"
)
STATUS_TOTALS = (
    "SELECT o_orderstatus, count(*) AS n, " + rnd("sum(o_totalprice)", "total", 2) + ", "
    "CAST(max(o_orderkey) AS BIGINT) AS last_key FROM orders GROUP BY o_orderstatus"
)


def _status_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.sum("o_totalprice"), "total", 2),
        F.max("o_orderkey").alias("last_key"),
    )


@query("scan_csv", STATUS_TOTALS)
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_csv(files.table(spark, sf, "orders"), shared_path(spark, "orders-csv"))
    return _status_totals(files.read_csv(spark, path, ORDER_TYPES))


@query("scan_parquet", STATUS_TOTALS)
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return _status_totals(files.table(spark, sf, "orders"))


@query("sink_parquet", STATUS_TOTALS)
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = files.write_parquet(files.table(spark, sf, "orders"), shared_path(spark, "orders"))
    return _status_totals(spark.read.parquet(path))


@query("sink_predictions", "SELECT o_orderkey AS obs, CASE o_orderstatus WHEN 'F' THEN 'Low' WHEN 'O' THEN 'Medium' ELSE 'High' END AS salary_category FROM orders")
def sink_predictions(spark: SparkSession, sf: str) -> DataFrame:
    labels = F.expr("CASE o_orderstatus WHEN 'F' THEN 'Low' WHEN 'O' THEN 'Medium' ELSE 'High' END")
    called = files.table(spark, sf, "orders").select(F.col("o_orderkey").alias("obs"), labels.alias("salary_category"))
    path = files.write_predictions(called, shared_path(spark, "submission"), "obs", "salary_category")
    return files.read_csv(spark, path, "obs BIGINT, salary_category STRING")


@query("json_metadata", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def json_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Props text to typed fields, out to JSON files, and back."""
    parsed = files.table(spark, sf, "events").select("event_type", F.from_json("props", "k BIGINT").alias("p"))
    path = shared_path(spark, "props")
    parsed.select("event_type", F.to_json("p").alias("props")).write.json(path)
    back = spark.read.schema("event_type STRING, props STRING").json(path)
    return back.groupBy(F.from_json("props", "k BIGINT")["k"].alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_type").alias("kinds")
    )


@query(
    "metadata_store",
    "SELECT count(*) AS n_events, count(DISTINCT event_type) AS n_kinds, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS top_k, "
    "'events' AS source, TRUE AS complete FROM events",
)
def metadata_store(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of all events, out to a metadata file and read back."""
    found = files.table(spark, sf, "events").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_type").alias("n_kinds"),
        F.max(F.from_json("props", "k BIGINT")["k"]).alias("top_k"),
    ).first().asDict()
    path = files.write_metadata(spark, shared_path(spark, "metadata"), {**found, "source": "events", "complete": True})
    types = "n_events BIGINT, n_kinds BIGINT, top_k BIGINT, source STRING, complete BOOLEAN"
    return spark.createDataFrame([tuple(files.read_metadata(spark, path, types).values())], types)


@query(
    "validate_schema",
    "SELECT 'orders' AS table_name, c.column_name, c.column_name IN ('o_orderkey', 'o_totalprice') AS present, "
    "(SELECT count(*) FROM orders) > 0 AS has_rows FROM (VALUES ('o_orderkey'), ('o_totalprice'), ('salary_category')) c(column_name)",
)
def validate_schema(spark: SparkSession, sf: str) -> DataFrame:
    return schema.validate_schema(files.table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "salary_category"], "orders")


@query(
    "harmonise_types",
    f"WITH {fx.MESSY_SQL} SELECT obs, TRY_CAST(price_text AS DOUBLE) AS price, "
    "CASE WHEN priority IS NULL THEN NULL ELSE CAST(obs AS VARCHAR) END AS priority FROM messy",
)
def harmonise_types(spark: SparkSession, sf: str) -> DataFrame:
    """A test table with text prices and numeric priorities takes the types of train."""
    train = spark.createDataFrame([], "obs BIGINT, price DOUBLE, priority STRING")
    test = fx.messy_orders(spark, sf).select(
        "obs", F.col("price_text").alias("price"), F.when(F.col("priority").isNotNull(), F.col("obs")).alias("priority")
    )
    return schema.harmonise_types(test, train.schema)


@query(
    "align_schema",
    "SELECT 'train' AS part, o_orderkey AS id, o_totalprice AS price, CAST(0 AS DOUBLE) AS balance FROM orders "
    "UNION ALL SELECT 'test', c_custkey, CAST(0 AS DOUBLE), c_acctbal FROM customer",
)
def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    orders = files.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    customer = files.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    left, right = schema.align_both(orders, customer, ["id"])
    both = schema.concat_rows(left.withColumn("part", F.lit("train")), right.withColumn("part", F.lit("test")))
    return both.select("part", "id", F.col("price").cast("double"), F.col("balance").cast("double"))


_KINDS = {
    "l_linenumber": "integer", "l_quantity": "double", "l_discount": "double", "l_returnflag": "text",
    "l_linestatus": "text", "l_suppkey": "integer", "l_extendedprice": "double",
}


@query(
    "detect_column_types",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, CASE WHEN "
        f"{'TRUE' if kind == 'text' else f'count(DISTINCT {c}) < 10'} THEN 'categorical' ELSE 'continuous' END AS kind FROM lineitem"
        for c, kind in _KINDS.items()
    ),
)
def detect_column_types(spark: SparkSession, sf: str) -> DataFrame:
    return schema.detect_column_types(files.table(spark, sf, "lineitem"), list(_KINDS))


@query(
    "save_state",
    "SELECT o_orderpriority, " + rnd("avg(o_totalprice)", "value", 4) + " FROM orders GROUP BY o_orderpriority",
)
def save_state(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs are stored; a run that is not there falls back to the newest."""
    root = shared_path(spark, "state")
    orders = files.table(spark, sf, "orders")
    for run, stat in (("20250101_000000", F.max), ("20250201_000000", F.avg)):
        state.save_state(orders.groupBy("o_orderpriority").agg(stat("o_totalprice").alias("value")), root, "prices", run)
    return state.load_state(spark, root, "prices", "20250301_000000").select("o_orderpriority", rounded("value", digits=4))


@query(
    "load_state",
    "SELECT o_orderkey, coalesce(top, CAST(0.5 AS DOUBLE)) AS value, CAST(0.5 AS DOUBLE) AS fallback FROM orders "
    "LEFT JOIN (SELECT o_orderpriority, max(o_totalprice) AS top FROM orders GROUP BY o_orderpriority) USING (o_orderpriority)",
)
def load_state(spark: SparkSession, sf: str) -> DataFrame:
    """A named run is read back and joined; a state that was never stored gives the default."""
    root = shared_path(spark, "state")
    orders = files.table(spark, sf, "orders")
    for run, stat in (("20250101_000000", F.max), ("20250201_000000", F.avg)):
        state.save_state(orders.groupBy("o_orderpriority").agg(stat("o_totalprice").alias("value")), root, "prices", run)
    first = state.load_state(spark, root, "prices", "20250101_000000")
    never = state.load_state(spark, root, "unknown")
    joined = lookup(orders, first, "o_orderpriority")
    return encode.apply_target_means(joined, never, "o_orderpriority", "fallback").select(
        "o_orderkey", F.coalesce("value", F.lit(0.5)).alias("value"), "fallback"
    )


def _prepare(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", *[F.expr(f"CAST({e} AS DOUBLE)").alias(f"x{i}") for i, e in enumerate(RULE_FEATURES)])


def _rule_model() -> models.Fitted:
    def add(df: DataFrame) -> DataFrame:
        logits = [sum((F.col(f"x{i}") * w for i, w in enumerate(ws)), F.lit(0.0)) for ws in RULE.values()]
        parts = F.array(*[F.exp(z) for z in logits])
        return df.withColumn("probs", models.normalised(parts, len(RULE)))

    return models.Fitted(len(RULE), add)


def _score_sql() -> str:
    logits = [" + ".join(f"({w} * x{i})" for i, w in enumerate(ws)) for ws in RULE.values()]
    features = ", ".join(f"CAST({e} AS DOUBLE) AS x{i}" for i, e in enumerate(RULE_FEATURES))
    exps = ", ".join(f"exp({z}) AS e{c}" for c, z in enumerate(logits))
    probs = ", ".join(rnd(f"e{c} / (e0 + e1 + e2)", f"probability_class_{c}") for c in RULE)
    return (
        f"WITH f AS (SELECT o_orderkey, {features} FROM orders), e AS (SELECT o_orderkey, {exps} FROM f) "
        f"SELECT o_orderkey, CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1 ELSE 2 END AS prediction, {probs} FROM e"
    )


def _rounded_scores(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "prediction", *[rounded(f"probability_class_{c}") for c in RULE])


@query("batch_score", _score_sql())
def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """A parquet file scored into a CSV folder, with one column per class probability."""
    out = shared_path(spark, "scores") + ".csv"
    files.batch_score(f"{sf}/orders.parquet", _prepare, _rule_model(), "o_orderkey", True, out, spark)
    types = "o_orderkey BIGINT, prediction INT, " + ", ".join(f"probability_class_{c} DOUBLE" for c in RULE)
    return _rounded_scores(files.read_csv(spark, out, types))


@query("stream_score", _score_sql())
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """The same file arriving on a stream."""
    source = files.table(spark, sf, "orders")
    out = score_stream(
        spark, sf, source.schema, _prepare, _rule_model(), "o_orderkey",
        shared_path(spark, "stream-out"), shared_path(spark, "stream-check"), True, "orders.parquet",
    )
    return _rounded_scores(spark.read.parquet(out))
