"""Metrics over predictions and probabilities of all orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import metrics, profile
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded

CALLS = f"WITH {fx.CALLS_SQL} "
PROBS = f"WITH {fx.PROBS_SQL} "
CLASSES = [0, 1, 2]


@query("accuracy", CALLS + "SELECT " + rnd("avg(CASE WHEN y = p THEN 1 ELSE 0 END)", "accuracy") + " FROM calls")
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.accuracy(fx.calls(spark, sf)).select(rounded("accuracy"))


@query(
    "confusion_matrix",
    CALLS + "SELECT CAST(a.c AS INTEGER) AS y, CAST(b.c AS INTEGER) AS p, count(calls.id) AS n FROM (VALUES (0), (1), (2), (3)) a(c) "
    "CROSS JOIN (VALUES (0), (1), (2), (3)) b(c) LEFT JOIN calls ON y = a.c AND p = b.c GROUP BY a.c, b.c",
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """With a fourth class that never occurs."""
    return metrics.confusion_matrix(fx.calls(spark, sf), [0, 1, 2, 3])


@query(
    "confusion_matrix_wide",
    CALLS + "SELECT y, " + ", ".join(f"count(*) FILTER (WHERE p = {c}) AS p_{c}" for c in CLASSES) + " FROM calls GROUP BY y",
)
def confusion_matrix_wide(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_wide(fx.calls(spark, sf), CLASSES)


# Predictions outside the listed classes: an unknown one, none, and one that nobody listed.
_UNLISTED = (
    CALLS + ", odd AS (SELECT id, y, CASE WHEN id % 7 = 0 THEN -1 WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN 9 ELSE p END AS p FROM calls), "
    "v AS (SELECT DISTINCT c FROM (SELECT y AS c FROM odd UNION ALL SELECT p FROM odd UNION ALL SELECT unnest([0, 1, 2, 3]))) "
)


def _odd_calls(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.when(F.col("id") % 7 == 0, F.lit(-1)).when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 13 == 0, F.lit(9))
    calls = fx.calls(spark, sf)
    # A missing prediction must not fall through to the call.
    return calls.withColumn("p", F.when((F.col("id") % 7 == 0) | (F.col("id") % 11 == 0) | (F.col("id") % 13 == 0), odd).otherwise(F.col("p")))


@query(
    "confusion_matrix_unlisted",
    _UNLISTED + "SELECT CAST(a.c AS INTEGER) AS y, CAST(b.c AS INTEGER) AS p, count(odd.id) AS n FROM v a CROSS JOIN v b "
    "LEFT JOIN odd ON y IS NOT DISTINCT FROM a.c AND p IS NOT DISTINCT FROM b.c GROUP BY a.c, b.c",
)
def confusion_matrix_unlisted(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(_odd_calls(spark, sf), [0, 1, 2, 3])


_ODD_REPORT = _UNLISTED + (
    ", k AS (SELECT c AS class, (SELECT count(*) FROM odd WHERE y IS NOT DISTINCT FROM c) AS support, "
    "(SELECT count(*) FROM odd WHERE p IS NOT DISTINCT FROM c) AS predicted, (SELECT count(*) FROM odd WHERE y = c AND p = c) AS hit FROM v), "
    "s AS (SELECT class, support, hit, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS precision, "
    "CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM k), "
    "r AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM s) "
)


@query(
    "classification_report_unlisted",
    _ODD_REPORT + "SELECT coalesce(CAST(class AS VARCHAR), 'none') AS label, " + ", ".join(rnd(s, s) for s in ("precision", "recall", "f1")) + ", support FROM r "
    "UNION ALL SELECT 'accuracy', " + ", ".join(rnd("sum(hit) / sum(support)", s) for s in ("precision", "recall", "f1")) + ", CAST(sum(support) AS BIGINT) FROM r "
    "UNION ALL SELECT 'macro avg', " + ", ".join(rnd(f"avg({s})", s) for s in ("precision", "recall", "f1")) + ", CAST(sum(support) AS BIGINT) FROM r "
    "UNION ALL SELECT 'weighted avg', " + ", ".join(rnd(f"sum({s} * support) / sum(support)", s) for s in ("precision", "recall", "f1"))
    + ", CAST(sum(support) AS BIGINT) FROM r",
)
def classification_report_unlisted(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.classification_report(_odd_calls(spark, sf), [0, 1, 2, 3])
    return report.select("label", *[rounded(s) for s in ("precision", "recall", "f1")], "support")


_REPORT = (
    CALLS + ", k AS (SELECT CAST(c AS INTEGER) AS class, (SELECT count(*) FROM calls WHERE y = c) AS support, "
    "(SELECT count(*) FROM calls WHERE p = c) AS predicted, (SELECT count(*) FROM calls WHERE y = c AND p = c) AS hit "
    "FROM (VALUES (0), (1), (2), (3)) v(c)), "
    "s AS (SELECT class, support, hit, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS precision, "
    "CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM k), "
    "r AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM s) "
)
_SCORES = ["precision", "recall", "f1"]


@query(
    "classification_report",
    _REPORT + "SELECT CAST(class AS VARCHAR) AS label, " + ", ".join(rnd(s, s) for s in _SCORES) + ", support FROM r "
    "UNION ALL SELECT 'accuracy', " + ", ".join(rnd("sum(hit) / sum(support)", s) for s in _SCORES) + ", CAST(sum(support) AS BIGINT) FROM r "
    "UNION ALL SELECT 'macro avg', " + ", ".join(rnd(f"avg({s})", s) for s in _SCORES) + ", CAST(sum(support) AS BIGINT) FROM r "
    "UNION ALL SELECT 'weighted avg', " + ", ".join(rnd(f"sum({s} * support) / sum(support)", s) for s in _SCORES) + ", CAST(sum(support) AS BIGINT) FROM r",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.classification_report(fx.calls(spark, sf), [0, 1, 2, 3])
    return report.select("label", *[rounded(s) for s in _SCORES], "support")


@query("weighted_prf", _REPORT + "SELECT " + ", ".join(rnd(f"sum({s} * support) / sum(support)", f"weighted_{s}") for s in _SCORES) + " FROM r")
def weighted_prf(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.weighted_prf(fx.calls(spark, sf), [0, 1, 2, 3])
    return out.select(*[rounded(c) for c in out.columns])


_STEPS = (
    PROBS + ", g AS (SELECT p AS score, count(*) FILTER (WHERE y = class) AS pos, count(*) FILTER (WHERE y <> class) AS neg FROM probs "
    "WHERE model = 'ada' AND class = 1 GROUP BY p), "
    "c AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM g "
    "WINDOW w AS (ORDER BY score DESC)) "
)


def _class_one(spark: SparkSession, sf: str) -> DataFrame:
    return fx.pseudo_probabilities(spark, sf, ["ada"]).where("class = 1")


@query("roc_curve", _STEPS + f"SELECT {rnd('score', 'threshold', 9)}, {rnd('fp / nn', 'fpr')}, {rnd('tp / np', 'tpr')} FROM c UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0, 0.0")
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = metrics.roc_curve(_class_one(spark, sf), "p", F.col("y") == 1)
    return curve.select(rounded("threshold", digits=9), rounded("fpr"), rounded("tpr"))


@query("roc_auc", _STEPS + "SELECT " + rnd("sum((tp - pos / 2) * neg) / max(np) / max(nn)", "auc") + " FROM c")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_auc(_class_one(spark, sf), [], "p", F.col("y") == 1).select(rounded("auc"))


_OVR = (
    PROBS + ", g AS (SELECT model, class, p, count(*) FILTER (WHERE y = class) AS pos, count(*) FILTER (WHERE y <> class) AS neg FROM probs GROUP BY ALL), "
    "c AS (SELECT *, sum(pos) OVER (PARTITION BY model, class ORDER BY p DESC) AS tp FROM g), "
    "a AS (SELECT model, class, sum((tp - pos / 2) * neg) / sum(pos) / sum(neg) AS auc FROM c GROUP BY model, class) "
)


def _ovr(spark: SparkSession, sf: str) -> DataFrame:
    long = fx.pseudo_probabilities(spark, sf).withColumnRenamed("p", "prob")
    return metrics.roc_auc_ovr(long, ["model"])


@query("roc_auc_ovr", _OVR + "SELECT model, class, " + rnd("auc", "auc") + " FROM a")
def roc_auc_ovr(spark: SparkSession, sf: str) -> DataFrame:
    return _ovr(spark, sf).select("model", "class", rounded("auc"))


@query("roc_auc_ovr_macro", _OVR + "SELECT model, " + rnd("avg(auc)", "auc") + " FROM a GROUP BY model")
def roc_auc_ovr_macro(spark: SparkSession, sf: str) -> DataFrame:
    return _ovr(spark, sf).groupBy("model").agg(rounded(F.avg("auc"), "auc"))


@query("log_loss", PROBS + "SELECT " + rnd("avg(-ln(least(greatest(p, 1e-15), 1 - 1e-15)))", "log_loss") + " FROM probs WHERE y = class AND model = 'bob'")
def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    long = fx.pseudo_probabilities(spark, sf, ["bob"]).withColumnRenamed("p", "prob")
    return metrics.log_loss(long).select(rounded("log_loss"))


@query("brier", _STEPS.split(", g AS")[0] + " SELECT " + rnd("avg(pow(p - CASE WHEN y = 1 THEN 1 ELSE 0 END, 2))", "brier") + " FROM probs WHERE model = 'ada' AND class = 1")
def brier(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.brier(_class_one(spark, sf), "p", F.col("y") == 1).select(rounded("brier"))


@query(
    "prediction_summary",
    CALLS + "SELECT p AS label, count(*) AS n, " + rnd("count(*) * 100.0 / (SELECT count(*) FROM calls)", "pct") + " FROM calls GROUP BY p "
    "UNION ALL SELECT NULL, count(*), 100.0 FROM calls",
)
def prediction_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Count and share per predicted label, and one row for the total."""
    shares = profile.value_share(fx.calls(spark, sf).withColumnRenamed("p", "label"), "label")
    total = shares.agg(F.lit(None).cast("int").alias("label"), F.sum("n").alias("n"), F.lit(100.0).alias("pct"))
    return shares.select("label", "n", rounded("pct")).unionByName(total)
