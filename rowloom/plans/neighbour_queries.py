"""Nearest neighbours, voting by neighbours, and class balancing, over all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import neighbours, resample
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded

_DISTANCE = {
    "euclidean": "list_distance(a.vec, b.vec)",
    "manhattan": "list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: abs(z[1] - z[2])))",
    "chebyshev": "list_max(list_transform(list_zip(a.vec, b.vec), lambda z: abs(z[1] - z[2])))",
    "minkowski3": "pow(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: pow(abs(z[1] - z[2]), 3))), 1.0 / 3)",
}


def _near(k: int, metric: str = "euclidean", same_label: bool = False) -> str:
    return (
        f"WITH {fx.VECTORS_SQL}, pairs AS (SELECT a.id, a.label, b.id AS neighbour, b.label AS class, {_DISTANCE[metric]} AS distance "
        f"FROM vectors a JOIN vectors b ON a.id <> b.id{' AND a.label = b.label' if same_label else ''}), "
        "near AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS INTEGER) AS rank FROM pairs "
        f"QUALIFY rank <= {k}) "
    )


def _register(metric: str) -> None:
    name = "knn_join" if metric == "euclidean" else f"knn_join_{metric}"

    @query(name, _near(5, metric) + "SELECT id, neighbour, " + rnd("distance", "distance") + ", rank FROM near")
    def knn(spark: SparkSession, sf: str) -> DataFrame:
        df = fx.vectors(spark, sf)
        return neighbours.knn_join(df, df, 5, metric).select("id", "neighbour", rounded("distance"), "rank")


for _metric in _DISTANCE:
    _register(_metric)


@query("knn_by_hashing")
def knn_by_hashing(spark: SparkSession, sf: str) -> DataFrame:
    """Five neighbours from hash tables; these directions are spread evenly, so nine in ten need many wide buckets."""
    df = fx.vectors(spark, sf)
    return neighbours.knn_by_hashing(df, df, 5, tables=48, bits=6).select("id", "neighbour", rounded("distance"), "rank")


@query(
    "knn_hashing_recall",
    "SELECT count(*) AS n, TRUE AS enough, TRUE AS exact_distances FROM embeddings",
)
def knn_hashing_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the hash tables find at least nine in ten of the exact neighbours, all at their exact distance."""
    df = fx.vectors(spark, sf)
    exact = neighbours.knn_join(df, df, 5).select("id", "neighbour", F.col("distance").alias("d"))
    found = neighbours.knn_by_hashing(df, df, 5, tables=48, bits=6).select("id", "neighbour", "distance")
    met = exact.join(found, ["id", "neighbour"], "left")
    return met.agg(
        F.count_distinct("id").alias("n"), (F.count("distance") >= 0.9 * F.count(F.lit(1))).alias("enough"),
        (F.coalesce(F.max(F.abs(F.col("d") - F.col("distance"))), F.lit(0.0)) < 1e-9).alias("exact_distances"),
    )


@query("knn_join_within_class", _near(5, same_label=True) + "SELECT id, neighbour, " + rnd("distance", "distance") + ", rank FROM near")
def knn_join_within_class(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.vectors(spark, sf)
    return neighbours.knn_join(df, df, 5, within=True).select("id", "neighbour", rounded("distance"), "rank")


_VOTE = "SELECT id, arg_max(class, (round(votes, 9), -class)) AS prediction FROM (SELECT id, class, {w} AS votes FROM near GROUP BY id, class) GROUP BY id"


@query("knn_classify", _near(7) + _VOTE.format(w="count(*)"))
def knn_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Every row is classified by the seven rows nearest to it."""
    df = fx.vectors(spark, sf)
    return neighbours.knn_classify(neighbours.knn_join(df, df, 7))


@query("knn_classify_distance", _near(7) + _VOTE.format(w="sum(1 / distance)"))
def knn_classify_distance(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.vectors(spark, sf)
    return neighbours.knn_classify(neighbours.knn_join(df, df, 7), "distance")


_U32 = "CAST('0x' || substr(md5(concat_ws(':', '42', {args})), 1, 8) AS BIGINT)"
_SMOTE = (
    _near(5, same_label=True)
    + ", c AS (SELECT label, count(*) AS n, (SELECT max(k) FROM (SELECT count(*) AS k FROM vectors GROUP BY label)) - count(*) AS need FROM vectors GROUP BY label), "
    "ranked AS (SELECT v.id, v.label, v.vec, c.n, c.need, row_number() OVER (PARTITION BY v.label ORDER BY md5(concat_ws(':', '42', CAST(v.id AS VARCHAR))), v.id) AS r "
    "FROM vectors v JOIN c ON v.label = c.label), "
    "made AS (SELECT id, label, vec, n, CAST(unnest(generate_series(1, need // n + CASE WHEN r <= need % n THEN 1 ELSE 0 END)) AS BIGINT) AS copy FROM ranked), "
    f"drawn AS (SELECT *, {_U32.format(args='CAST(id AS VARCHAR), CAST(copy AS VARCHAR), ' + chr(39) + 'pick' + chr(39))} % least(5, n - 1) + 1 AS pick, "
    f"{_U32.format(args='CAST(id AS VARCHAR), CAST(copy AS VARCHAR), ' + chr(39) + 'u' + chr(39))} / 4294967296 AS u FROM made), "
    "synth AS (SELECT d.id, d.copy, d.label, x.neighbour, d.u, list_transform(list_zip(d.vec, e.vec), lambda z: z[1] + d.u * (z[2] - z[1])) AS vec "
    "FROM drawn d JOIN near x ON d.id = x.id AND x.rank = d.pick JOIN vectors e ON e.id = x.neighbour) "
)


@query(
    "smote",
    _SMOTE + "SELECT id, copy, label, neighbour, " + rnd("u", "u") + ", " + rnd("vec[1]", "x1") + ", "
    + rnd("list_sum(vec)", "x_sum") + ", " + rnd("list_sum(list_transform(vec, lambda x: x * x))", "x_norm") + " FROM synth",
)
def smote(spark: SparkSession, sf: str) -> DataFrame:
    made = resample.smote(fx.vectors(spark, sf))
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    return made.select(
        "id", "copy", "label", "neighbour", rounded("u"), rounded(F.col("vec")[0], "x1"),
        rounded(total, "x_sum"), rounded(norm, "x_norm"),
    )


@query("smote_counts", "WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label) SELECT label, (SELECT max(n) FROM c) AS n FROM c")
def smote_counts(spark: SparkSession, sf: str) -> DataFrame:
    """After balancing every class is as large as the largest one."""
    return resample.class_distribution(resample.oversample(fx.vectors(spark, sf)))


_TOMEK = _near(1) + "SELECT a.id, a.neighbour AS other FROM near a JOIN near b ON a.neighbour = b.id AND b.neighbour = a.id WHERE a.label <> b.label AND a.id < b.id"


@query("tomek_links", _TOMEK)
def tomek_links(spark: SparkSession, sf: str) -> DataFrame:
    return resample.tomek_links(fx.vectors(spark, sf))


@query("remove_tomek", f"WITH t AS ({_TOMEK}) SELECT vec_id AS id, label FROM embeddings WHERE vec_id NOT IN (SELECT id FROM t UNION ALL SELECT other FROM t)")
def remove_tomek(spark: SparkSession, sf: str) -> DataFrame:
    return resample.remove_tomek(fx.vectors(spark, sf)).select("id", "label")


_BOTH = (
    _SMOTE + ", both_rows AS (SELECT CAST(id AS VARCHAR) AS id, label, vec FROM vectors UNION ALL SELECT concat_ws('#', CAST(id AS VARCHAR), CAST(copy AS VARCHAR)), label, vec FROM synth), "
    "one AS (SELECT a.id, a.label, b.id AS neighbour, b.label AS other_label FROM both_rows a JOIN both_rows b ON a.id <> b.id "
    "QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) = 1), "
    "gone AS (SELECT a.id FROM one a JOIN one b ON a.neighbour = b.id AND b.neighbour = a.id WHERE a.label <> a.other_label) "
)


@query("smote_tomek", _BOTH + "SELECT label, count(*) AS n FROM both_rows WHERE id NOT IN (SELECT id FROM gone) GROUP BY label")
def smote_tomek(spark: SparkSession, sf: str) -> DataFrame:
    """Class sizes after both steps."""
    return resample.class_distribution(resample.smote_tomek(fx.vectors(spark, sf)))


@query(
    "balanced_folds",
    "WITH f AS (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS fold), c AS (SELECT fold, label, count(*) AS own FROM embeddings, f WHERE vec_id % 3 <> fold GROUP BY fold, label) "
    "SELECT fold, label, own, max(own) OVER (PARTITION BY fold) - own AS synthetic FROM c",
)
def balanced_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each fold's training part by class, its own and synthetic ones."""
    folded = fx.vectors(spark, sf).withColumn("fold", (F.col("id") % 3).cast("int"))
    rows = resample.balanced_folds(folded, 3)
    return rows.groupBy("fold", "label").agg(F.count_if(~F.col("synthetic")).alias("own"), F.count_if("synthetic").alias("synthetic"))
