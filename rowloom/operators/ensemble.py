"""Combining models from their long probabilities (id, model, class, p)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.metrics import roc_auc
from rowloom.operators.models import Fit, Fitted, argmax, normalised, predicted_class
from rowloom.operators.sizing import lookup


def vote_weights(board: DataFrame, score: str = "cv_score") -> DataFrame:
    """Weights of the models: score above the lowest, plus a little, scaled to sum to 1."""
    low = board.agg(F.min(score)).first()[0]
    shifted = F.col(score) - F.lit(low) + F.lit(1e-6)
    total = board.agg(F.sum(shifted).alias("t"), F.count(F.lit(1)).alias("k")).first()
    weight = shifted / F.lit(total["t"]) if total["t"] > 0 else F.lit(1.0 / total["k"])
    return board.select("model", weight.alias("weight"))


def weighted_mean(arrays: list[Column], weights: list[float], k: int) -> Column:
    """Weighted mean of arrays of k probabilities that stand in one row."""
    total = sum(weights) or 1.0
    cells = [sum((F.get(a, F.lit(c)) * (w / total) for a, w in zip(arrays, weights)), F.lit(0.0)) for c in range(k)]
    return F.array(*cells)


def accuracy_board(rows: DataFrame, models: list[str]) -> DataFrame:
    """(model, fold, accuracy) from rows with ``scores``, ``y`` and ``fold``: one small aggregate, no regrouping by row."""
    hits = [F.struct(F.lit(m).alias("model"), (argmax(F.col("scores")[m]) == F.col("y")).cast("double").alias("hit")) for m in models]
    each = rows.select("fold", F.inline(F.array(*hits)))
    return each.groupBy("model", "fold").agg(F.avg("hit").alias("accuracy"))


def vote_rows(rows: DataFrame, key: str, weights: dict[str, float], k: int) -> DataFrame:
    """Soft vote of rows whose ``scores`` hold an array of k probabilities under each model's name: (key, probs).

    A row has all it needs, so nothing is shuffled. Weights are one number a model; models without one have no vote.
    """
    names = sorted(weights)
    return rows.select(key, weighted_mean([F.col("scores")[n] for n in names], [weights[n] for n in names], k).alias("probs"))


def hard_vote_rows(rows: DataFrame, key: str, models: list[str], k: int) -> DataFrame:
    """Most frequent class of the models' own, ties to the smallest: (key, prediction)."""
    calls = F.array(*[argmax(F.col("scores")[m]) for m in models])

    def votes(c: int) -> Column:
        return F.size(F.filter(calls, lambda x: x == c))

    counts = F.array(*[votes(c) for c in range(k)])
    return rows.select(key, argmax(counts).alias("prediction"))


def stack_rows(rows: DataFrame, key: str, models: list[str], extra: list[str] = ()) -> DataFrame:
    """The probabilities of all models of a row as one vector, the second level's features."""
    return rows.select(key, *extra, array_to_vector(F.concat(*[F.col("scores")[m] for m in models])).alias("features"))


def per_class_rows(rows: DataFrame, key: str, chosen: dict[int, str], k: int) -> DataFrame:
    """Each class's probability from its chosen model, scaled to a sum of 1: (key, probs)."""
    taken = F.array(*[F.get(F.col("scores")[chosen[c]], F.lit(c)) for c in range(k)])
    return rows.select(key, normalised(taken, k).alias("probs"))


def by_class(rows: DataFrame, key: str) -> DataFrame:
    """(key, class, p) of rows with ``probs``."""
    return rows.select(key, F.posexplode("probs").alias("class", "p"))


def soft_vote(long: DataFrame, key: str, weights: DataFrame | None = None, name: str = "soft_vote") -> DataFrame:
    """Weighted mean probability per class, again in long form."""
    if weights is None:
        mean = F.avg("p")
    else:
        long = lookup(long, weights, "model", "inner")
        mean = F.sum(F.col("p") * F.col("weight")) / F.sum("weight")
    return long.groupBy(key, "class").agg(mean.alias("p")).select(key, F.lit(name).alias("model"), "class", "p")


def hard_vote(long: DataFrame, key: str, k: int) -> DataFrame:
    """Most frequent prediction of the models, ties to the smallest class."""
    calls = predicted_class(long, [key, "model"], k)
    counts = F.array(*[F.count_if(F.col("prediction") == c) for c in range(k)])
    return calls.groupBy(key).agg(argmax(counts).alias("prediction"))


def level_one(long: DataFrame, key: str, models: list[str], k: int, extra: list[str] = ()) -> DataFrame:
    """One row per key with the class probabilities of all models as a feature vector."""
    cells = [(m, c) for m in models for c in range(k)]
    wide = long.groupBy(key, *extra).agg(*[
        F.coalesce(F.max(F.when((F.col("model") == m) & (F.col("class") == c), F.col("p"))), F.lit(0.0)).alias(f"{m}_{c}")
        for m, c in cells
    ])
    names = [f"{m}_{c}" for m, c in cells]
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(wide)
    return assembled.select(key, *extra, "features")


def fit_stacking(oof: DataFrame, key: str, models: list[str], k: int, meta: Fit) -> Fitted:
    """Meta-learner on out-of-fold probabilities only; the raw features are not passed on."""
    return meta(level_one(oof, key, models, k, ["y"]), k)


def best_per_class(oof: DataFrame, **running) -> DataFrame:
    """Per class the model with the best mean one-vs-rest area over folds; a fold without one counts 0.5."""
    areas = roc_auc(
        oof.withColumnRenamed("p", "prob"), ["model", "class", "fold"], "prob", F.col("y") == F.col("class"), **running
    )
    means = areas.groupBy("model", "class").agg(F.avg(F.coalesce("auc", F.lit(0.5))).alias("auc"))
    # One row per model and class.
    order = Window.partitionBy("class").orderBy(F.desc("auc"), "model")
    return means.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def per_class_vote(long: DataFrame, chosen: DataFrame, key: str, name: str = "per_class") -> DataFrame:
    """Take each class's probability from its chosen model and scale to a sum of 1."""
    taken = lookup(long, chosen.select("model", "class"), ["model", "class"], "inner")
    rows = taken.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("class", "p"))).alias("cells"))  # k cells per key
    total = F.aggregate("cells", F.lit(0.0), lambda a, x: a + x["p"])
    return rows.select(key, total.alias("_t"), F.size("cells").alias("_k"), F.inline("cells")).select(
        key, F.lit(name).alias("model"), "class",
        F.when(F.col("_t") > 0, F.col("p") / F.col("_t")).otherwise(1.0 / F.col("_k")).alias("p"),
    )


def leaderboard(board: DataFrame, score: str = "holdout_acc") -> DataFrame:
    """Models with a rank by hold-out accuracy; the board has one row per model."""
    order = Window.orderBy(F.desc(score), "model")
    return board.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def qualify_models(board: DataFrame, bar: float = 0.72) -> DataFrame:
    """Models whose CV score reaches the bar, the best hold-out marked; below the bar the best CV score remains."""
    passed = board.where(F.col("cv_score") >= bar)
    if passed.isEmpty():
        passed = board.orderBy(F.desc("cv_score"), "model").limit(1)
    top = passed.agg(F.max_by("model", F.struct("holdout_acc", "cv_score"))).first()[0]
    return passed.withColumn("is_best", F.col("model") == F.lit(top))
