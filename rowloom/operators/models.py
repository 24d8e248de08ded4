"""Classifiers over Spark ML, all scored the same way.

Training tables have ``features`` (vector), ``y`` (int 0..k-1) and optionally ``weight``. A fitted
model adds ``probs`` (array of k probabilities) and ``prediction`` (int) to a table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass, field
from hashlib import md5
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.blocks import bound
from rowloom.session import durable


# Numbers that a task of a short pass reads, 32 MB of them.
PASS_VALUES = 1 << 22


def argmax(probs: Column) -> Column:
    """Class of the largest probability, the first one on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def normalised(parts: Column, k: int) -> Column:
    """Scale to a sum of 1; all zeros become equal shares."""
    def scaled(own: Column) -> Column:
        total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        return bound(total, lambda t: F.transform(own, lambda x: F.when(t > 0, x / t).otherwise(F.lit(1.0 / k))))

    return bound(parts, scaled)


def with_shares(df: DataFrame, parts: Column, k: int) -> DataFrame:
    """``df`` with ``probs``, the parts as ``normalised`` scales them.

    Parts and their sum are columns on the way, each computed once, and no part of it is a lambda, which Spark interprets.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    whole = df.select(*kept, parts.alias("_parts"))
    whole = whole.select(*kept, "_parts", sum((F.get("_parts", F.lit(c)) for c in range(k)), F.lit(0.0)).alias("_total"))
    shares = [F.when(F.col("_total") > 0, F.get("_parts", F.lit(c)) / F.col("_total")).otherwise(F.lit(1.0 / k)) for c in range(k)]
    return whole.select(*kept, F.array(*shares).alias("probs"))


@dataclass
class Fitted:
    """A fitted classifier: how to score a table, and per-feature importances when it has them.

    ``kind`` names how the fitted parts (and their weights) score together; a rule without parts has none.
    """

    k: int
    add_probs: Callable[[DataFrame], DataFrame]
    importances: list[float] | None = None
    parts: list[Any] = field(default_factory=list)
    kind: str | None = None
    weights: list[float] = field(default_factory=list)

    def score(self, df: DataFrame) -> DataFrame:
        return self.add_probs(df).withColumn("prediction", argmax(F.col("probs")))

    def write(self, spark: SparkSession, path: str) -> str:
        """Store the model below ``path``; ``load_fitted`` reads it in any session."""
        if self.kind is None:
            raise ValueError("a rule has no parts to store")
        types = "k int, kind string, weights array<double>, importances array<double>"
        row = (self.k, self.kind, [float(w) for w in self.weights], self.importances)
        spark.createDataFrame([row], types).write.mode("overwrite").parquet(f"{path}/model")
        PipelineModel(self.parts).write().overwrite().save(f"{path}/parts")
        return path


Fit = Callable[[DataFrame, int], Fitted]


def _weighted(estimator, df: DataFrame):
    return estimator.setWeightCol("weight") if "weight" in df.columns else estimator


def _by_probability(parts: list, weights: list[float], k: int):
    """Score with a model that yields probabilities for every class."""

    def add(df: DataFrame) -> DataFrame:
        scored = parts[0].transform(df)
        return scored.select(*df.columns, vector_to_array("probability").alias("probs"))

    return add


def _one_class_each(positive: Callable[[], Column]):
    """Score with one binary model per class; their scores are normalised to sum to 1."""

    def scorer(parts: list, weights: list[float], k: int):
        def add(table: DataFrame) -> DataFrame:
            scored = table
            for c, model in enumerate(parts):
                columns = scored.columns
                scored = model.transform(scored).select(*columns, positive().alias(f"_p{c}"))
            each = F.array(*[F.col(f"_p{c}") for c in range(k)])
            return with_shares(scored, each, k).select(*table.columns, "probs")

        return add

    return scorer


def _by_stages(parts: list, weights: list[float], k: int):
    """Score with the weighted votes of successive trees."""

    def add(table: DataFrame) -> DataFrame:
        scored = table
        total = sum(weights) or 1.0
        for i, model in enumerate(parts):
            columns = scored.columns
            scored = model.transform(scored).select(*columns, F.col("_prediction").cast("int").alias(f"_s{i}"))
        votes = []
        for c in range(k):
            vote = F.lit(0.0)
            for i, alpha in enumerate(weights):
                vote = vote + F.when(F.col(f"_s{i}") == c, alpha).otherwise(-alpha / max(k - 1, 1))
            votes.append(F.exp(vote / F.lit(total * max(k - 1, 1))) if parts else F.lit(0.0))
        return with_shares(scored, F.array(*votes), k).select(*table.columns, "probs")

    return add


# How the parts of a stored model score together.
SCORERS = {
    "probability": _by_probability,
    "class_probabilities": _one_class_each(lambda: F.element_at(vector_to_array("probability"), 2)),
    "class_margins": _one_class_each(lambda: 1 / (1 + F.exp(-F.element_at(vector_to_array("_raw"), 2)))),
    "stages": _by_stages,
}


def _fitted(kind: str, parts: list, k: int, importances=None, weights: list[float] = ()) -> Fitted:
    return Fitted(k, SCORERS[kind](parts, list(weights), k), importances, parts, kind, list(weights))


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """A model stored by ``Fitted.write``."""
    from rowloom.operators import boosting  # noqa: F401  # its kind of model is known from then on

    row = spark.read.parquet(f"{path}/model").first()
    return _fitted(row["kind"], PipelineModel.load(f"{path}/parts").stages, row["k"], row["importances"], row["weights"])


def _direct(model, k: int, importances=None) -> Fitted:
    return _fitted("probability", [model], k, importances)


def _clear(model):
    """Own column names, so that several models can score one table."""
    return model.setPredictionCol("_prediction").setRawPredictionCol("_raw")


def random_forest(trees=30, depth=6, impurity="gini", min_leaf=1, subset="auto", seed=42, bootstrap=True) -> Fit:
    def fit(df: DataFrame, k: int) -> Fitted:
        est = RandomForestClassifier(
            labelCol="y", numTrees=trees, maxDepth=depth, impurity=impurity, minInstancesPerNode=min_leaf,
            featureSubsetStrategy=subset, seed=seed, cacheNodeIds=False, bootstrap=bootstrap,
        )
        model = _clear(_weighted(est, df).fit(df))
        return _direct(model, k, model.featureImportances.toArray().tolist())

    return fit


def logistic(c=1.0, l1_ratio=0.0, iterations=100) -> Fit:
    """Multinomial logistic regression; ``c`` is the inverse strength of the penalty on the whole loss."""

    def fit(df: DataFrame, k: int) -> Fitted:
        n = df.count()
        est = LogisticRegression(
            labelCol="y", regParam=1.0 / (c * max(n, 1)), elasticNetParam=l1_ratio, maxIter=iterations, family="multinomial",
            standardization=False,  # the penalty is on the coefficients of the features as they are
        )
        model = _clear(_weighted(est, df).fit(df))
        weights = model.coefficientMatrix.toArray()
        return _direct(model, k, abs(weights).mean(axis=0).tolist())

    return fit


def mlp(iterations=60, seed=42) -> Fit:
    """Feed-forward network with hidden layers of a half and a quarter of the input width."""

    def fit(df: DataFrame, k: int) -> Fitted:
        n = len(df.select("features").first()[0])
        est = MultilayerPerceptronClassifier(
            labelCol="y", layers=[n, max(n // 2, 2), max(n // 4, 2), k], maxIter=iterations, seed=seed,
        )
        return _direct(_clear(est.fit(df)), k)

    return fit


def _one_vs_rest(make, kind: str, task_values: int | None = None) -> Fit:
    """k binary models on one persisted table, whose partitions are put together until a task reads ``task_values`` numbers, if told."""

    def fit(df: DataFrame, k: int) -> Fitted:
        kept = df.persist()
        n = kept.count()
        read = kept
        if task_values and n:
            read = kept.coalesce(-(-n * len(kept.select("features").first()[0]) // task_values))

        def one(c: int):
            target = read.withColumn("_is", (F.col("y") == c).cast("double"))
            return _clear(_weighted(make(n), kept).setLabelCol("_is").fit(target))

        models = side_by_side([lambda c=c: one(c) for c in range(k)])
        kept.unpersist()

        importances = None
        if hasattr(models[0], "featureImportances"):
            columns = zip(*[m.featureImportances.toArray().tolist() for m in models])
            importances = [sum(col) / k for col in columns]
        elif hasattr(models[0], "coefficients"):
            columns = zip(*[abs(m.coefficients.toArray()).tolist() for m in models])
            importances = [sum(col) / k for col in columns]
        return _fitted(kind, models, k, importances)

    return fit


def gradient_boosting(rounds=10, depth=3, step=0.1, seed=42, subsample=1.0, min_leaf=1) -> Fit:
    def make(n: int):
        return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, subsamplingRate=subsample, minInstancesPerNode=min_leaf)

    return _one_vs_rest(make, "class_probabilities")


def linear_svc(c=1.0, iterations=50) -> Fit:
    """Linear margins, one class against the rest; ``c`` is the inverse strength of the penalty on the whole loss.

    A line search of a loss with kinks takes many short passes, and each costs as much as it has tasks.
    """

    def make(n: int):
        return LinearSVC(regParam=1.0 / (c * max(n, 1)), maxIter=iterations, standardization=False)

    return _one_vs_rest(make, "class_margins", PASS_VALUES)


def adaboost(rounds=8, depth=2, seed=42, cut_every=4, rate=1.0) -> Fit:
    """Multi-class boosting by reweighting: stage weight ``rate`` times ln((1-e)/e) + ln(k-1).

    Importances are the trees' own, weighted by their stages.
    """

    def fit(df: DataFrame, k: int) -> Fitted:
        start = F.col("weight") if "weight" in df.columns else F.lit(1.0)
        current = df.select("features", "y", start.cast("double").alias("w")).persist()
        stages: list[tuple[float, Any]] = []
        last = None
        for i in range(rounds):
            tree = DecisionTreeClassifier(labelCol="y", weightCol="w", maxDepth=depth, seed=seed + i)
            model = tree.fit(current).setPredictionCol("_prediction").setRawPredictionCol("_raw").setProbabilityCol("_prob")
            wrong = (F.col("_prediction").cast("int") != F.col("y")).cast("double")
            judged = model.transform(current).select("features", "y", "w", wrong.alias("_wrong"))
            sums = judged.agg(F.sum(F.col("w") * F.col("_wrong")).alias("bad"), F.sum("w").alias("all")).first()
            error = sums["bad"] / sums["all"]
            if error >= 1.0 - 1.0 / k:
                break
            alpha = rate * (math.log((1.0 - max(error, 1e-10)) / max(error, 1e-10)) + math.log(max(k - 1, 1)))
            stages.append((alpha, model))
            if error <= 0:
                break
            # Divided by the total, so that the weights stay within range over many rounds.
            grown = F.col("w") * F.exp(F.lit(alpha) * F.col("_wrong")) / F.lit(sums["all"])
            if last is not None:
                last.unpersist()
            last, current = current, judged.select("features", "y", grown.alias("w"))
            # A fit reads its input several times; the lineage is cut every few rounds.
            current = durable(current) if (i + 1) % cut_every == 0 else current.persist()

        total = sum(a for a, _ in stages)
        own = [[a * v for v in m.featureImportances.toArray().tolist()] for a, m in stages]
        importances = [sum(column) / total for column in zip(*own)] if stages and total else None
        return _fitted("stages", [m for _, m in stages], k, importances, [a for a, _ in stages])

    return fit


def long_probabilities(scored: DataFrame, key: str, model: str, extra: list[str] = ()) -> DataFrame:
    """One row per (key, class): the form every ensemble and metric works on."""
    return scored.select(
        key, *extra, F.lit(model).alias("model"), F.posexplode("probs").alias("class", "p")
    )


def side_by_side(jobs: list[Callable[[], Any]], threads: int = 4) -> list[Any]:
    """Results of independent fits, submitted from a few threads so that their stages overlap."""
    with ThreadPool(min(threads, len(jobs))) as pool:
        return pool.map(lambda job: job(), jobs)


def oof_predict(
    train: DataFrame, fit: Fit, k: int, key: str, name: str, test: DataFrame | None = None, folds: int = 5,
    resample: Callable[[DataFrame], DataFrame] | None = None, at_once: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Out-of-fold probabilities of ``train`` (which has ``fold``), and the test mean over the fold models.

    ``resample`` changes what each fold's model is fitted on, and nothing that is scored. ``test`` is read once and not shuffled: a row carries the scores of all fold models to their mean.
    With ``at_once``, ``train`` is a stored table that needs no further copy, and only so many folds are fitted, each with a copy of its own, at a time.
    """
    kept = train if at_once else train.persist()
    models = side_by_side([
        lambda f=f: fit((resample or (lambda t: t))(kept.where(F.col("fold") != f).drop("fold")), k) for f in range(folds)
    ], at_once or 4)
    held = None
    for f, fitted in enumerate(models):
        part = long_probabilities(fitted.score(kept.where(F.col("fold") == f)), key, name, ["y", "fold"])
        held = part if held is None else held.unionByName(part)
    if test is None:
        return held, None
    scored = test.select(key, "features")
    for f, fitted in enumerate(models):
        scored = fitted.add_probs(scored).withColumnRenamed("probs", f"_probs{f}")
    means = [sum((F.get(f"_probs{f}", F.lit(c)) for f in range(folds)), F.lit(0.0)) / folds for c in range(k)]
    return held, long_probabilities(scored.select(key, F.array(*means).alias("probs")), key, name)


def class_array(value: Column, k: int, cls: str = "class") -> Column:
    """Aggregate of long rows: the value of each class 0..k-1, as an array of plain maxima."""
    return F.array(*[F.max(F.when(F.col(cls) == c, value)) for c in range(k)])


def predicted_class(long: DataFrame, by: list[str], k: int) -> DataFrame:
    """Argmax of long probabilities, ties to the smallest class."""
    return long.groupBy(*by).agg(argmax(class_array(F.col("p"), k)).alias("prediction"))


def fold_accuracy(oof: DataFrame, key: str, k: int) -> DataFrame:
    called = predicted_class(oof, [key, "model", "fold", "y"], k)
    hit = (F.col("prediction") == F.col("y")).cast("double")
    return called.groupBy("model", "fold").agg(F.avg(hit).alias("accuracy"))


def cv_score(fold_scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold accuracies per model."""
    return fold_scores.groupBy("model").agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std")
    )


def cross_validate(train: DataFrame, fit: Fit, k: int, key: str, name: str, folds: int = 5) -> float:
    held, _ = oof_predict(train, fit, k, key, name, folds=folds)
    return cv_score(fold_accuracy(held, key, k)).first()["cv_mean"]


def random_grid(space: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """``n`` settings out of all combinations, in the order of a seeded hash."""
    names = sorted(space)
    every = [dict(zip(names, values)) for values in product(*[space[k] for k in names])]
    return sorted(every, key=lambda s: md5(f"{seed}:{s}".encode()).hexdigest())[:n]


def param_search(
    train: DataFrame, make: Callable[..., Fit], grid: list[dict], k: int, key: str,
    stored: DataFrame | None = None, patience: int = 10, folds: int = 3,
) -> DataFrame:
    """Trials table (trial, params, score, best): settings already stored are not fitted again."""
    spark = train.sparkSession
    done = {r["params"]: r["score"] for r in stored.collect()} if stored is not None else {}
    rows, best, stale = [], -math.inf, 0
    for i, params in enumerate(grid):
        text = ", ".join(f"{n}={params[n]}" for n in sorted(params))
        score = done[text] if text in done else cross_validate(train, make(**params), k, key, text, folds)
        rows.append((i, text, float(score)))
        best, stale = (score, 0) if score > best else (best, stale + 1)
        if stale >= patience:
            break
    top = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return spark.createDataFrame([(*r, r[0] == top) for r in rows], "trial int, params string, score double, best boolean")


def sampled(space: dict[str, tuple], trial: int, seed: int = 42) -> dict:
    """The setting of a trial: each name drawn from its range by a hash of seed, trial and name.

    Ranges are ("int", low, high), both included, ("float", low, high), ("log", low, high) and ("choice", values).
    """
    out = {}
    for name in sorted(space):
        kind, *told = space[name]
        u = int(md5(f"{seed}:{trial}:{name}".encode()).hexdigest()[:8], 16) / 2**32
        if kind == "int":
            out[name] = told[0] + int(u * (told[1] - told[0] + 1))
        elif kind == "float":
            out[name] = told[0] + u * (told[1] - told[0])
        elif kind == "log":
            out[name] = told[0] * (told[1] / told[0]) ** u
        elif kind == "choice":
            out[name] = told[0][int(u * len(told[0]))]
        else:
            raise ValueError(f"{name}: no range {kind}")
    return out


def _one_fold(train: DataFrame, fit: Fit, k: int, fold: int) -> float:
    fitted = fit(train.where(F.col("fold") != fold).drop("fold"), k)
    held = fitted.score(train.where(F.col("fold") == fold))
    return float(held.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0])


_TRIALS = "trial int, seed long, space string, params string, accuracies array<double>, stopped boolean"


def range_search(
    train: DataFrame, make: Callable[..., Fit], space: dict[str, tuple], trials: int, k: int, store: str,
    folds: int = 3, hopeless: float = 0.05, patience: int = 10, seed: int = 42,
) -> DataFrame:
    """Trials over ranges, continued from the table stored at ``store``: (trial, params, accuracies, score, stopped, best).

    A trial is cross-validated fold by fold and stopped once its mean so far lies more than ``hopeless`` below that of the
    best finished trial over the same folds; it then has no score. Every trial is stored when it ends, so a search that was
    broken off, or asked for more trials, fits only what is new. The search ends after ``patience`` trials without gain.
    """
    spark, shape = train.sparkSession, json.dumps(space, sort_keys=True)
    try:
        known = spark.read.schema(_TRIALS).parquet(store)
        done = {r["trial"]: r for r in known.where((F.col("seed") == seed) & (F.col("space") == shape)).collect()}  # a row per trial
    except AnalysisException:
        done = {}
    kept = train.persist()
    rows, best, stale = [], None, 0
    for trial in range(trials):
        if trial in done:
            accuracies, stopped = list(done[trial]["accuracies"]), done[trial]["stopped"]
        else:
            fit, accuracies, stopped = make(**sampled(space, trial, seed)), [], False
            for fold in range(folds):
                accuracies.append(_one_fold(kept, fit, k, fold))
                n = len(accuracies)
                if best and n < folds and sum(accuracies) / n < sum(best[:n]) / n - hopeless:
                    stopped = True
                    break
            row = (trial, seed, shape, json.dumps(sampled(space, trial, seed)), accuracies, stopped)
            spark.createDataFrame([row], _TRIALS).write.mode("append").parquet(store)
        score = None if stopped else sum(accuracies) / len(accuracies)
        rows.append((trial, json.dumps(sampled(space, trial, seed)), accuracies, score, stopped))
        gained = score is not None and (best is None or score > sum(best) / len(best))
        best, stale = (accuracies, 0) if gained else (best, stale + 1)
        if stale >= patience:
            break
    kept.unpersist()
    finished = [r for r in rows if r[3] is not None]
    top = max(finished, key=lambda r: (r[3], -r[0]))[0]
    return spark.createDataFrame([(*r, r[0] == top) for r in rows], "trial int, params string, accuracies array<double>, score double, stopped boolean, best boolean")
