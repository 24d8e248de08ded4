"""Ensembles and calibration over the long probabilities of three pseudo-models on all orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators import calibrate, ensemble, models
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded

PROBS = f"WITH {fx.PROBS_SQL}"
MODELS = list(fx.MODEL_BONUS)
_HITS = (
    ", called AS (SELECT id, y, fold, model, arg_max(class, (p, -class)) AS prediction FROM probs GROUP BY id, y, fold, model), "
    "folds AS (SELECT model, fold, avg(CASE WHEN prediction = y THEN 1 ELSE 0 END) AS accuracy FROM called GROUP BY model, fold), "
    "board AS (SELECT model, avg(accuracy) AS cv_score, max_by(accuracy, fold) AS holdout_acc FROM folds GROUP BY model) "
)


def _long(spark: SparkSession, sf: str) -> DataFrame:
    """The probabilities of all models, kept because scores and votes both read them."""
    return fx.pseudo_probabilities(spark, sf).persist()


def board(long: DataFrame) -> DataFrame:
    """One row per model: mean fold accuracy, and the accuracy on the last fold as the hold-out."""
    folds = models.fold_accuracy(long, "id", 3)
    return folds.groupBy("model").agg(
        F.avg("accuracy").alias("cv_score"), F.max_by("accuracy", "fold").alias("holdout_acc")
    ).persist()


@query("argmax_predict", PROBS + _HITS + "SELECT id, model, prediction FROM called")
def argmax_predict(spark: SparkSession, sf: str) -> DataFrame:
    return models.predicted_class(_long(spark, sf), ["id", "model"], 3)


@query(
    "argmax_predict_array",
    PROBS + " SELECT id, CASE WHEN r0 >= r1 AND r0 >= r2 THEN 0 WHEN r1 >= r2 THEN 1 ELSE 2 END AS prediction, "
    "CASE WHEN r1 / (r0 + r1 + r2) > 0.5 THEN 1 ELSE 0 END AS is_one FROM raws WHERE model = 'cyd'",
)
def argmax_predict_array(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities as one array per row, and the two-class rule at one half."""
    long = fx.pseudo_probabilities(spark, sf, ["cyd"])
    rows = long.groupBy("id").agg(models.class_array(F.col("p"), 3).alias("probs"))
    return rows.select("id", models.argmax(F.col("probs")).alias("prediction"), (F.get("probs", F.lit(1)) > 0.5).cast("int").alias("is_one"))


@query("cv_score", PROBS + _HITS + "SELECT model, " + rnd("avg(accuracy)", "cv_mean") + ", " + rnd("stddev_pop(accuracy)", "cv_std") + " FROM folds GROUP BY model")
def cv_score(spark: SparkSession, sf: str) -> DataFrame:
    scores = models.cv_score(models.fold_accuracy(_long(spark, sf), "id", 3))
    return scores.select("model", rounded("cv_mean"), rounded("cv_std"))


_WEIGHTS = (
    PROBS + _HITS + ", w AS (SELECT model, (cv_score - (SELECT min(cv_score) FROM board) + 1e-6) / "
    "(SELECT sum(cv_score - (SELECT min(cv_score) FROM board) + 1e-6) FROM board) AS weight FROM board) "
)


@query("vote_weights", _WEIGHTS + "SELECT model, " + rnd("weight", "weight") + " FROM w")
def vote_weights(spark: SparkSession, sf: str) -> DataFrame:
    return ensemble.vote_weights(board(_long(spark, sf))).select("model", rounded("weight"))


@query("soft_vote", _WEIGHTS + "SELECT id, class, " + rnd("sum(p * weight) / sum(weight)", "p", 9) + " FROM probs JOIN w USING (model) GROUP BY id, class")
def soft_vote(spark: SparkSession, sf: str) -> DataFrame:
    """One row an order, an array a model: the vote shuffles nothing but the counts behind its weights."""
    rows = fx.pseudo_arrays(spark, sf)
    voted = ensemble.vote_rows(rows, "id", _weights(rows), 3)
    return ensemble.by_class(voted, "id").select("id", "class", rounded("p", digits=9))


def _weights(rows: DataFrame) -> dict[str, float]:
    scores = ensemble.accuracy_board(rows, MODELS).groupBy("model").agg(F.avg("accuracy").alias("cv_score"))
    return {r["model"]: r["weight"] for r in ensemble.vote_weights(scores.persist()).collect()}  # one row per model


@query(
    "hard_vote",
    PROBS + _HITS + ", n AS (SELECT id, prediction, count(*) AS n FROM called GROUP BY id, prediction) "
    "SELECT id, arg_max(prediction, (n, -prediction)) AS prediction FROM n GROUP BY id",
)
def hard_vote(spark: SparkSession, sf: str) -> DataFrame:
    return ensemble.hard_vote_rows(fx.pseudo_arrays(spark, sf), "id", MODELS, 3)


_PER_CLASS = (
    PROBS + ", g AS (SELECT model, class, fold, p, count(*) FILTER (WHERE y = class) AS pos, count(*) FILTER (WHERE y <> class) AS neg FROM probs GROUP BY ALL), "
    "c AS (SELECT *, sum(pos) OVER (PARTITION BY model, class, fold ORDER BY p DESC) AS tp FROM g), "
    "a AS (SELECT model, class, fold, sum((tp - pos / 2) * neg) / sum(pos) / sum(neg) AS auc FROM c GROUP BY model, class, fold), "
    "best AS (SELECT model, class, avg(auc) AS auc FROM a GROUP BY model, class QUALIFY row_number() OVER (PARTITION BY class ORDER BY avg(auc) DESC, model) = 1) "
)


@query("best_per_class", _PER_CLASS + "SELECT model, class, " + rnd("auc", "auc") + " FROM best")
def best_per_class(spark: SparkSession, sf: str) -> DataFrame:
    return ensemble.best_per_class(_long(spark, sf)).select("model", "class", rounded("auc"))


@query(
    "per_class_best_ensemble",
    _PER_CLASS + "SELECT id, class, " + rnd("p / sum(p) OVER (PARTITION BY id)", "p", 9) + " FROM probs JOIN best USING (model, class)",
)
def per_class_best_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.pseudo_arrays(spark, sf)
    chosen = {r["class"]: r["model"] for r in ensemble.best_per_class(_long(spark, sf)).collect()}  # one row per class
    return ensemble.by_class(ensemble.per_class_rows(rows, "id", chosen, 3), "id").select("id", "class", rounded("p", digits=9))


@query("hard_vote_long", PROBS + _HITS + ", n AS (SELECT id, prediction, count(*) AS n FROM called GROUP BY id, prediction) SELECT id, arg_max(prediction, (n, -prediction)) AS prediction FROM n GROUP BY id")
def hard_vote_long(spark: SparkSession, sf: str) -> DataFrame:
    """The same vote where models come as rows of their own."""
    return ensemble.hard_vote(_long(spark, sf), "id", 3)


@query(
    "nested_ensemble",
    _WEIGHTS + ", v AS (SELECT id, class, sum(p * weight) / sum(weight) AS p FROM probs JOIN w USING (model) GROUP BY id, class), "
    "u AS (SELECT id, class, avg(p) AS p FROM probs GROUP BY id, class), "
    "b AS (SELECT id, class, p FROM probs WHERE model = (SELECT arg_max(model, cv_score) FROM board)) "
    "SELECT id, class, " + rnd("avg(p)", "p", 9) + " FROM (FROM v UNION ALL FROM u UNION ALL FROM b) GROUP BY id, class",
)
def nested_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    """A vote over the weighted vote, the plain vote and the best single model."""
    long = _long(spark, sf)
    scores = board(long)
    best = scores.agg(F.max_by("model", "cv_score")).first()[0]
    parts = [
        ensemble.soft_vote(long, "id", ensemble.vote_weights(scores), "weighted"),
        ensemble.soft_vote(long, "id", None, "plain"),
        long.where(F.col("model") == best).select("id", "model", "class", "p"),
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return ensemble.soft_vote(stacked, "id").select("id", "class", rounded("p", digits=9))


@query(
    "leaderboard",
    PROBS + _HITS + "SELECT model, " + rnd("cv_score", "cv_score") + ", " + rnd("holdout_acc", "holdout_acc")
    + ", CAST(row_number() OVER (ORDER BY holdout_acc DESC, model) AS INTEGER) AS rank FROM board",
)
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ensemble.leaderboard(board(_long(spark, sf)))
    return ranked.select("model", rounded("cv_score"), rounded("holdout_acc"), "rank")


@query(
    "qualify_models",
    PROBS + _HITS + "SELECT model, " + rnd("cv_score", "cv_score") + ", model = (SELECT arg_max(model, holdout_acc) FROM board WHERE cv_score >= 0.72) AS is_best "
    "FROM board WHERE cv_score >= 0.72",
)
def qualify_models(spark: SparkSession, sf: str) -> DataFrame:
    return ensemble.qualify_models(board(_long(spark, sf)), 0.72).select("model", rounded("cv_score"), "is_best")


def _held(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all models on all rows, cut to whole thousandths, so that rows share scores."""
    return _long(spark, sf).withColumn("p", F.floor(F.col("p") * 1000) / 1000)


_CUT = PROBS + ", cut AS (SELECT id, model, class, y, floor(p * 1000) / 1000 AS p FROM probs) "
_CURVES = _CUT + (
    ", g AS (SELECT model, class, p, count(*) AS w, count(*) FILTER (WHERE y = class) AS h FROM cut GROUP BY model, class, p), "
    "c AS (SELECT model, class, p, row_number() OVER o AS i, sum(w) OVER o AS w_to, sum(h) OVER o AS h_to, sum(w) OVER o - w AS w_from, sum(h) OVER o - h AS h_from "
    "FROM g WINDOW o AS (PARTITION BY model, class ORDER BY p)), "
    "m AS (SELECT a.model, a.class, a.i AS j, b.i AS i, min((b.h_to - a.h_from) / (b.w_to - a.w_from)) OVER (PARTITION BY a.model, a.class, a.i ORDER BY b.i DESC) AS least "
    "FROM c a JOIN c b ON a.model = b.model AND a.class = b.class AND a.i <= b.i), "
    "f AS (SELECT model, class, i, max(least) AS fitted FROM m GROUP BY model, class, i), "
    "curve AS (SELECT c.model, c.class, c.p, f.fitted FROM f JOIN c ON f.model = c.model AND f.class = c.class AND f.i = c.i) "
)


@query("isotonic_curve", _CURVES + f"SELECT model, class, {rnd('p', 'p', 9)}, {rnd('fitted', 'fitted')} FROM curve")
def isotonic_curve(spark: SparkSession, sf: str) -> DataFrame:
    """The monotone curve of each model and class at its own scores: greatest over starts of the least mean over ends."""
    held = _held(spark, sf).persist()
    scores = held.select("model", "class", "p").distinct()
    fitted = calibrate.apply_isotonic(calibrate.fit_isotonic(held), scores.withColumn("score", F.col("p")), "score")
    return fitted.select("model", "class", rounded("score", "p", 9), rounded("p", "fitted"))


@query(
    "isotonic_calibration",
    _CURVES + ", t AS (SELECT cut.id, cut.model, cut.class, curve.fitted, sum(curve.fitted) OVER (PARTITION BY cut.id, cut.model) AS total "
    "FROM cut JOIN curve ON cut.model = curve.model AND cut.class = curve.class AND cut.p = curve.p) "
    f"SELECT id, model, class, {rnd('CASE WHEN total > 0 THEN fitted / total ELSE 1.0 / 3 END', 'p')} FROM t",
)
def isotonic_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """Curves of three models, fitted on all rows and applied to all rows."""
    held = _held(spark, sf).persist()
    done = calibrate.isotonic_calibration(held, held, "id", 3, min_rows=1)
    return done.select("id", "model", "class", rounded("p"))


@query(
    "sigmoid_calibration",
    PROBS + ", two AS (SELECT id, model, class, y, CASE WHEN p >= 0.34 THEN 0.75 ELSE 0.25 END AS p FROM probs), "
    "s AS (SELECT model, class, p, avg(CASE WHEN y = class THEN 1.0 ELSE 0.0 END) AS share FROM two GROUP BY model, class, p), "
    "t AS (SELECT two.id, two.model, two.class, s.share, sum(s.share) OVER (PARTITION BY two.id, two.model) AS total "
    "FROM two JOIN s ON two.model = s.model AND two.class = s.class AND two.p = s.p) "
    f"SELECT id, model, class, {rnd('share / total', 'p', 3)} FROM t",
)
def sigmoid_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """On scores of two values a logistic curve passes through the shares of both."""
    two = _long(spark, sf).withColumn("p", F.when(F.col("p") >= 0.34, 0.75).otherwise(0.25)).persist()
    done = calibrate.sigmoid_calibration(two, two, "id", 3, min_rows=1)
    return done.select("id", "model", "class", rounded("p", digits=3))


# The curve is fitted on the full scores of the first fold, and applied to the rows of all other folds.
_FULL = PROBS + (
    ", g AS (SELECT model, class, p, count(*) AS w, count(*) FILTER (WHERE y = class) AS h FROM probs WHERE fold = 0 GROUP BY model, class, p), "
    "c AS (SELECT model, class, p, row_number() OVER o AS i, sum(w) OVER o AS w_to, sum(h) OVER o AS h_to, sum(w) OVER o - w AS w_from, sum(h) OVER o - h AS h_from "
    "FROM g WINDOW o AS (PARTITION BY model, class ORDER BY p)), "
    "m AS (SELECT a.model, a.class, a.i AS j, b.i AS i, min((b.h_to - a.h_from) / (b.w_to - a.w_from)) OVER (PARTITION BY a.model, a.class, a.i ORDER BY b.i DESC) AS least "
    "FROM c a JOIN c b ON a.model = b.model AND a.class = b.class AND a.i <= b.i), "
    "f AS (SELECT model, class, i, max(least) AS fitted FROM m GROUP BY model, class, i), "
    "curve AS (SELECT c.model, c.class, c.p, f.fitted FROM f JOIN c ON f.model = c.model AND f.class = c.class AND f.i = c.i), "
    "rest AS (SELECT id, y, model, class, p FROM probs WHERE fold <> 0), "
    "below AS (SELECT r.*, k.p AS low, k.fitted AS low_fitted FROM rest r ASOF LEFT JOIN curve k ON r.model = k.model AND r.class = k.class AND r.p >= k.p), "
    "sides AS (SELECT b.*, k.p AS high, k.fitted AS high_fitted FROM below b ASOF LEFT JOIN curve k ON b.model = k.model AND b.class = k.class AND b.p <= k.p), "
    "moved AS (SELECT id, y, model, class, p AS raw, CASE WHEN low IS NULL THEN high_fitted WHEN high IS NULL OR high = low THEN low_fitted "
    "ELSE low_fitted + (high_fitted - low_fitted) * (p - low) / (high - low) END AS fitted FROM sides), "
    "done AS (SELECT *, CASE WHEN sum(fitted) OVER (PARTITION BY id, model) > 0 THEN fitted / sum(fitted) OVER (PARTITION BY id, model) ELSE 1.0 / 3 END AS p FROM moved) "
)


def _full(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The rows of all folds but the first, and the same with scores calibrated on the first."""
    long = _long(spark, sf)
    rest = long.where("fold <> 0")
    return rest, calibrate.isotonic_calibration(long.where("fold = 0"), rest, "id", 3)


@query("isotonic_full_scores", _FULL + "SELECT id, model, class, " + rnd("p", "p") + " FROM done")
def isotonic_full_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _full(spark, sf)[1].select("id", "model", "class", rounded("p"))


def _losses(p: str, when: str) -> str:
    cut = f"least(greatest({p}, 1e-15), 1 - 1e-15)"
    hit = "CASE WHEN y = class THEN 1.0 ELSE 0.0 END"
    return (
        rnd(f"avg(-({hit} * ln({cut}) + (1 - {hit}) * ln(1 - {cut})))", f"log_loss_{when}", 5) + ", "
        + rnd(f"avg(({p} - {hit}) * ({p} - {hit}))", f"brier_{when}", 5)
    )


@query("calibration_gain", _FULL + f"SELECT model, class, {_losses('raw', 'before')}, {_losses('p', 'after')} FROM done GROUP BY model, class")
def calibration_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Log loss and Brier score of scores that were not fitted, before and after calibration."""
    before, after = _full(spark, sf)
    after = after.join(before.select("id", "model", "class", "y"), ["id", "model", "class"])
    gain = calibrate.calibration_gain(before, after, F.col("y") == F.col("class"))
    return gain.select("model", "class", *[rounded(f"{m}_{w}", digits=5) for m in ("log_loss", "brier") for w in ("before", "after")])


@query(
    "sigmoid_optimum",
    PROBS + "SELECT model, class, count(*) AS n, 0.0::DOUBLE AS residual, 0.0::DOUBLE AS moment FROM probs WHERE fold = 0 GROUP BY model, class",
)
def sigmoid_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """At the optimum of a logistic curve over full scores the residuals, and their products with the score, sum to nothing."""
    held = _long(spark, sf).where("fold = 0")
    fitted = calibrate.fit_sigmoids(held, calibrate.enough_rows(held, 1), 3)
    slope, base = (
        F.coalesce(*[F.when((F.col("model") == m) & (F.col("class") == c), F.lit(of[i])) for (m, c), of in fitted.items()]) for i in (0, 1)
    )
    told = held.withColumn("_gap", (F.col("y") == F.col("class")).cast("double") - 1 / (1 + F.exp(-(F.col("p") * slope + base))))
    return told.groupBy("model", "class").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("_gap"), "residual", 4), rounded(F.avg(F.col("_gap") * F.col("p")), "moment", 4)
    )
