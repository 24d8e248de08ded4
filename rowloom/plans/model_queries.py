"""Models, cross-validation, selection and reduction on orders and embeddings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import dates
from rowloom.functions.text import TITLE_KEYWORDS
from rowloom.operators import boosting, ensemble, models, reduce, select, splits
from rowloom.operators.preparation import FeaturePreparation
from rowloom.operators.profile import block_corr_with_target
from rowloom.plans import fixtures as fx
from rowloom.plans import lifecycle
from rowloom.plans.registry import query, rnd, rounded
from rowloom.session import durable, shared_path, small_methods
from rowloom.sources.files import read_csv, table, write_parquet

K = 3
NUMERIC = ["o_totalprice", "c_acctbal", "month_sin", "month_cos", "year"]
BOOLEAN = ["is_large"]
CATEGORICAL = ["c_mktsegment"]


def _engineer(df: DataFrame) -> DataFrame:
    sin, cos = dates.cyclic_month(F.month("o_orderdate"))
    return df.select(
        "o_orderkey", "o_totalprice", "c_acctbal", sin.alias("month_sin"), cos.alias("month_cos"),
        F.year("o_orderdate").cast("double").alias("year"), (F.col("o_totalprice") > 250000).alias("is_large"),
        "c_mktsegment", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"),
    )


def feature_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test orders as (o_orderkey, y, features); everything fitted on train only."""
    train, test = (_engineer(p) for p in fx.order_parts(spark, sf))
    fitted = FeaturePreparation(NUMERIC, CATEGORICAL, BOOLEAN).fit(train)
    # Spread evenly before the many passes of a fit, whatever the layout of the files.
    return fitted.assemble(train).repartition("o_orderkey").persist(), fitted.assemble(test), fitted.names


def _predictions(spark: SparkSession, sf: str, fit: models.Fit) -> DataFrame:
    train, test, _ = feature_tables(spark, sf)
    scored = fit(train, K).score(test)
    return scored.select("o_orderkey", "y", "prediction", *[F.get("probs", F.lit(c)).alias(f"p{c}") for c in range(K)])


# Name of the query -> the classifier it fits on train orders and scores on test orders.
CLASSIFIERS = {
    "random_forest": lambda: models.random_forest(trees=20, depth=5),
    "gradient_boosting": lambda: models.gradient_boosting(rounds=5),
    "adaboost_samme": lambda: models.adaboost(rounds=6),
    "logistic": lambda: models.logistic(),
    "mlp": lambda: models.mlp(iterations=30),
    "linear_svc": lambda: models.linear_svc(iterations=20),
}


def _register(name: str) -> None:
    @query(name)
    def classify(spark: SparkSession, sf: str) -> DataFrame:
        return _predictions(spark, sf, CLASSIFIERS[name]())


for _name in CLASSIFIERS:
    _register(_name)


def _folded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    train, test, names = feature_tables(spark, sf)
    # Many fits read the folds: their plan ends here.
    return durable(splits.stratified_kfold(train, "o_orderkey", "y", 3)), test, names


@query(
    "oof_predict_logistic",
    f"WITH {fx.PARTS_SQL} SELECT CAST(part AS VARCHAR) AS part, o_orderkey, CAST(class AS INTEGER) AS class, TRUE AS valid FROM "
    "(SELECT 'train' AS part, o_orderkey FROM train UNION ALL SELECT 'test', o_orderkey FROM test) CROSS JOIN (VALUES (0), (1), (2)) c(class)",
)
def oof_predict_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Every train and test row gets one probability per class; the values depend on the fit."""
    train, test, _ = _folded(spark, sf)
    held, tested = models.oof_predict(train, models.logistic(), K, "o_orderkey", "logistic", test, 3)
    columns = [F.col("o_orderkey"), F.col("class"), F.col("p").between(0, 1).alias("valid")]
    return held.select(F.lit("train").alias("part"), *columns).unionByName(tested.select(F.lit("test").alias("part"), *columns))


@query("cross_validate")
def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    train, _, _ = _folded(spark, sf)
    parts = None
    for name, fit in (("logistic", models.logistic()), ("random_forest", models.random_forest(trees=10, depth=4))):
        held, _ = models.oof_predict(train, fit, K, "o_orderkey", name, folds=3)
        parts = held if parts is None else parts.unionByName(held)
    return models.cv_score(models.fold_accuracy(parts, "o_orderkey", K))


@query("param_search")
def param_search(spark: SparkSession, sf: str) -> DataFrame:
    train, _, _ = _folded(spark, sf)
    grid = models.random_grid({"c": [0.1, 1.0, 10.0], "l1_ratio": [0.0, 0.5], "iterations": [20]}, 6)
    return models.param_search(train, models.logistic, grid, K, "o_orderkey", folds=3)


def _price_bands(step: float) -> models.Fit:
    """A rule without training: the class is the price band."""

    def fit(df: DataFrame, k: int) -> models.Fitted:
        band = F.least(F.floor(F.element_at(vector_to_array("features"), 1) / step), F.lit(k - 1))
        one_hot = F.array(*[(band == c).cast("double") for c in range(k)])
        return models.Fitted(k, lambda table_: table_.withColumn("probs", one_hot))

    return fit


_HIGH = "o_totalprice > 150000"
_FOLDS = "(row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1) % 3 AS fold"


def _shares_by_side(df: DataFrame, k: int) -> models.Fitted:
    """A fit with known result: the class shares of the given rows below and above a price."""
    high = F.element_at(vector_to_array("features"), 1) > 150000
    seen = {(r["high"], r["y"]): r["n"] for r in df.groupBy(high.alias("high"), "y").agg(F.count(F.lit(1)).alias("n")).collect()}

    def shares(side: bool):
        total = sum(seen.get((side, c), 0) for c in range(k)) or 1
        return F.array(*[F.lit(seen.get((side, c), 0) / total) for c in range(k)])

    return models.Fitted(k, lambda t: t.withColumn("probs", F.when(high, shares(True)).otherwise(shares(False))))


@query(
    "oof_predict",
    f"WITH {fx.PARTS_SQL}, t AS (SELECT o_orderkey, {fx.STATUS_CODE} AS y, {_HIGH} AS high FROM train), f AS (SELECT *, {_FOLDS} FROM t), "
    "k AS (SELECT CAST(class AS INTEGER) AS class FROM (VALUES (0), (1), (2)) k(class)), "
    "n AS (SELECT fold, high, y, count(*) AS n FROM f GROUP BY ALL), "
    "s AS (SELECT g.fold, n.high, k.class, sum(CASE WHEN n.y = k.class THEN n.n ELSE 0 END) / sum(n.n) AS p "
    "FROM (SELECT DISTINCT fold FROM f) g JOIN n ON g.fold <> n.fold CROSS JOIN k GROUP BY g.fold, n.high, k.class) "
    "SELECT 'train' AS part, f.o_orderkey, s.class, " + rnd("s.p", "p", 9) + " FROM f JOIN s ON f.fold = s.fold AND f.high = s.high "
    "UNION ALL SELECT 'test', test.o_orderkey, s.class, " + rnd("avg(s.p)", "p", 9) + f" FROM test JOIN s ON ({_HIGH}) = s.high GROUP BY test.o_orderkey, s.class",
)
def oof_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Each train row by the model that has not seen its fold, each test row by the mean of all fold models."""
    train, test = (
        p.select("o_orderkey", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"), array_to_vector(F.array("o_totalprice")).alias("features"))
        for p in fx.order_parts(spark, sf)
    )
    folded = splits.stratified_kfold(train, "o_orderkey", "y", 3)
    held, tested = models.oof_predict(folded, _shares_by_side, K, "o_orderkey", "shares", test, 3)
    columns = [F.col("o_orderkey"), F.col("class"), rounded("p", digits=9)]
    return held.select(F.lit("train").alias("part"), *columns).unionByName(tested.select(F.lit("test").alias("part"), *columns))


_FLAG = "CASE WHEN (o_orderstatus = 'F') <> (o_orderkey % 4 = 0) THEN 1e0 ELSE 0e0 END"


@query(
    "model_store",
    f"WITH {fx.PARTS_SQL}, s AS (SELECT {_FLAG} AS flag, " + ", ".join(f"avg(CASE WHEN {fx.STATUS_CODE} = {c} THEN 1.0 ELSE 0.0 END) AS s{c}" for c in range(K))
    + f" FROM train GROUP BY 1), t AS (SELECT o_orderkey, {_FLAG} AS flag FROM test) "
    "SELECT o_orderkey, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS prediction, "
    + ", ".join(rnd(f"s{c}", f"p{c}") for c in range(K)) + " FROM t JOIN s ON t.flag = s.flag",
)
def model_store(spark: SparkSession, sf: str) -> DataFrame:
    """A tree of one split on a flag, fitted on train, stored, read back, and applied to test: the shares of both sides."""
    train, test = (
        p.select("o_orderkey", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"), array_to_vector(F.array(F.expr(_FLAG))).alias("features"))
        for p in fx.order_parts(spark, sf)
    )
    fitted = models.random_forest(trees=1, depth=1, subset="all", bootstrap=False)(train, K)
    stored = fitted.write(spark, shared_path(spark, "model"))
    scored = models.load_fitted(spark, stored).score(test)
    return scored.select("o_orderkey", "prediction", *[rounded(F.get("probs", F.lit(c)), f"p{c}") for c in range(K)])


_STEPS = [50000.0, 100000.0, 150000.0, 200000.0]


@query(
    "param_search_rule",
    f"WITH o AS (SELECT o_orderkey, o_totalprice, {fx.STATUS_CODE} AS y FROM orders), "
    "f AS (SELECT *, (row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1) % 3 AS fold FROM o), "
    "t AS (" + " UNION ALL ".join(f"SELECT {i} AS trial, 'step={s}' AS params, CAST({s} AS DOUBLE) AS step" for i, s in enumerate(_STEPS)) + "), "
    "a AS (SELECT trial, params, fold, avg(CASE WHEN least(floor(o_totalprice / step), 2) = y THEN 1 ELSE 0 END) AS accuracy FROM f CROSS JOIN t GROUP BY trial, params, fold), "
    "s AS (SELECT trial, params, avg(accuracy) AS score FROM a GROUP BY trial, params) "
    "SELECT trial, params, " + rnd("score", "score") + ", trial = (SELECT arg_max(trial, score) FROM s) AS best FROM s",
)
def param_search_rule(spark: SparkSession, sf: str) -> DataFrame:
    """The search itself, over a rule whose CV accuracy is known."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"), array_to_vector(F.array("o_totalprice")).alias("features")
    )
    folded = splits.stratified_kfold(orders, "o_orderkey", "y", 3)
    trials = models.param_search(folded, _price_bands, [{"step": s} for s in _STEPS], K, "o_orderkey", folds=3)
    return trials.select("trial", "params", rounded("score"), "best")


_U = "CAST('0x' || substr(md5('42:' || i || ':step'), 1, 8) AS BIGINT) / 4294967296"


@query(
    "range_search_rule",
    f"WITH RECURSIVE o AS (SELECT o_orderkey, o_totalprice, {fx.STATUS_CODE} AS y FROM orders), "
    "f AS (SELECT *, (row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1) % 3 AS fold FROM o), "
    f"t AS (SELECT CAST(i AS INTEGER) AS trial, 20000 * pow(20, {_U}) AS step FROM range(10) r(i)), "
    "a AS (SELECT trial, step, fold, avg(CASE WHEN least(floor(o_totalprice / step), 2) = y THEN 1 ELSE 0 END) AS accuracy FROM f CROSS JOIN t GROUP BY trial, step, fold), "
    "m AS (SELECT trial, step, max(accuracy) FILTER (WHERE fold = 0) AS m1, avg(accuracy) FILTER (WHERE fold < 2) AS m2, avg(accuracy) AS m3 FROM a GROUP BY trial, step), "
    "s AS (SELECT trial, step, m1, m2, m3, 3 AS folds_done, m1 AS b1, m2 AS b2, m3 AS b3 FROM m WHERE trial = 0 UNION ALL "
    "SELECT trial, step, m1, m2, m3, folds_done, CASE WHEN gain THEN m1 ELSE b1 END, CASE WHEN gain THEN m2 ELSE b2 END, CASE WHEN gain THEN m3 ELSE b3 END "
    "FROM (SELECT *, folds_done = 3 AND m3 > b3 AS gain FROM (SELECT m.*, CASE WHEN m.m1 < s.b1 - 0.005 THEN 1 WHEN m.m2 < s.b2 - 0.005 THEN 2 ELSE 3 END AS folds_done, b1, b2, b3 "
    "FROM s JOIN m ON m.trial = s.trial + 1))) "
    "SELECT trial, " + rnd("step", "step", 3) + ", CAST(folds_done AS INTEGER) AS folds_done, " + rnd("CASE WHEN folds_done = 3 THEN m3 END", "score")
    + ", trial = (SELECT arg_max(trial, (m3, -trial)) FROM s WHERE folds_done = 3) AS best, 0 AS fitted_again FROM s",
)
def range_search_rule(spark: SparkSession, sf: str) -> DataFrame:
    """A search over a logarithmic range, broken off after four trials and continued; a third run of it fits nothing."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"), array_to_vector(F.array("o_totalprice")).alias("features")
    )
    folded = splits.stratified_kfold(orders, "o_orderkey", "y", 3)
    store, space, made = shared_path(spark, "trials"), {"step": ("log", 20000.0, 400000.0)}, []

    def make(step: float) -> models.Fit:
        made.append(step)
        return _price_bands(step)

    for trials in (4, 10):
        models.range_search(folded, make, space, trials, K, store, hopeless=0.005)
    before = len(made)
    found = models.range_search(folded, make, space, 10, K, store, hopeless=0.005)
    return found.select(
        "trial", rounded(F.get_json_object("params", "$.step").cast("double"), "step", 3), F.size("accuracies").alias("folds_done"),
        rounded("score"), "best", F.lit(len(made) - before).alias("fitted_again"),
    )


@query("stacking")
def stacking(spark: SparkSession, sf: str) -> DataFrame:
    """Two base models out of fold, a logistic meta-learner, and its probabilities on test rows."""
    train, test, _ = _folded(spark, sf)
    fits = {"logistic": models.logistic(), "random_forest": models.random_forest(trees=10, depth=4)}
    held, tested = None, None
    for name, fit in fits.items():
        a, b = models.oof_predict(train, fit, K, "o_orderkey", name, test, 3)
        held = a if held is None else held.unionByName(a)
        tested = b if tested is None else tested.unionByName(b)
    held, tested = durable(held), durable(tested)
    names = list(fits)
    meta = ensemble.fit_stacking(held, "o_orderkey", names, K, models.logistic())
    scored = meta.score(ensemble.level_one(tested, "o_orderkey", names, K))
    return scored.select("o_orderkey", "prediction", *[F.get("probs", F.lit(c)).alias(f"p{c}") for c in range(K)])


def _shares_by_call(df: DataFrame, k: int) -> models.Fitted:
    """A second level with known result: the class shares of the rows that the second model calls alike."""
    call = models.argmax(F.slice(vector_to_array("features"), k + 1, k))
    counts = df.groupBy(call.alias("call"), "y").agg(F.count(F.lit(1)).alias("n")).collect()  # k * k rows at most
    sums = [sum(r["n"] for r in counts if r["call"] == c) for c in range(k)]
    shares = [[sum(r["n"] for r in counts if r["call"] == c and r["y"] == y) / max(sums[c], 1) for y in range(k)] for c in range(k)]
    table_ = F.array(*[F.array(*[F.lit(v) for v in row]) for row in shares])
    return models.Fitted(k, lambda t: t.withColumn("probs", F.get(table_, call)))


@query(
    "stacking_rule",
    f"WITH {fx.PROBS_SQL}, {fx.CALLS_SQL.removeprefix(fx.PROBS_SQL + ', ')}, "
    "shares AS (SELECT p, " + ", ".join(f"avg(CASE WHEN y = {c} THEN 1 ELSE 0 END) AS s{c}" for c in range(K)) + " FROM calls GROUP BY p) "
    "SELECT id, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS prediction, "
    + ", ".join(rnd(f"s{c}", f"p{c}") for c in range(K)) + " FROM calls JOIN shares USING (p)",
)
def stacking_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Level one of three models, and a second level whose probabilities are known."""
    held = fx.pseudo_probabilities(spark, sf)
    names = sorted(fx.MODEL_BONUS)
    meta = ensemble.fit_stacking(held, "id", names, K, _shares_by_call)
    scored = meta.score(ensemble.level_one(held, "id", names, K))
    return scored.select("id", "prediction", *[rounded(F.get("probs", F.lit(c)), f"p{c}") for c in range(K)])


def _forest(spark: SparkSession, sf: str) -> tuple[models.Fitted, DataFrame, DataFrame, list[str]]:
    train, test, names = feature_tables(spark, sf)
    weights = splits.balanced_class_weight(train, "y")
    weighted = splits.apply_class_weight(train, weights, "y")
    return models.random_forest(trees=15, depth=5)(weighted, K), train, test, names


@query("importance_table")
def importance_table(spark: SparkSession, sf: str) -> DataFrame:
    fitted, train, _, names = _forest(spark, sf)
    return select.importance_table(fitted, names, train)


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    """Correlation with the class as a score of the slots of the embeddings."""
    scores = block_corr_with_target(fx.vectors(spark, sf), "vec", "label")
    return scores.select("slot", F.concat(F.lit("x"), F.col("slot")).alias("feature"), F.round("abs_corr", 9).alias("importance"))


_CORR = (
    f"WITH {fx.VECTORS_SQL}, s AS (SELECT CAST(i - 1 AS INTEGER) AS slot, 'x' || CAST(i - 1 AS VARCHAR) AS feature, "
    "round(abs(corr(vec[i], label)), 9) AS importance FROM vectors, unnest(generate_series(1, 64)) t(i) GROUP BY i) "
)


@query("select_by_importance", _CORR + "SELECT slot, feature, " + rnd("importance", "importance") + " FROM s WHERE importance >= (SELECT avg(importance) FROM s)")
def select_by_importance(spark: SparkSession, sf: str) -> DataFrame:
    kept = select.select_by_importance(_scores(spark, sf), "mean")
    return kept.select("slot", "feature", rounded("importance"))


@query("select_topn", _CORR + "SELECT slot, feature, " + rnd("importance", "importance") + " FROM s ORDER BY s.importance DESC, slot LIMIT 12")
def select_topn(spark: SparkSession, sf: str) -> DataFrame:
    return select.select_topn(_scores(spark, sf), 12).select("slot", "feature", rounded("importance"))


# A linear rule per class over three order features, as a model with known output.
RULE = {0: (0.8, -0.4, 0.1), 1: (-0.2, 0.5, 0.3), 2: (0.1, 0.2, -0.6)}
RULE_FEATURES = ("o_totalprice / 500000", "o_custkey % 100 / 100e0", "month(o_orderdate) / 12e0")


def _rule_model() -> models.Fitted:
    def add(df: DataFrame) -> DataFrame:
        # A column of its own, or the vector is unpacked again for each of the nine products.
        own = df.withColumn("_x", vector_to_array("features"))
        logits = [sum((F.get("_x", F.lit(i)) * w for i, w in enumerate(ws)), F.lit(0.0)) for ws in RULE.values()]
        return models.with_shares(own, F.array(*[F.exp(z) for z in logits]), K).drop("_x")

    return models.Fitted(K, add)


def _rule_class(x: list[str]) -> str:
    logits = [" + ".join(f"({w} * {x[i]})" for i, w in enumerate(ws)) for ws in RULE.values()]
    a, b, c = (f"exp({z})" for z in logits)
    return f"CASE WHEN {a} >= {b} AND {a} >= {c} THEN 0 WHEN {b} >= {c} THEN 1 ELSE 2 END"


def _hash_place(seed: str) -> str:
    return f"row_number() OVER (ORDER BY md5(concat_ws(':', '{seed}', CAST(o_orderkey AS VARCHAR))), o_orderkey)"


_LOST = ", ".join(
    "avg(CASE WHEN " + _rule_class([f"b.x{i}" if i == s else f"a.x{i}" for i in range(3)]) + f" = a.y THEN 1 ELSE 0 END) AS h{s}"
    for s in range(3)
)


@query(
    "permutation_importance",
    f"WITH f AS (SELECT o_orderkey, {fx.STATUS_CODE} AS y, " + ", ".join(f"CAST({e} AS DOUBLE) AS x{i}" for i, e in enumerate(RULE_FEATURES)) + " FROM orders), "
    f"a AS (SELECT *, {_hash_place('42')} AS place FROM f), "
    f"b AS (SELECT *, 0 AS r, {_hash_place('42/0')} AS place FROM f UNION ALL SELECT *, 1, {_hash_place('42/1')} FROM f), "
    f"h AS (SELECT r, {_LOST} FROM a JOIN b USING (place) GROUP BY r), "
    f"base AS (SELECT avg(CASE WHEN {_rule_class(['x0', 'x1', 'x2'])} = y THEN 1 ELSE 0 END) AS acc FROM f), "
    "l AS (" + " UNION ALL ".join(f"SELECT {s} AS slot, 'x{s}' AS feature, (SELECT acc FROM base) - h{s} AS lost FROM h" for s in range(3)) + ") "
    "SELECT slot, feature, " + rnd("avg(lost)", "importance_mean") + ", " + rnd("stddev_pop(lost)", "importance_std") + " FROM l GROUP BY slot, feature",
)
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy that a known rule loses on all orders when one of its features is shuffled."""
    features = [F.expr(f"CAST({e} AS DOUBLE)") for e in RULE_FEATURES]
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"), array_to_vector(F.array(*features)).alias("features")
    )
    out = select.permutation_importance(_rule_model(), df, "o_orderkey", ["x0", "x1", "x2"], repeats=2)
    return out.select("slot", "feature", rounded("importance_mean"), rounded("importance_std"))


@query("permutation_importance_forest")
def permutation_importance_forest(spark: SparkSession, sf: str) -> DataFrame:
    fitted, _, test, names = _forest(spark, sf)
    return select.permutation_importance(fitted, test, "o_orderkey", names, repeats=2)


@query("rfe_cv")
def rfe_cv(spark: SparkSession, sf: str) -> DataFrame:
    train, _, names = _folded(spark, sf)
    return select.rfe_cv(train, models.logistic(iterations=20), K, "o_orderkey", names, folds=2, step=0.4)


_MODULI = [3, 5, 7, 11, 13, 17]
_KEPT = [[0, 1, 2, 3, 4, 5], [2, 3, 4, 5], [3, 4, 5], [4, 5]]


def _sum_rule(df: DataFrame, k: int) -> models.Fitted:
    """A rule on whichever features are left: their sum modulo k; a feature's mean is its importance."""
    x = vector_to_array("features")
    width = len(df.select(x.alias("x")).first()["x"])
    means = df.agg(*[F.avg(F.get(x, F.lit(i))).alias(f"m{i}") for i in range(width)]).first()
    code = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) % k
    return models.Fitted(k, lambda t: t.withColumn("probs", F.array(*[(code == c).cast("double") for c in range(k)])), [float(m) for m in means])


@query(
    "rfe_cv_rule",
    f"WITH o AS (SELECT o_orderkey % 2 AS fold, {fx.STATUS_CODE} AS y, " + ", ".join(f"o_orderkey % {m} AS x{i}" for i, m in enumerate(_MODULI)) + " FROM orders), "
    "a AS (" + " UNION ALL ".join(
        f"SELECT {len(kept)} AS n_features, '{','.join(f'x{i}' for i in kept)}' AS features, fold, "
        f"avg(CASE WHEN ({' + '.join(f'x{i}' for i in kept)}) % 3 = y THEN 1 ELSE 0 END) AS accuracy FROM o GROUP BY fold" for kept in _KEPT
    ) + "), s AS (SELECT n_features, features, avg(accuracy) AS score FROM a GROUP BY n_features, features) "
    "SELECT n_features, features, " + rnd("score", "cv_accuracy") + ", n_features = (SELECT arg_max(n_features, (score, -n_features)) FROM s) AS best FROM s",
)
def rfe_cv_rule(spark: SparkSession, sf: str) -> DataFrame:
    """The elimination itself, over a rule whose importances and CV accuracies are known."""
    x = F.array(*[(F.col("o_orderkey") % m).cast("double") for m in _MODULI])
    folded = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(f"CAST({fx.STATUS_CODE} AS INT)").alias("y"), (F.col("o_orderkey") % 2).cast("int").alias("fold"), array_to_vector(x).alias("features")
    )
    names = [f"x{i}" for i in range(len(_MODULI))]
    steps = select.rfe_cv(folded, _sum_rule, K, "o_orderkey", names, folds=2, floor=2, step=0.4)
    return steps.select("n_features", F.array_join("features", ",").alias("features"), rounded("cv_accuracy"), "best")


@query("pca")
def pca(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all embeddings on 15 components."""
    df = fx.vectors(spark, sf)
    return df.select("id", reduce.project(reduce.fit_pca(df, "vec", 15), "vec").alias("scores"))


@query(
    "pca_total_variance",
    f"WITH {fx.VECTORS_SQL}, v AS (SELECT var_samp(vec[i]) AS s FROM vectors, unnest(generate_series(1, 64)) t(i) GROUP BY i) "
    "SELECT " + rnd("sum(s)", "total_variance") + ", " + rnd("CAST(1 AS DOUBLE)", "share") + " FROM v",
)
def pca_total_variance(spark: SparkSession, sf: str) -> DataFrame:
    """With all 64 components the scores keep the whole variance of the block, and the shares add up to 1."""
    df = fx.vectors(spark, sf)
    state = reduce.fit_pca(df, "vec", 64)
    scores = df.select(F.posexplode(reduce.project(state, "vec")).alias("component", "score"))
    spread = scores.groupBy("component").agg(F.var_samp("score").alias("s"))
    share = state.agg(F.sum("share")).first()[0]
    return spread.agg(F.sum("s").alias("total")).select(rounded("total", "total_variance"), rounded(F.lit(share), "share"))


@query("svd_total_energy", f"WITH {fx.VECTORS_SQL} SELECT " + rnd("sum(list_inner_product(vec, vec))", "energy", 4) + ", " + rnd("CAST(1 AS DOUBLE)", "share") + " FROM vectors")
def svd_total_energy(spark: SparkSession, sf: str) -> DataFrame:
    """With all 64 components the uncentred scores keep the whole sum of squares."""
    df = fx.vectors(spark, sf)
    state = reduce.fit_svd(df, "vec", 64)
    scores = df.select(F.explode(reduce.project(state, "vec")).alias("s"))
    share = state.agg(F.sum("share")).first()[0]
    return scores.agg(F.sum(F.col("s") * F.col("s")).alias("energy")).select(rounded("energy", digits=4), rounded(F.lit(share), "share"))


@query(
    "wide_total_variance",
    f"WITH {fx.VECTORS_SQL}, m AS (SELECT i, var_pop(vec[i]) AS v FROM vectors, unnest(generate_series(1, 64)) t(i) GROUP BY i) "
    "SELECT " + rnd("sum(v)", "variance") + ", " + rnd("CAST(1 AS DOUBLE)", "share") + " FROM m",
)
def wide_total_variance(spark: SparkSession, sf: str) -> DataFrame:
    """With as many directions as slots the range finder keeps all variance of the vectors."""
    df = fx.vectors(spark, sf)
    state = reduce.fit_wide(df, "vec", 64)
    spread = df.select(F.posexplode(reduce.project(state, "vec")).alias("i", "s")).groupBy("i").agg(F.var_pop("s").alias("v"))
    share = state.agg(F.sum("share")).first()[0]
    return spread.agg(F.sum("v").alias("variance")).select(rounded("variance"), rounded(F.lit(share), "share"))


@query("truncated_svd")
def truncated_svd(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.vectors(spark, sf)
    return df.select("id", reduce.project(reduce.fit_svd(df, "vec", 25), "vec").alias("scores"))


def _clusters(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.vectors(spark, sf)
    scores = df.select("id", reduce.project(reduce.fit_pca(df, "vec", 15), "vec").alias("scores")).persist()
    return reduce.apply_kmeans(reduce.fit_kmeans(scores, "scores", 15), scores, "scores")


@query("kmeans")
def kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return _clusters(spark, sf).select("id", "cluster")


@query(
    "kmeans_two_groups",
    f"WITH {fx.VECTORS_SQL}, m AS (SELECT id % 2 AS side, i, avg(vec[i] + (id % 2) * 1000) AS center, var_pop(vec[i]) * count(*) AS spread "
    "FROM vectors, unnest(generate_series(1, 64)) t(i) GROUP BY id % 2, i) "
    "SELECT CAST(side AS INTEGER) AS cluster, CAST(i - 1 AS INTEGER) AS slot, " + rnd("center", "center", 4) + ", "
    + rnd("(SELECT sum(spread) FROM m)", "inertia", 2) + " FROM m",
)
def kmeans_two_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Odd vectors moved far away: the centres are the means of both groups, the inertia their spread around them."""
    apart = fx.vectors(spark, sf).withColumn("vec", F.transform("vec", lambda x: x + (F.col("id") % 2) * 1000))
    model = reduce.fit_kmeans(apart, "vec", 2)
    centers = sorted((c.tolist() for c in model.clusterCenters()), key=lambda c: c[0])
    rows = [(g, i, float(x), float(model.summary.trainingCost)) for g, c in enumerate(centers) for i, x in enumerate(c)]
    found = spark.createDataFrame(rows, "cluster int, slot int, center double, inertia double")
    return found.select("cluster", "slot", rounded("center", digits=4), rounded("inertia", digits=2))


@query(
    "cluster_one_hot",
    "SELECT vec_id AS id, " + ", ".join(f"CASE WHEN vec_id % 4 = {i} THEN 1 ELSE 0 END AS cluster_{i}" for i in range(4)) + " FROM embeddings",
)
def cluster_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Flags of four groups that are moved far apart; clusters are numbered by their centres."""
    apart = fx.vectors(spark, sf).withColumn("vec", F.transform("vec", lambda x: x + (F.col("id") % 4) * 1000))
    model = reduce.fit_kmeans(apart, "vec", 4)
    place = {i: r for r, i in enumerate(sorted(range(4), key=lambda i: model.clusterCenters()[i][0]))}
    numbered = reduce.apply_kmeans(model, apart, "vec").replace(place, subset=["cluster"])
    return numbered.select("id", *reduce.cluster_flags(4))


def _whole_run(spark: SparkSession, sf: str, fits: dict[str, models.Fit], meta: models.Fit | None = None) -> DataFrame:
    """Written predictions of a run from the raw tables."""
    raw = [
        p.select(
            "o_orderkey", "o_totalprice", "c_acctbal", F.col("c_mktsegment").alias("title"), "o_orderpriority",
            (F.col("o_totalprice") > 250000).alias("is_large"), F.expr(fx.YEAR_MONTH).alias("posted"),
            F.array("o_totalprice", "c_acctbal", F.col("c_nationkey").cast("double")).alias("block"), "o_orderstatus",
        )
        for p in fx.order_parts(spark, sf)
    ]
    roles = lifecycle.Roles(
        key="o_orderkey", target="o_orderstatus", numeric=["o_totalprice", "c_acctbal"], categorical=["o_orderpriority"],
        boolean=["is_large"], title="title", date="posted", block="block", components=2,
    )
    done = lifecycle.run(raw[0], raw[1].drop("o_orderstatus"), roles, fits, shared_path(spark, "run"), folds=3, meta=meta)
    return read_csv(spark, done.predictions, "o_orderkey BIGINT, o_orderstatus STRING")


@query(
    "full_run",
    f"WITH {fx.PARTS_SQL} SELECT o_orderkey, TRUE AS known_label FROM test",
)
def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """Every step from raw tables to written predictions; one known label per test row."""
    fits = {"logistic": models.logistic(iterations=20), "random_forest": models.random_forest(trees=10, depth=4)}
    written = _whole_run(spark, sf, fits)
    return written.select("o_orderkey", F.col("o_orderstatus").isin("F", "O", "P").alias("known_label"))


def _slot_rule(strength: float) -> models.Fit:
    """A rule on prepared slots: urgent orders are P (code 2), other large ones O (1), all others F (0).

    Counted from the last slot: the title's flags, ``is_large``, the five priorities in order.
    """
    flags = len(TITLE_KEYWORDS["package"])

    def fit(df: DataFrame, k: int) -> models.Fitted:
        x = vector_to_array("features")
        large, urgent = F.element_at(x, -(flags + 1)) == 1, F.element_at(x, -(flags + 6)) == 1
        code = F.when(urgent, 2).when(large, 1).otherwise(0)
        probs = F.array(*[F.when(code == c, strength).otherwise((1 - strength) / (k - 1)) for c in range(k)])
        return models.Fitted(k, lambda t: t.withColumn("probs", probs))

    return fit


def _first_model(df: DataFrame, k: int) -> models.Fitted:
    """A rule for the second level: the probabilities of the first model."""
    x = vector_to_array("features")
    return models.Fitted(k, lambda t: t.withColumn("probs", F.slice(x, 1, k)))


@query(
    "full_run_rule",
    f"WITH {fx.PARTS_SQL} SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'P' WHEN o_totalprice > 250000 THEN 'O' "
    "ELSE 'F' END AS o_orderstatus FROM test",
)
def full_run_rule(spark: SparkSession, sf: str) -> DataFrame:
    """The run over rules of prepared slots: whichever of models, vote and stacking is best, the labels written are known."""
    return _whole_run(spark, sf, {"bold": _slot_rule(0.8), "calm": _slot_rule(0.5)}, _first_model)


# The label is a rule of the raw columns, which one tree on the prepared slots learns without error.
_RULE = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'P' WHEN o_totalprice > 250000 THEN 'O' ELSE 'F' END"


@query("stored_run", f"WITH {fx.PARTS_SQL} SELECT o_orderkey, {_RULE} AS kind FROM test")
def stored_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run fitted on train and stored; another session reads it and labels a file that the run never saw."""
    raw = [
        p.select(
            "o_orderkey", "o_totalprice", "c_acctbal", F.col("c_mktsegment").alias("title"), "o_orderpriority",
            (F.col("o_totalprice") > 250000).alias("is_large"), F.expr(fx.YEAR_MONTH).alias("posted"),
            F.array("o_totalprice", "c_acctbal", F.col("c_nationkey").cast("double")).alias("block"), F.expr(_RULE).alias("kind"),
        )
        for p in fx.order_parts(spark, sf)
    ]
    roles = lifecycle.Roles(
        key="o_orderkey", target="kind", numeric=["o_totalprice", "c_acctbal"], categorical=["o_orderpriority"],
        boolean=["is_large"], title="title", date="posted", block="block", components=2,
    )
    tree = {"tree": models.random_forest(trees=1, depth=3, subset="all", bootstrap=False)}
    file = write_parquet(raw[1].drop("kind"), shared_path(spark, "new-file"))
    done = lifecycle.run(raw[0], raw[0].drop("kind"), roles, tree, shared_path(spark, "run"), folds=2)
    fresh = spark.newSession()
    with small_methods(fresh):
        labels = lifecycle.StoredRun.read(fresh, done.stored).score(fresh.read.parquet(file))
        path = write_parquet(labels, shared_path(spark, "labels"))
    return spark.read.parquet(path).select("o_orderkey", "kind")


# Two flags of an order, and a class that follows from them with exceptions.
_FLAGS = (
    "WITH flags AS (SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS large, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent, "
    "CAST(CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 3 WHEN o_totalprice > 250000 THEN 1 WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 0 END AS INTEGER) AS y FROM orders)"
)


def _flags(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END").alias("large"),
        F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END").alias("urgent"),
        F.expr(
            "CAST(CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 3 WHEN o_totalprice > 250000 THEN 1 WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 0 END AS INT)"
        ).alias("y"),
    )
    return orders.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))).persist()


_SUMS = (
    ", g AS (SELECT f.*, c.class, 1.0 / 3 - CASE WHEN y = c.class THEN 1 ELSE 0 END AS g, 2.0 / 9 AS h FROM flags f CROSS JOIN (VALUES (0), (1), (2)) c(class)), "
    "s AS (SELECT class, slot, sum(g) AS ag, sum(h) AS ah, sum(CASE WHEN x = 0 THEN g ELSE 0 END) AS lg, sum(CASE WHEN x = 0 THEN h ELSE 0 END) AS lh "
    "FROM (SELECT class, g, h, 0 AS slot, large AS x FROM g UNION ALL SELECT class, g, h, 1, urgent FROM g) GROUP BY class, slot), "
    "b AS (SELECT *, lg * lg / (lh + 1) + (ag - lg) * (ag - lg) / (ah - lh + 1) - ag * ag / (ah + 1) AS gain FROM s "
    "QUALIFY row_number() OVER (PARTITION BY class ORDER BY round(gain, 9) DESC, slot) = 1), "
    "v AS (SELECT o_orderkey, class, CASE WHEN CASE slot WHEN 0 THEN large ELSE urgent END = 0 THEN -0.5 * lg / (lh + 1) ELSE -0.5 * (ag - lg) / (ah - lh + 1) END AS score FROM flags CROSS JOIN b) "
)


@query(
    "boosting_first_round",
    _FLAGS + _SUMS + "SELECT o_orderkey, CAST(class AS INTEGER) AS class, " + rnd("exp(score) / sum(exp(score)) OVER (PARTITION BY o_orderkey)", "p") + " FROM v",
)
def boosting_first_round(spark: SparkSession, sf: str) -> DataFrame:
    """All classes boosted at once: after one round of one cut each, probabilities have a closed form."""
    df = _flags(spark, sf, "large", "urgent")
    scored = boosting.boosting(rounds=1, depth=1, step=0.5)(df, K).score(df)
    return scored.select("o_orderkey", F.posexplode("probs").alias("class", "p")).select("o_orderkey", "class", rounded("p"))


@query("boosting")
def boosted(spark: SparkSession, sf: str) -> DataFrame:
    train, test, _ = feature_tables(spark, sf)
    scored = boosting.boosting(rounds=5, depth=3)(train, K).score(test)
    return scored.select("o_orderkey", "y", "prediction", *[F.get("probs", F.lit(c)).alias(f"p{c}") for c in range(K)])


@query(
    "importance_of_one_tree",
    _FLAGS + ", n AS (SELECT large, urgent, y, count(*) AS n FROM flags GROUP BY ALL), "
    "r AS (SELECT sum(n) * (1 - sum(n * n) / pow(sum(n), 2)) AS impure FROM (SELECT y, sum(n) AS n FROM n GROUP BY y)), "
    "l AS (SELECT sum(impure) AS impure FROM (SELECT large, sum(n) * (1 - sum(n * n) / pow(sum(n), 2)) AS impure FROM (SELECT large, y, sum(n) AS n FROM n GROUP BY large, y) GROUP BY large)), "
    "u AS (SELECT sum(impure) AS impure FROM (SELECT large, urgent, sum(n) * (1 - sum(n * n) / pow(sum(n), 2)) AS impure FROM n GROUP BY large, urgent)) "
    "SELECT 'large' AS feature, " + rnd("(r.impure - l.impure) / (r.impure - u.impure)", "importance", 3) + " FROM r, l, u UNION ALL "
    "SELECT 'urgent', round((l.impure - u.impure) / (r.impure - u.impure), 3) + 0.0 FROM r, l, u",
)
def importance_of_one_tree(spark: SparkSession, sf: str) -> DataFrame:
    """A tree that first parts by one flag and then by the other: importances are the impurity each takes away."""
    df = _flags(spark, sf, "large", "urgent")
    tree = models.random_forest(trees=1, depth=2, subset="all", bootstrap=False)(df, K)
    return select.importance_table(tree, ["large", "urgent"], df).select("feature", rounded("importance", digits=3))


@query("logistic_one_flag", _FLAGS + " SELECT large, y AS class, " + rnd("count(*) / sum(count(*)) OVER (PARTITION BY large)", "p", 2) + " FROM flags GROUP BY large, y")
def logistic_one_flag(spark: SparkSession, sf: str) -> DataFrame:
    """With one flag and hardly a penalty the fitted probabilities are the shares of the classes."""
    df = _flags(spark, sf, "large")
    scored = models.logistic(c=1e6, iterations=200)(df, K).score(df)
    return scored.select("large", F.posexplode("probs").alias("class", "p")).select("large", "class", rounded("p", digits=2)).distinct()


@query("adaboost_first_stage", _FLAGS + ", m AS (SELECT large, max(n) AS hit, sum(n) AS n FROM (SELECT large, y, count(*) AS n FROM flags GROUP BY large, y) GROUP BY large), "
       "e AS (SELECT 1 - sum(hit) / sum(n) AS e FROM m) SELECT " + rnd("ln((1 - e) / e) + ln(2)", "stage_weight") + " FROM e")
def adaboost_first_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The weight of a first stage of one cut, from the share of rows it gets wrong."""
    df = _flags(spark, sf, "large")
    weight = models.adaboost(rounds=1, depth=1)(df, K).weights[0]
    return spark.createDataFrame([(weight,)], "stage_weight double").select(rounded("stage_weight"))


@query("mlp_flags", _FLAGS + " SELECT large, urgent, arg_max(y, (n, -y)) AS prediction FROM (SELECT large, urgent, y, count(*) AS n FROM flags GROUP BY large, urgent, y) GROUP BY large, urgent")
def mlp_flags(spark: SparkSession, sf: str) -> DataFrame:
    """A network of two flags calls the larger class of each side."""
    df = _flags(spark, sf, "large", "urgent")
    return models.mlp(iterations=100)(df, K).score(df).select("large", "urgent", "prediction").distinct()


@query("linear_svc_separable", _FLAGS + " SELECT o_orderkey, large AS prediction FROM flags")
def linear_svc_separable(spark: SparkSession, sf: str) -> DataFrame:
    """Two sides that a line parts are called without error."""
    df = _flags(spark, sf, "large").withColumn("y", F.col("large"))
    return models.linear_svc()(df, 2).score(df).select("o_orderkey", "prediction")
