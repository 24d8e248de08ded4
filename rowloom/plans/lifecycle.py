"""From a train and a test table to written predictions, leaderboard and metadata, and a stored run that scores new files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import text
from rowloom.functions.keys import hash_hex
from rowloom.operators import encode, ensemble, features, metrics, models, profile, reduce, resample, splits
from rowloom.operators.preparation import FeaturePreparation
from rowloom.operators.schema import require_schema
from rowloom.operators.settled import settled
from rowloom.operators.steps import VERSION, Step, apply_steps, lowered_title, read_steps, write_steps
from rowloom.session import discard, durable, small_methods, sweep, written
from rowloom.sources import files, state


# Vectors up to this size are kept as they are, and folds are fitted side by side. Beyond it each pass makes them anew and one fold is
# fitted at a time, since each fit keeps a copy of its rows; a large table keeps all cores busy with one.
KEPT_BYTES = 512 << 20


@dataclass
class Roles:
    """Which column plays which part; optional ones may be absent."""

    key: str
    target: str
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    boolean: list[str] = field(default_factory=list)
    title: str | None = None
    date: str | None = None
    block: str | None = None
    components: int = 15
    keywords: str = "package"
    rare_below: int = 10
    top_pairs: int = 10

    @property
    def required(self) -> list[str]:
        single = [c for c in (self.key, self.title, self.date, self.block) if c]
        return [*single, *self.numeric, *self.categorical, *self.boolean]


@dataclass
class Run:
    """Where the results are, and what was chosen."""

    predictions: str
    leaderboard: DataFrame
    best: str
    report: DataFrame
    features: DataFrame
    stored: str


class Features:
    """Engineered columns of one schema; all statistics come from the rows that ``fit`` is given.

    A row that is fitted on never meets its own label: its title is encoded from the labels of rows before it in a hash
    order. Other rows are encoded from the labels of all rows fitted on.
    """

    def __init__(self, roles: Roles, seed: int = 42):
        self.roles = roles
        self.seed = seed
        self.numeric = list(roles.numeric)
        self.flags: list[str] = []
        self.steps: list[Step] = []
        self.base: DataFrame | None = None
        self.path = ""

    def fit(self, train: DataFrame) -> DataFrame:
        """Fit every step on train, one after the other, and return train with the new columns.

        They are stored at ``path`` as ``base`` without the pairs, most of all columns, which follow from the others.
        """
        r, types = self.roles, {f.name: f.dataType.simpleString() for f in train.schema.fields}
        df = self._apply(train, Step("clean", {
            "columns": [*r.required, "y"], "numeric": r.numeric, "boolean": {c: types[c] for c in r.boolean}, "block": r.block,
        }))
        if r.date:
            df = self._apply(df, Step("months", {"date": r.date}))
            df = self._apply(df, Step("recency", {}, {"latest": settled(features.fit_latest_month(df)), "year": settled(features.fit_mean_year(df))}))
            self.numeric += ["month_sin", "month_cos", "recency", "year_norm"]
        if r.title:
            kept = durable(encode.group_rare(df.withColumn(r.title, lowered_title(r.title)), r.title, r.rare_below))
            flags = text.TITLE_KEYWORDS[r.keywords]
            self.flags = list(flags)
            df = self._apply(df, Step("title", {"title": r.title, "flags": flags}, {"kept": kept}))
            means = encode.fit_ordered_totals(df, "_group", "y")
            prior = df.agg(F.avg(F.col("y").cast("double")).alias("encoded")).select(F.lit(None).cast("string").alias("_group"), "encoded")
            means = durable(means.where(F.col("_group").isNotNull()).unionByName(prior))
            self.steps.append(Step("title_means", {}, {"means": means}))
            placed = df.withColumn("_order", hash_hex(self.seed, r.key))
            df = encode.ordered_target_means(placed, "_group", "y", "_order", "title_encoded").drop("_group", "_order")
            self.numeric.append("title_encoded")
        if r.block:
            before = df.columns
            fitted = reduce.fit_pca(df, r.block, r.components)
            df = self._apply(df, Step("block", {"block": r.block, "components": r.components}, {"components": fitted}))
            self.numeric += [c for c in df.columns if c not in before]
        self.base, self.path = written(df, "features")
        df = self.base
        if r.top_pairs:
            ranked = profile.corr_with_target(df, self.numeric, "y", r.top_pairs)
            strong = [row["column_name"] for row in ranked.collect()]  # at most top_pairs names
            before = df.columns
            df = self._apply(df, Step("pairs", {"columns": strong}))
            self.numeric += [c for c in df.columns if c not in before]
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        return self.paired(self.transform_base(df))

    def transform_base(self, df: DataFrame) -> DataFrame:
        """All new columns but the pairs."""
        return apply_steps(df, [s for s in self.steps if s.kind != "pairs"])

    def paired(self, df: DataFrame) -> DataFrame:
        """What ``transform_base`` returned, with the pairs."""
        return apply_steps(df, [s for s in self.steps if s.kind == "pairs"])

    def _apply(self, df: DataFrame, step: Step) -> DataFrame:
        self.steps.append(step)
        return step.apply(df)


@dataclass
class StoredRun:
    """Everything that scores a new file: steps, preparation, models fitted on all rows, label codes and how models combine.

    ``best`` is the name of a model, ``soft_vote`` (models by their weights) or ``stacking`` (a model over their
    probabilities). Scores of all models of a row stand beside each other in it, so combining them moves no rows.
    """

    key: str
    target: str
    k: int
    best: str
    names: list[str]
    weights: list[float]
    steps: list[Step]
    prepared: FeaturePreparation
    codes: DataFrame
    fitted: dict[str, models.Fitted]

    def write(self, spark: SparkSession, root: str, run_id: str) -> str:
        """Store the run below ``root``; runs are kept beside each other by ``run_id``."""
        path = f"{root}/parts/{run_id}"
        write_steps(spark, self.steps, f"{path}/steps")
        self.prepared.write(f"{path}/preparation")
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        for i, name in enumerate(sorted(self.fitted)):
            self.fitted[name].write(spark, f"{path}/models/{i}")
        row = (path, VERSION, self.key, self.target, self.k, self.best, self.names, self.weights, sorted(self.fitted))
        types = "path string, version int, key string, target string, k int, best string, names array<string>, weights array<double>, models array<string>"
        # Written last, so that a run is found only when all its parts are there.
        state.save_state(spark.createDataFrame([row], types), root, "run", run_id)
        return root

    @classmethod
    def read(cls, spark: SparkSession, root: str, run_id: str | None = None) -> "StoredRun":
        """The run ``run_id`` below ``root``, or the newest one where it is missing."""
        found = state.load_state(spark, root, "run", run_id)
        if found is None:
            raise FileNotFoundError(f"no stored run below {root}")
        row = found.first()
        if row["version"] > VERSION:
            raise ValueError(f"the run is of version {row['version']}, known is {VERSION}")
        path = row["path"]
        return cls(
            row["key"], row["target"], row["k"], row["best"], list(row["names"]), list(row["weights"]),
            read_steps(spark, f"{path}/steps"), FeaturePreparation.read(spark, f"{path}/preparation"), spark.read.parquet(f"{path}/codes"),
            {name: models.load_fitted(spark, f"{path}/models/{i}") for i, name in enumerate(row["models"])},
        )

    def probabilities(self, df: DataFrame) -> DataFrame:
        """(key, probs) of raw rows."""
        scored = self.prepared.assemble(apply_steps(df, self.steps)).select(self.key, "features")
        used = [self.best] if self.best in self.names else self.names
        for i, name in enumerate(used):
            scored = self.fitted[name].add_probs(scored).withColumnRenamed("probs", f"_probs{i}")
        each = [F.col(f"_probs{i}") for i in range(len(used))]
        if self.best == "stacking":
            level = scored.select(self.key, array_to_vector(F.concat(*each)).alias("features"))
            return self.fitted["stacking"].add_probs(level).select(self.key, "probs")
        return scored.select(self.key, ensemble.weighted_mean(each, self.weights if self.best == "soft_vote" else [1.0], self.k).alias("probs"))

    def score(self, df: DataFrame) -> DataFrame:
        """(key, label) of raw rows."""
        called = self.probabilities(df).select(self.key, models.argmax(F.col("probs")).alias("prediction"))
        return encode.decode_labels(called, self.codes, "prediction", self.target).select(self.key, self.target)


def refit(whole: DataFrame, fits: dict[str, models.Fit], names: list[str], best: str, k: int, level: DataFrame | None, meta: models.Fit) -> dict:
    """The models that the best needs, each fitted on all rows; the second level stays fitted on out-of-fold probabilities."""
    used = [best] if best in names else names
    done = dict(zip(used, models.side_by_side([lambda n=n: fits[n](whole, k) for n in used])))
    if best == "stacking":
        done["stacking"] = meta(level.drop("fold"), k)
    return done


def run(
    train: DataFrame, test: DataFrame, roles: Roles, fits: dict[str, models.Fit], output: str,
    folds: int = 5, bar: float = 0.72, meta: models.Fit | None = None, seed: int = 42, run_id: str = "run", holdout: float = 0.2,
    balance: bool = False,
) -> Run:
    """Prepare, cross-validate, combine, choose the best by out-of-fold accuracy, write the results and store the run.

    What the best needs is fitted once more on all rows, and stored with steps, preparation and codes (``StoredRun``), unless
    it holds a rule without parts, which cannot be stored.

    A share of ``holdout`` of each class is set apart before anything is fitted; it has no part in encoders, pairs, models,
    weights or the choice, only in ``holdout_acc``. ``balance`` raises all classes to the largest inside each fold's training part.
    """
    with small_methods(train.sparkSession):
        return _run(train, test, roles, fits, output, folds, bar, meta, seed, run_id, holdout, balance)


def _run(
    train: DataFrame, test: DataFrame, roles: Roles, fits: dict[str, models.Fit], output: str,
    folds: int, bar: float, meta: models.Fit | None, seed: int, run_id: str, holdout: float, balance: bool,
) -> Run:
    spark, key = train.sparkSession, roles.key
    require_schema(train, [*roles.required, roles.target], "train")
    require_schema(test, roles.required, "test")
    codes = encode.fit_labels(train, roles.target).persist()
    k = codes.count()

    engineered = Features(roles, seed)
    labelled = splits.stratified_split(encode.apply_labels(train, codes, roles.target, "y"), key, "y", holdout, seed)
    labelled, _ = written(labelled, "labelled")
    sweep(spark)
    apart = labelled.where("split = 'test'").drop("split")
    # Results that many later passes read are stored, and their plans end here: the columns that vectors and pairs follow from, since
    # these are several times as large and a pass makes them faster than it would read them.
    wide = engineered.fit(labelled.where("split = 'train'").drop("split"))
    prepared = FeaturePreparation(engineered.numeric, roles.categorical, [*roles.boolean, *engineered.flags]).fit(wide)
    dealt, _ = written(splits.stratified_kfold(engineered.base, key, "y", folds, seed).repartition(key), "folds")
    discard(spark, engineered.path)
    folded = prepared.assemble(engineered.paired(dealt)).select(key, "y", "features", "fold")
    at_once = 1 if dealt.count() * prepared.width * 8 > KEPT_BYTES else None
    sweep(spark)

    def unseen(df: DataFrame, part: str) -> DataFrame:
        """Rows that nothing was fitted on; their key says which table they are of, as both may hold the same keys."""
        named = F.struct(F.lit(part).alias("part"), F.col(key).alias("id")).alias(key)
        rows, _ = written(engineered.transform_base(df), part)
        return prepared.assemble(engineered.paired(rows)).select(named, "features")

    asked = unseen(apart, "holdout").unionByName(unseen(test, "test"))

    def of(new: DataFrame, part: str) -> DataFrame:
        return new.where(F.col(key)["part"] == part).withColumn(key, F.col(key)["id"])

    # Synthetic rows are made inside each fold's training part, and for the last fit, never of rows that are scored.
    even = resample.balanced_training(key, seed=seed) if balance else None
    held, tested = None, None
    for name, fit in fits.items():
        own, new = models.oof_predict(folded, fit, k, key, name, asked, folds, even, at_once=at_once)
        held = own if held is None else held.unionByName(own)
        tested = new if tested is None else tested.unionByName(new)
    held, tested = written(held, "held")[0], written(tested, "tested")[0]
    sweep(spark)

    scores = models.cv_score(models.fold_accuracy(held, key, k)).select("model", F.col("cv_mean").alias("cv_score"))
    # Votes are weighed and models qualify by their CV score alone.
    scores = scores.withColumn("holdout_acc", F.col("cv_score")).persist()
    kept = ensemble.qualify_models(scores, bar)
    weights, level = None, None
    names = sorted(row["model"] for row in kept.select("model").collect())  # one row per model
    results = {name: (held.where(F.col("model") == name), tested.where(F.col("model") == name)) for name in names}
    if len(names) > 1:
        weights = ensemble.vote_weights(kept).persist()
        labels = folded.select(key, "y", "fold")
        voted = [ensemble.soft_vote(t.where(F.col("model").isin(names)), key, weights) for t in (held, tested)]
        results["soft_vote"] = (voted[0].join(labels, key), voted[1])
        level = written(splits.stratified_kfold(ensemble.level_one(held, key, names, k, ["y"]), key, "y", folds, seed + 81), "level")[0]
        new_level = written(ensemble.level_one(tested, key, names, k), "new-level")[0]
        sweep(spark)
        stacked = models.oof_predict(level, meta or models.logistic(), k, key, "stacking", new_level, folds, at_once=at_once)
        results["stacking"] = (written(stacked[0], "stacked")[0], stacked[1])
        sweep(spark)

    truth = apart.select(key, "y")
    rows = []
    for name, (own, new) in results.items():
        called = models.predicted_class(own, [key, "y"], k)
        fresh = truth.join(models.predicted_class(of(new, "holdout"), [key], k), key, "left")
        cv_acc, new_acc = [metrics.accuracy(c, "y", "prediction").first()[0] for c in (called, fresh)]
        rows.append((name, float(cv_acc), None if new_acc is None else float(new_acc)))
    board = ensemble.leaderboard(spark.createDataFrame(rows, "model string, cv_score double, holdout_acc double"), "cv_score")
    best = board.first()["model"]

    own, new = results[best]
    report = metrics.classification_report(models.predicted_class(own, [key, "y"], k), list(range(k)), "y", "prediction")
    answers = encode.decode_labels(models.predicted_class(of(new, "test"), [key], k), codes, "prediction", roles.target)
    predictions = files.write_predictions(answers, f"{output}/predictions", key, roles.target)
    state.save_state(codes, f"{output}/state", "label_codes", run_id)
    state.save_state(prepared.medians, f"{output}/state", "medians", run_id)
    state.save_state(prepared.scales, f"{output}/state", "scales", run_id)
    weighed = {r["model"]: r["weight"] for r in weights.collect()} if weights is not None else {}  # one row per model
    fitted = refit(even(folded) if even else folded.drop("fold"), fits, names, best, k, level, meta or models.logistic())
    stored = f"{output}/stored"
    if all(f.kind for f in fitted.values()):
        whole = StoredRun(key, roles.target, k, best, names, [float(weighed.get(n, 1.0)) for n in names], engineered.steps, prepared, codes, fitted)
        whole.write(spark, stored, run_id)
    files.write_parquet(board, f"{output}/leaderboard")
    files.write_metadata(spark, f"{output}/metadata", {"best": best, "models": len(fits), "features": prepared.width, "classes": k})
    return Run(predictions, board, best, report, prepared.name_table(spark), stored)
