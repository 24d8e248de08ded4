"""Classification metrics as tables. Everything starts from grouped counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.ranking import running_totals


def accuracy(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Share of rows whose label is predicted; a row without label or prediction is a miss."""
    return df.agg(F.avg(F.coalesce(F.col(y) == F.col(p), F.lit(False)).cast("double")).alias("accuracy"))


def confusion_counts(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, classes: list[int], y: str = "y", p: str = "p") -> DataFrame:
    """Every (true, predicted) cell of the given classes and of all others that occur, empty cells as 0.

    A missing label or prediction is a class of its own (null), so the cells always hold every row of ``df``.
    """
    counts = confusion_counts(df, y, p).select(F.col("y").cast("int").alias("y"), F.col("p").cast("int").alias("p"), "n")
    known = classes_of(counts, classes)
    cells = df.sparkSession.createDataFrame([(a, b) for a in known for b in known], "y int, p int").alias("c")
    met = (F.col("c.y").eqNullSafe(F.col("n.y"))) & (F.col("c.p").eqNullSafe(F.col("n.p")))
    return cells.join(counts.alias("n"), met, "left").select("c.y", "c.p", F.coalesce("n.n", F.lit(0)).alias("n"))


def classes_of(counts: DataFrame, classes: list[int]) -> list[int | None]:
    """The given classes and those that occur in a table of counts, in order, null last."""
    found = {r[0] for r in counts.select(F.explode(F.array("y", "p"))).distinct().collect()}
    return sorted(found - {None} | set(classes)) + ([None] if None in found else [])


def confusion_wide(df: DataFrame, classes: list[int], y: str = "y", p: str = "p") -> DataFrame:
    """One row per true class with a column per predicted class, of the given classes and all others that occur."""
    long = confusion_matrix(df, classes, y, p)
    known = [r[0] for r in long.select("p").distinct().collect()]
    return long.groupBy("y").agg(*[
        F.sum(F.when(F.col("p").eqNullSafe(F.lit(c)), F.col("n")).otherwise(0)).alias("p_none" if c is None else f"p_{c}")
        for c in sorted(known, key=lambda c: (c is None, c))
    ])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def per_class_report(df: DataFrame, classes: list[int], y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall, F1 and support per class, from the counts of one grouping."""
    cells = confusion_matrix(df, classes, y, p)
    sides = cells.select(
        F.inline(F.array(
            F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.lit(0).cast("long").alias("hit")),
            F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0).cast("long")).alias("hit")),
        ))
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    precision = _ratio(F.col("hit"), F.col("predicted"))
    recall = _ratio(F.col("hit"), F.col("support"))
    scored = sums.select("class", "support", "hit", precision.alias("precision"), recall.alias("recall"))
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1)


def classification_report(df: DataFrame, classes: list[int], y: str = "y", p: str = "p") -> DataFrame:
    """The per-class rows followed by accuracy, macro and weighted averages."""
    rows = per_class_report(df, classes, y, p).persist()  # one row per class
    score = ["precision", "recall", "f1"]
    body = rows.select(F.coalesce(F.col("class").cast("string"), F.lit("none")).alias("label"), *score, "support")
    total = F.sum("support")
    hits = F.sum("hit") / total
    acc = rows.agg(F.lit("accuracy").alias("label"), *[hits.alias(s) for s in score], total.alias("support"))
    macro = rows.agg(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in score], total.alias("support"))
    weighted = rows.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(s) * F.col("support")) / total).alias(s) for s in score], total.alias("support"),
    )
    return body.unionByName(acc).unionByName(macro).unionByName(weighted)


def weighted_prf(df: DataFrame, classes: list[int], y: str = "y", p: str = "p") -> DataFrame:
    rows = per_class_report(df, classes, y, p)
    total = F.sum("support")
    return rows.agg(*[
        (F.sum(F.col(s) * F.col("support")) / total).alias(f"weighted_{s}") for s in ("precision", "recall", "f1")
    ])


def score_steps(df: DataFrame, group: list[str], score: str, positive: Column, **running) -> DataFrame:
    """Per distinct score, from high to low: positives and negatives at or above it.

    Rows are first counted per score, so tied rows and hot groups shrink before they move.
    """
    hit = positive.cast("long")
    counts = df.groupBy(*group, F.col(score).alias("score")).agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
    ).persist()
    return running_totals(
        counts, group, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}, **running
    )


def roc_curve(df: DataFrame, score: str, positive: Column, **running) -> DataFrame:
    """(fpr, tpr) at each distinct threshold, from (0, 0) at infinity."""
    steps = score_steps(df, [], score, positive, **running)
    total = df.agg(F.sum(positive.cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    n_pos, n_neg = total["p"], total["n"] - total["p"]
    points = steps.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("fp"), F.lit(n_neg)).alias("fpr"),
        _ratio(F.col("tp"), F.lit(n_pos)).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def roc_auc(df: DataFrame, group: list[str], score: str, positive: Column, **running) -> DataFrame:
    """Area under the curve per group: each negative is beaten by the positives above it, ties count half."""
    steps = score_steps(df, group, score, positive, **running)
    wins = (F.col("tp") - F.col("pos") / 2.0) * F.col("neg")
    sums = [F.sum(wins).alias("w"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")]
    area = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("w") / F.col("n_pos") / F.col("n_neg"))
    return steps.groupBy(*group).agg(*sums).select(*group, area.alias("auc"))


def roc_auc_ovr(probabilities: DataFrame, group: list[str] = (), **running) -> DataFrame:
    """One-vs-rest area per class, from long rows (id, y, class, prob)."""
    return roc_auc(probabilities, [*group, "class"], "prob", F.col("y") == F.col("class"), **running)


def log_loss(probabilities: DataFrame, epsilon: float = 1e-15) -> DataFrame:
    """Mean of -ln p of the true class, from long rows."""
    p = F.least(F.greatest(F.col("prob"), F.lit(epsilon)), F.lit(1 - epsilon))
    own = probabilities.where(F.col("y") == F.col("class"))
    return own.agg(F.avg(-F.log(p)).alias("log_loss"))


def brier(df: DataFrame, prob: str, positive: Column) -> DataFrame:
    gap = F.col(prob) - positive.cast("double")
    return df.agg(F.avg(gap * gap).alias("brier"))
