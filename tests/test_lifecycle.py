"""The whole run on CSV files with the columns of a salary problem."""

import random

from pyspark.sql import functions as F

from rowloom.operators import models
from rowloom.plans import lifecycle
from rowloom.sources import files

TYPES = (
    "obs INT, job_title STRING, job_posted_date STRING, job_state STRING, feature_2 STRING, feature_9 DOUBLE, "
    "feature_3 STRING, job_desc_001 DOUBLE, job_desc_002 DOUBLE, job_desc_003 DOUBLE, job_desc_004 DOUBLE, salary_category STRING"
)


def make_csv(path, rows, labelled, seed):
    rng = random.Random(seed)
    lines = [",".join(c.split()[0] for c in TYPES.split(", "))]
    for i in range(rows):
        senior = rng.random() < 0.5
        pay = rng.gauss(2 if senior else 0, 0.6)
        label = "High" if pay > 1.8 else "Medium" if pay > 0.3 else "Low"
        title = ("Senior Engineer" if senior else "Junior Analyst") if rng.random() < 0.95 else ("" if rng.random() < 0.5 else f"Rare {i}")
        date = rng.choice(["2021/07", "2022/01", "", "abc", "2020/13"])
        number = rng.choice(["NA", "", f"{pay:.3f}", f"{pay:.3f}", f"{pay:.3f}", f"{pay:.3f}"])
        desc = [f"{rng.gauss(pay, 1):.3f}" if rng.random() < 0.95 else "" for _ in range(4)]
        values = [str(i), title, date, rng.choice(["CA", "NY", ""]), number, f"{rng.random():.3f}", rng.choice(["yes", "no", "1", ""]), *desc]
        lines.append(",".join([*values, label if labelled else ""]))
    path.write_text("\n".join(lines) + "\n")


def load(spark, path):
    df = files.read_csv(spark, str(path), TYPES)
    slots = [f"job_desc_00{i}" for i in range(1, 5)]
    return df.withColumn("job_desc", F.array(*slots)).drop(*slots)


def test_from_csv_to_submission(spark, tmp_path):
    make_csv(tmp_path / "train.csv", 240, True, 1)
    make_csv(tmp_path / "test.csv", 80, False, 2)
    train, test = load(spark, tmp_path / "train.csv"), load(spark, tmp_path / "test.csv").drop("salary_category")
    roles = lifecycle.Roles(
        key="obs", target="salary_category", numeric=["feature_2", "feature_9"], categorical=["job_state"], boolean=["feature_3"],
        title="job_title", date="job_posted_date", block="job_desc", components=2, top_pairs=3,
    )
    fits = {"logistic": models.logistic(iterations=30), "random_forest": models.random_forest(trees=10, depth=4)}
    done = lifecycle.run(train, test, roles, fits, str(tmp_path / "out"), folds=2, bar=0.5)

    submission = files.read_csv(spark, done.predictions, "obs INT, salary_category STRING").collect()
    assert sorted(r["obs"] for r in submission) == list(range(80))
    assert {r["salary_category"] for r in submission} <= {"High", "Medium", "Low"}
    board = {r["model"]: r["cv_score"] for r in done.leaderboard.collect()}
    assert set(board) == {"logistic", "random_forest", "soft_vote", "stacking"}
    assert max(board.values()) == board[done.best] > 0.6
    assert {"is_senior", "title_encoded", "recency", "block_std", "block_pca_1", "job_state_CA", "feature_3"} <= {r["feature"] for r in done.features.collect()}
    assert {r["label"] for r in done.report.collect()} >= {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    saved = files.read_metadata(spark, str(tmp_path / "out" / "metadata"), "best STRING, classes INT")
    assert saved == {"best": done.best, "classes": 3}

    # A new file, in a session that knows nothing of the fit; a missing run falls back to the newest.
    fresh = spark.newSession()
    make_csv(tmp_path / "new.csv", 60, False, 5)
    run = lifecycle.StoredRun.read(fresh, done.stored, "no such run")
    labels = run.score(load(fresh, tmp_path / "new.csv").drop("salary_category")).collect()
    assert sorted(r["obs"] for r in labels) == list(range(60)) and {r["salary_category"] for r in labels} <= {"High", "Medium", "Low"}
    again = lifecycle.StoredRun.read(spark, done.stored).probabilities(load(spark, tmp_path / "new.csv"))
    assert all(abs(sum(r["probs"]) - 1) < 1e-9 for r in again.collect())


def test_labels_without_meaning_are_not_learned(spark, tmp_path):
    """Labels drawn apart from all columns: no score may lie far above the largest class, in folds or apart from them."""
    rng = random.Random(3)
    rows = [(i, f"title {i % 40}", rng.gauss(0, 1), rng.gauss(0, 1), rng.choice(["a", "b"])) for i in range(600)]
    df = spark.createDataFrame(rows, "obs int, job_title string, u double, v double, salary_category string")
    roles = lifecycle.Roles(key="obs", target="salary_category", numeric=["u", "v"], title="job_title", top_pairs=2)
    fits = {"random_forest": models.random_forest(trees=10, depth=4)}
    done = lifecycle.run(df, df.drop("salary_category"), roles, fits, str(tmp_path / "out"), folds=3, bar=0.5)
    row = done.leaderboard.first()
    share = max(sum(r[4] == c for r in rows) for c in "ab") / 600
    assert row["cv_score"] < share + 0.08 and row["holdout_acc"] < share + 0.12
    assert files.read_csv(spark, done.predictions, "obs INT, salary_category STRING").count() == 600
