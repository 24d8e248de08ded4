"""Files, state, schema checks and the stream."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom import session
from rowloom.operators import encode, impute, models, schema
from rowloom.sources import files, state
from rowloom.streaming.score import score_stream


def test_csv_with_bad_values(spark, tmp_path):
    (tmp_path / "in.csv").write_text("obs,x,when\n1,2.5,2021/07\n2,abc,\n3,,2020/01\n")
    rows = files.read_csv(spark, str(tmp_path / "in.csv"), "obs INT, x DOUBLE, when STRING").orderBy("obs").collect()
    assert [(r["obs"], r["x"], r["when"]) for r in rows] == [(1, 2.5, "2021/07"), (2, None, None), (3, None, "2020/01")]


def test_predictions_have_a_header_and_two_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "High", 0.5), (2, "Low", 0.1)], "obs int, salary_category string, p double").coalesce(1)
    path = files.write_predictions(df, str(tmp_path / "out"), "obs", "salary_category")
    part = next((tmp_path / "out").glob("*.csv"))
    assert part.read_text().splitlines() == ["obs,salary_category", "1,High", "2,Low"] and path


def test_metadata_round_trip_and_missing(spark, tmp_path):
    path = files.write_metadata(spark, str(tmp_path / "meta"), {"model": "rf", "accuracy": 0.7, "k": 3, "ok": True})
    types = "model STRING, accuracy DOUBLE, k INT, ok BOOLEAN"
    assert files.read_metadata(spark, path, types) == {"model": "rf", "accuracy": 0.7, "k": 3, "ok": True}
    assert files.read_metadata(spark, str(tmp_path / "none"), types) == {}


def test_state_runs(spark, tmp_path):
    root = str(tmp_path)
    assert state.load_state(spark, root, "codes") is None
    for run, v in (("20250101", 1), ("20250301", 3), ("20250201", 2)):
        state.save_state(spark.createDataFrame([("a", v)], "label string, code int"), root, "codes", run)
    value = lambda run=None: state.load_state(spark, root, "codes", run).first()["code"]
    assert value("20250201") == 2 and value() == 3 and value("20249999") == 3
    state.save_state(spark.createDataFrame([("a", 9)], "label string, code int"), root, "codes", "20250101")
    assert value("20250101") == 9 and value() == 3


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a")], "obs int, t string")
    report = {r["column_name"]: (r["present"], r["has_rows"]) for r in schema.validate_schema(df.limit(0), ["obs", "z"], "t").collect()}
    assert report == {"obs": (True, False), "z": (False, False)}
    with pytest.raises(ValueError, match="missing columns \\['z'\\]"):
        schema.require_schema(df, ["obs", "z"], "t")
    with pytest.raises(ValueError, match="no rows"):
        schema.require_schema(df.limit(0), ["obs"], "t")
    assert schema.require_schema(df, ["obs"], "t") is df


def test_alignment(spark):
    df = spark.createDataFrame([(1, 5.0, "x")], "obs int, b double, extra string")
    aligned = schema.align_schema(df, ["a", "b"], ["obs"])
    assert aligned.columns == ["obs", "a", "b"] and tuple(aligned.first()) == (1, 0, 5.0)


def test_harmonise(spark):
    train = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
    test = spark.createDataFrame([("1.5", 3), ("oops", 4)], "x string, s int")
    got = schema.harmonise_types(test, train)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["double", "string"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1.5, "3"), (None, "4")]


def test_unknown_format_and_missing_schema(spark):
    with pytest.raises(ValueError):
        files.read_any(spark, "/tmp/x.xlsx")
    with pytest.raises(ValueError):
        files.read_any(spark, "/tmp/x.csv")


def test_imputation_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, x double")
    assert impute.fit_median(df, ["x"]).first()["x"] == 0.0
    assert impute.fit_mean(df, ["x"]).first()["x"] == 0.0


def test_one_hot_refuses_too_many_values(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        encode.wide_values(df, "c")


def test_target_means_without_state(spark):
    df = spark.createDataFrame([("a",)], "c string")
    assert encode.apply_target_means(df, None, "c", "e").first()["e"] == 0.5


def test_target_means_of_null_and_unseen(spark):
    train = spark.createDataFrame([("a", 1)] * 30 + [("b", 0)] * 30 + [(None, 1)] * 40, "c string, y int")
    fitted = encode.fit_target_means(train, "c", "y", smoothing=1.0, min_leaf=1)
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    got = {r["c"]: r["e"] for r in encode.apply_target_means(test, fitted, "c", "e").collect()}
    assert got["zzz"] == got[None] == pytest.approx(0.7) and got["a"] == pytest.approx(1.0, abs=1e-6)


def flip_model():
    def add(df):
        p = F.when(F.col("x") > 0, 0.9).otherwise(0.2)
        return df.withColumn("probs", F.array(1 - p, p))

    return models.Fitted(2, add)


@pytest.mark.parametrize("ending", [".csv", ".parquet"])
def test_batch_scores_to_a_file(spark, tmp_path, ending):
    df = spark.createDataFrame([(1, 0.5), (2, -0.5)], "id int, x double")
    path = str(tmp_path / f"scores{ending}")
    assert files.batch_score(df, lambda d: d, flip_model(), "id", True, path) is None
    got = files.read_any(spark, path, "id INT, prediction INT, probability DOUBLE").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 0.9), (2, 0, 0.2)]


def test_batch_scores_from_a_file(spark, tmp_path):
    spark.createDataFrame([(1, 0.5), (2, -0.5)], "id int, x double").write.option("header", True).csv(str(tmp_path / "in.csv"))
    got = files.batch_score(str(tmp_path / "in.csv"), lambda d: d, flip_model(), "id", spark=spark, schema="id INT, x DOUBLE")
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 0)]


def test_stream_scores_each_file_once(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    df = spark.createDataFrame([(1, 0.5), (2, -0.5)], "id int, x double")
    df.write.parquet(folder)
    run = lambda: score_stream(spark, folder, df.schema, lambda d: d, flip_model(), "id", out, check)
    run()
    run()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(3, 1.0)], "id int, x double").write.mode("append").parquet(folder)
    run()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 1), (2, 0), (3, 1)]


class FakeSession:
    """Just the settings that the shared folder is read from."""

    def __init__(self, master, named=None):
        class Conf(dict):
            def get(self, key, default=None):
                return dict.get(self, key, default)

        self.conf = Conf({"spark.checkpoint.dir": named} if named else {})
        self.sparkContext = self
        self.master, self.current = master, None

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_shared_folder_is_the_one_named():
    fake = FakeSession("spark://host", "hdfs://shared/folder")
    assert session.shared_path(fake, "x").startswith("hdfs://shared/folder/x-")
    assert fake.current == "hdfs://shared/folder"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSession("spark://host"))
    assert session.shared_root(FakeSession("local[2]"))


def test_tasks_do_not_need_the_package(sf, tmp_path):
    """Python tasks run although the workers cannot import the package."""
    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "outside.py"
    script.write_text(
        f"import sys\nsys.path.insert(0, {str(root)!r})\n"
        "from rowloom.session import local_session\n"
        "from rowloom.plans import catalogue\n"
        "spark = local_session(2)\n"
        f"print([catalogue.QUERIES[n](spark, {sf!r}).count() for n in ('knn_join', 'pca')])\n"
    )
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "[2500, 500]" in done.stdout, done.stderr[-2000:]
