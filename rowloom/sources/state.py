"""Fitted state kept as parquet below ``root/name/run_id=...``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_state(df: DataFrame, root: str, name: str, run_id: str) -> str:
    """Store one run of a state table; other runs stay untouched."""
    path = f"{root}/{name}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def load_state(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame | None:
    """The state of a run; the newest run when that one is missing; None when there is none."""
    try:
        runs = (
            spark.read.option("recursiveFileLookup", "false")
            .option("basePath", f"{root}/{name}")
            .parquet(f"{root}/{name}")
            .withColumn("run_id", F.col("run_id").cast("string"))
        )
    except AnalysisException:
        return None
    # One value per run; partition pruning reads only the chosen one.
    known = [r[0] for r in runs.select("run_id").distinct().collect()]
    chosen = run_id if run_id in known else max(known, default=None)
    return None if chosen is None else runs.where(F.col("run_id") == chosen).drop("run_id")
