"""Engineered columns as a list of fitted steps that can be stored, read in another session and applied to a new file.

A step is its kind, plain parameters and small or large state tables. Applying one uses nothing but these, so what is read
back does what was fitted. New kinds are added to ``KINDS``; a stored list names its version, and a list of a later version
than this code knows is refused.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions import blocks, dates, text
from rowloom.functions.cleaning import bool_to_int, null_tokens, to_number
from rowloom.functions.numeric import pair_products
from rowloom.operators import encode, features, reduce

VERSION = 1


@dataclass
class Step:
    kind: str
    params: dict
    states: dict[str, DataFrame] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        return KINDS[self.kind](df, self.params, self.states)


def _clean(df: DataFrame, p: dict, _: dict) -> DataFrame:
    """Numbers from text, flags from booleans or text, the block without gaps; other columns are left out."""
    clean = {c: to_number(null_tokens(F.col(c).cast("string"))).alias(c) for c in p["numeric"]}
    clean |= {c: bool_to_int(F.col(c), T._parse_datatype_string(t)).alias(c) for c, t in p["boolean"].items()}
    if p["block"]:
        clean[p["block"]] = blocks.filled_block(F.col(p["block"])).alias(p["block"])
    return df.select(*[clean.get(c, F.col(c)) for c in df.columns if c in p["columns"]])


def _months(df: DataFrame, p: dict, _: dict) -> DataFrame:
    year, month = dates.lenient_year_month(F.col(p["date"]))
    parted = df.select("*", year.alias("year"), month.alias("month"))
    sin, cos = dates.cyclic_month(F.col("month"))
    return parted.select("*", sin.alias("month_sin"), cos.alias("month_cos")).drop(p["date"])


def _recency(df: DataFrame, _: dict, states: dict) -> DataFrame:
    return features.year_norm(features.recency_months(df, states["latest"]), states["year"]).drop("year", "month")


def lowered_title(column: str):
    return F.lower(F.coalesce(F.col(column), F.lit("unknown")))


def _title(df: DataFrame, p: dict, states: dict) -> DataFrame:
    named = df.withColumn(p["title"], lowered_title(p["title"]))
    grouped = encode.apply_group_rare(named, states["kept"], p["title"], "_group")
    return grouped.select("*", *text.keyword_flags(F.col(p["title"]), p["flags"])).drop(p["title"])


def _title_means(df: DataFrame, _: dict, states: dict) -> DataFrame:
    return encode.apply_target_means(df, states["means"], "_group", "title_encoded").drop("_group")


def _block(df: DataFrame, p: dict, states: dict) -> DataFrame:
    block = F.col(p["block"])
    stats = [*blocks.row_stats(block, "block"), *blocks.row_nonzero(block, "block"), *blocks.row_quantiles(block, "block")]
    slots = [F.get("_scores", F.lit(i)).alias(f"block_pca_{i}") for i in range(p["components"])]
    scored = df.select("*", *stats, reduce.project(states["components"], p["block"]).alias("_scores"))
    return scored.select("*", *slots).drop("_scores", p["block"])


def _pairs(df: DataFrame, p: dict, _: dict) -> DataFrame:
    return df.select("*", *pair_products(p["columns"]))


KINDS = {
    "clean": _clean, "months": _months, "recency": _recency, "title": _title, "title_means": _title_means, "block": _block, "pairs": _pairs,
}


def apply_steps(df: DataFrame, steps: list[Step]) -> DataFrame:
    for step in steps:
        df = step.apply(df)
    return df


def write_steps(spark: SparkSession, steps: list[Step], path: str) -> str:
    """Store the steps below ``path``: a row per step, and each state table by itself."""
    rows = [(i, VERSION, s.kind, json.dumps(s.params), sorted(s.states)) for i, s in enumerate(steps)]
    spark.createDataFrame(rows, "position int, version int, kind string, params string, states array<string>").write.mode("overwrite").parquet(f"{path}/steps")
    for i, step in enumerate(steps):
        for name, table in step.states.items():
            table.write.mode("overwrite").parquet(f"{path}/states/{i}/{name}")
    return path


def read_steps(spark: SparkSession, path: str) -> list[Step]:
    """Steps stored by ``write_steps``, in any session."""
    out = []
    for row in spark.read.parquet(f"{path}/steps").orderBy("position").collect():  # one row per step
        if row["version"] > VERSION or row["kind"] not in KINDS:
            raise ValueError(f"step {row['kind']} of version {row['version']} is not known here")
        states = {name: spark.read.parquet(f"{path}/states/{row['position']}/{name}") for name in row["states"]}
        out.append(Step(row["kind"], json.loads(row["params"]), states))
    return out
