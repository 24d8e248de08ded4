"""The whole feature table: impute, scale and encode in one fitted state."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.operators.encode import apply_dictionary, fit_dictionary
from rowloom.operators.impute import apply_fill, fit_median
from rowloom.operators.scale import apply_standard, fit_standard


@dataclass
class FeaturePreparation:
    """Numeric columns get the median and a z-score, categories 'Unknown' and a sparse vector, booleans 0.

    The categories of a column are a stored table of codes; only their number is on the driver, so any number of them is
    prepared, stored and read back alike, with one schema: ``<column>_hot`` for each categorical column.
    """

    numeric: list[str]
    categorical: list[str]
    boolean: list[str]
    medians: DataFrame | None = None
    scales: DataFrame | None = None
    codes: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> "FeaturePreparation":
        self.medians = fit_median(train, self.numeric)
        self.scales = fit_standard(apply_fill(train.select(*self.numeric), self.medians), self.numeric)
        for c in self.categorical:
            self.codes[c], self.sizes[c] = fit_dictionary(train, c)
        return self

    def write(self, path: str) -> str:
        """Store the fitted state below ``path``: one row each of medians and scales, a row per column, a row per category."""
        spark = self.medians.sparkSession
        roles = [("numeric", c) for c in self.numeric] + [("categorical", c) for c in self.categorical] + [("boolean", c) for c in self.boolean]
        rows = [(i, role, c, self.sizes.get(c)) for i, (role, c) in enumerate(roles)]
        columns = spark.createDataFrame(rows, "position int, role string, column_name string, size long")
        for name, state in (("medians", self.medians), ("scales", self.scales), ("columns", columns)):
            state.write.mode("overwrite").parquet(f"{path}/{name}")
        for i, c in enumerate(self.categorical):
            self.codes[c].write.mode("overwrite").parquet(f"{path}/codes/{i}")
        return path

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "FeaturePreparation":
        """A preparation stored by ``write``, in any session."""
        rows = spark.read.parquet(f"{path}/columns").orderBy("position").collect()  # one row per input column
        named = {role: [r["column_name"] for r in rows if r["role"] == role] for role in ("numeric", "categorical", "boolean")}
        codes = {c: spark.read.parquet(f"{path}/codes/{i}") for i, c in enumerate(named["categorical"])}
        sizes = {r["column_name"]: r["size"] for r in rows if r["role"] == "categorical"}
        return cls(**named, medians=spark.read.parquet(f"{path}/medians"), scales=spark.read.parquet(f"{path}/scales"), codes=codes, sizes=sizes)

    @property
    def width(self) -> int:
        """Slots of the assembled vector."""
        return len(self.numeric) + sum(self.sizes.values()) + len(self.boolean)

    def name_table(self, spark: SparkSession) -> DataFrame:
        """(slot, feature) of every slot; categories come from their tables."""
        named = [(i, c) for i, c in enumerate(self.numeric)]
        at = len(named)
        parts = []
        for c in self.categorical:
            parts.append(self.codes[c].select((F.col("code") + at).cast("int").alias("slot"), F.concat(F.lit(f"{c}_"), "label").alias("feature")))
            at += self.sizes[c]
        named += [(at + i, c) for i, c in enumerate(self.boolean)]
        out = spark.createDataFrame(named, "slot int, feature string")
        for part in parts:
            out = out.unionByName(part)
        return out

    @property
    def names(self) -> list[str]:
        """Readable name of every slot, in order: a list of ``width`` entries, for vectors that are known to be short."""
        return [r["feature"] for r in self.name_table(self.medians.sparkSession).orderBy("slot").collect()]

    def transform(self, df: DataFrame) -> DataFrame:
        """Feature columns followed by the columns it does not use, unchanged."""
        used = {*self.numeric, *self.categorical, *self.boolean}
        rest = [c for c in df.columns if c not in used]
        clean = apply_standard(apply_fill(df, self.medians), self.scales, self.numeric)
        for c in self.categorical:
            clean = apply_dictionary(clean, self.codes[c], self.sizes[c], c, f"{c}_hot")
        zeros = [F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in self.boolean]
        return clean.select(*self.numeric, *[f"{c}_hot" for c in self.categorical], *zeros, *rest)

    def assemble(self, df: DataFrame) -> DataFrame:
        """The transformed table as one vector column."""
        inputs = [*self.numeric, *[f"{c}_hot" for c in self.categorical], *self.boolean]
        vectors = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
        return vectors.transform(self.transform(df)).drop(*inputs)


def feature_names(df: DataFrame, names: list[str], width: int | None = None) -> DataFrame:
    """Slot to name: a transformer prefix ('num__') is cut off; slots without a name get a generic one."""
    width = len(names) if width is None else width
    rows = [
        (i, names[i].split("__", 1)[-1] if i < len(names) else f"feature_{i}")
        for i in range(width)
    ]
    return df.sparkSession.createDataFrame(rows, "slot int, feature string")
