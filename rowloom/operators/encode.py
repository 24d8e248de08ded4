"""Encoders. A fit returns a state table keyed by category; applying it joins that table back."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.profile import count_distinct, distinct_union
from rowloom.operators.ranking import running_totals
from rowloom.operators.sizing import lookup
from rowloom.session import durable

MAX_WIDE_VALUES = 200


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("Unknown"))


def group_rare(df: DataFrame, column: str, threshold: int = 10) -> DataFrame:
    """State: the values that occur at least ``threshold`` times."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.where(F.col("count") >= threshold).select(column, F.col(column).alias("_kept"))


def apply_group_rare(df: DataFrame, state: DataFrame, column: str, out: str, other: str = "Other_Title") -> DataFrame:
    return lookup(df, state, column).select(
        *df.columns, F.coalesce(F.col("_kept"), F.lit(other)).alias(out)
    )


def fit_top_categories(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """State: the ``n`` most frequent values; ties go to the smaller value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), column).limit(n).select(column, F.col(column).alias("_kept"))


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """State: codes 0..k-1 in the order of the label text; a missing label is 'Unknown'."""
    labels = df.select(_text(column).alias("label")).distinct()
    coded = running_totals(labels, [], [F.col("label").asc()], {"code": F.lit(1).cast("long")})
    return coded.select("label", (F.col("code") - 1).cast("int").alias("code"))


def apply_labels(df: DataFrame, state: DataFrame, column: str, out: str = "code") -> DataFrame:
    keyed = df.withColumn("label", _text(column))
    return lookup(keyed, state, "label").select(*df.columns, F.col("code").alias(out))


def decode_labels(df: DataFrame, state: DataFrame | None, column: str, out: str = "label") -> DataFrame:
    """Codes to labels; codes out of range are clipped, and without a table they read class_<n>."""
    generic = F.concat(F.lit("class_"), F.col(column).cast("string"))
    if state is None:
        return df.withColumn(out, generic)
    top = state.agg(F.max("code")).first()[0]
    clipped = F.least(F.greatest(F.col(column), F.lit(0)), F.lit(top))
    table = state.select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    joined = lookup(df.withColumn("_code", clipped.cast("int")), table, "_code")
    return joined.select(*df.columns, F.coalesce("_label", generic).alias(out))


def unseen_to(df: DataFrame, seen: DataFrame, column: str, default: str | Column, out: str) -> DataFrame:
    """Values that are not in the fitted set become ``default``."""
    default = default if isinstance(default, Column) else F.lit(default)
    table = seen.select(F.col(column), F.lit(True).alias("_seen"))
    joined = lookup(df, table, column)
    return joined.select(*df.columns, F.when(F.col("_seen"), F.col(column)).otherwise(default).alias(out))


def mode_of(df: DataFrame, column: str) -> str:
    """Most frequent value, ties to the smaller one."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), column).first()[column]


def unseen_values(df: DataFrame, seen: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().join(seen.select(column), column, "left_anti")


def wide_values(table: DataFrame, column: str, limit: int = MAX_WIDE_VALUES) -> list[str]:
    """The values of a column, sorted; refuses more than can become columns, for which ``fit_dictionary`` stands."""
    values = table.where(F.col(column).isNotNull()).select(column).distinct()
    rows = values.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column}: more than {limit} values, use fit_dictionary")
    return sorted(r[0] for r in rows)


def one_hot(column: str, values: list[str], prefix: str) -> list[Column]:
    """One 0/1 column per fitted value; an unknown or missing value is all zeros."""
    return [
        F.when(F.col(column) == F.lit(v), 1).otherwise(0).alias(f"{prefix}_{v}")
        for v in values
    ]


def one_hot_union_values(train: DataFrame, test: DataFrame, column: str) -> list[str]:
    return wide_values(distinct_union(train, test, column), column)


def fit_dictionary(df: DataFrame, column: str, missing: str | None = "Unknown") -> tuple[DataFrame, int]:
    """State: a stored table (label, code) of all values in the order of their text, and how many there are.

    Nothing of it goes to the driver, whatever the number of values. A missing value is ``missing``, or no value if that is None.
    """
    column_text = F.col(f"`{column}`").cast("string")
    labels = df.select((column_text if missing is None else F.coalesce(column_text, F.lit(missing))).alias("label"))
    codes = durable(fit_labels(labels.where("label IS NOT NULL"), "label"))
    return codes, codes.count()


def hot_vector(code: Column, size: int, name: str) -> Column:
    """A sparse vector of ``size`` slots with a 1 at ``code``; a missing code sets none."""
    text = F.when(code.isNotNull(), F.concat(F.lit('"indices":['), code.cast("string"), F.lit('],"values":[1.0]'))).otherwise('"indices":[],"values":[]')
    whole = F.concat(F.lit('{"v":{"type":0,"size":%d,' % size), text, F.lit("}}"))
    vector = F.from_json(whole, T.StructType([T.StructField("v", VectorUDT())]))["v"]
    return vector.alias(name, metadata=_slots(size))


def _slots(size: int) -> dict:
    return {"ml_attr": {"num_attrs": size}}


def apply_dictionary(df: DataFrame, codes: DataFrame, size: int, column: str, out: str, missing: str | None = "Unknown") -> DataFrame:
    """Add the sparse vector ``out`` of ``column``; values that the dictionary does not hold set no slot."""
    text = F.col(f"`{column}`").cast("string")
    keyed = df.withColumn("label", text if missing is None else F.coalesce(text, F.lit(missing)))
    # A vector is made for each value, not for each row; only rows whose value is not held need the empty one.
    hot = lookup(keyed, codes.select("label", hot_vector(F.col("code"), size, "_hot")), "label")
    vector = F.coalesce("_hot", hot_vector(F.lit(None).cast("int"), size, "_hot"))
    return hot.select(*[F.col(f"`{c}`") for c in df.columns], vector.alias(out, metadata=_slots(size)))


def one_hot_union_dictionary(train: DataFrame, test: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The dictionary of the values of either table; missing values have none."""
    return fit_dictionary(distinct_union(train, test, column), column, missing=None)


def fit_target_means(
    df: DataFrame, column: str, target: str, smoothing: float = 10.0, min_leaf: int = 20
) -> DataFrame:
    """State: per category the target mean, blended with the overall mean by category size.

    The row with a null category holds the overall mean, for categories never seen.
    """
    sums = df.groupBy(column).agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(target).alias("n")).persist()
    total = sums.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    prior = F.lit(float(total["s"] or 0.0) / max(int(total["n"] or 0), 1))
    weight = 1 / (1 + F.exp(-(F.col("n") - min_leaf) / F.lit(smoothing)))
    seen = sums.where(F.col(column).isNotNull()).select(
        column, (prior * (1 - weight) + F.col("s") / F.col("n") * weight).alias("encoded")
    )
    unseen = sums.limit(1).select(F.lit(None).cast("string").alias(column), prior.alias("encoded"))
    return seen.unionByName(unseen)


def apply_target_means(
    df: DataFrame, state: DataFrame | None, column: str, out: str, default: float = 0.5
) -> DataFrame:
    """Encode a column; without any state every row gets ``default``."""
    if state is None:
        return df.withColumn(out, F.lit(default))
    prior = state.where(F.col(column).isNull()).first()["encoded"]
    seen = state.where(F.col(column).isNotNull()).select(F.col(column), F.col("encoded").alias("_encoded"))
    return lookup(df, seen, column).select(
        *df.columns, F.coalesce("_encoded", F.lit(prior)).alias(out)
    )


def ordered_target_means(
    df: DataFrame, column: str, target: str, order: str, out: str, a: float = 1.0, **running
) -> DataFrame:
    """Each row sees only earlier rows of its category: (sum before + prior * a) / (count before + a)."""
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y)).first()[0]
    sums = {"_s": y, "_n": F.lit(1).cast("long")}
    totals = running_totals(df, [column], [F.col(order).asc()], sums, **running)
    before = (F.col("_s") - y + F.lit(prior * a)) / (F.col("_n") - 1 + F.lit(a))
    return totals.select(*df.columns, before.alias(out))


def fit_ordered_totals(df: DataFrame, column: str, target: str, a: float = 1.0) -> DataFrame:
    """State of the ordered encoder for new rows: totals over all training rows."""
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y)).first()[0]
    return df.groupBy(column).agg(((F.sum(y) + prior * a) / (F.count(y) + a)).alias("encoded"))


def cardinality_info(df: DataFrame, columns: list[str], default: int = 2) -> DataFrame:
    """Position and distinct count of each categorical column; a column that is absent gets a default."""
    there = [c for c in columns if c in df.columns]
    places = df.sparkSession.createDataFrame(
        [(df.columns.index(c) if c in there else -1, c) for c in columns], "position int, column_name string"
    )
    if not there:
        return places.withColumn("n_distinct", F.lit(default).cast("long"))
    n = F.when(F.col("position") < 0, F.lit(default).cast("long")).otherwise(F.col("n_distinct"))
    return places.join(count_distinct(df, there), "column_name", "left").select("position", "column_name", n.alias("n_distinct"))


def normalise_predictions(df: DataFrame, state: DataFrame, column: str, out: str = "code") -> DataFrame:
    """Label text to its code, else an integer read from the text, else -1."""
    table = state.select(F.col("label").alias(column), F.col("code").alias("_code"))
    number = F.col(column).try_cast("int")
    return lookup(df, table, column).select(
        *df.columns, F.coalesce(F.col("_code"), number, F.lit(-1)).alias(out)
    )
