"""Date, text, block and numeric features."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import blocks, dates, numeric, text
from rowloom.functions.ordinal import ORDINAL_MAPS, ordinal_map
from rowloom.operators import encode, features, scale
from rowloom.plans import fixtures as fx
from rowloom.plans.registry import query, rnd, rounded
from rowloom.sources.files import table

WITH = f"WITH {fx.MESSY_SQL}"


def _ym(y: int, m: int) -> str:
    return (
        f"coalesce(TRY_CAST(substr(posted, 1, 4) AS INTEGER), {y}) AS year, "
        f"coalesce(TRY_CAST(nullif(split_part(posted, '/', 2), '') AS INTEGER), {m}) AS month"
    )


DATED = WITH + f", dated AS (SELECT obs, {_ym(1900, 1)} FROM messy) "


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    year, month = dates.lenient_year_month(F.col("posted"))
    return fx.messy_orders(spark, sf).select("obs", year.alias("year"), month.alias("month"))


@query(
    "parse_year_month",
    WITH + f", a AS (SELECT obs, posted, {_ym(1900, 1)} FROM messy), b AS (SELECT obs, {_ym(2000, 1)} FROM messy), "
    "c AS (SELECT obs, coalesce(regexp_matches(posted, '^[0-9]{4}/(0?[1-9]|1[0-2])$'), FALSE) AS valid FROM messy) "
    "SELECT a.obs, a.year, a.month, b.year AS year_2000, "
    "CASE WHEN c.valid THEN a.year ELSE 2020 END AS year_strict, CASE WHEN c.valid THEN a.month ELSE 1 END AS month_strict "
    "FROM a JOIN b USING (obs) JOIN c USING (obs)",
)
def parse_year_month(spark: SparkSession, sf: str) -> DataFrame:
    posted = F.col("posted")
    year, month = dates.lenient_year_month(posted)
    other, _ = dates.lenient_year_month(posted, 2000)
    strict_year, strict_month = dates.strict_year_month(posted)
    return fx.messy_orders(spark, sf).select(
        "obs", year.alias("year"), month.alias("month"), other.alias("year_2000"),
        strict_year.alias("year_strict"), strict_month.alias("month_strict"),
    )


@query("clip_month", DATED + "SELECT obs, least(greatest(month, 1), 12) AS month FROM dated")
def clip_month(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select("obs", dates.clip_month(F.col("month")).alias("month"))


@query("cyclic_month", DATED + "SELECT obs, " + rnd("sin(2 * pi() * month / 12.0)", "month_sin") + ", " + rnd("cos(2 * pi() * month / 12.0)", "month_cos") + " FROM dated")
def cyclic_month(spark: SparkSession, sf: str) -> DataFrame:
    sin, cos = dates.cyclic_month(F.col("month"))
    return _dated(spark, sf).select("obs", rounded(sin, "month_sin"), rounded(cos, "month_cos"))


@query(
    "recency_months",
    DATED + ", ref AS (SELECT CASE WHEN max(year) > 1900 THEN max(year) ELSE 2024 END AS ry, "
    "CASE WHEN max(year) > 1900 THEN arg_max(month, year * 1000 + month) ELSE 12 END AS rm FROM dated) "
    "SELECT obs, greatest((ry - year) * 12 + (rm - month), 0) AS recency FROM dated, ref",
)
def recency_months(spark: SparkSession, sf: str) -> DataFrame:
    df = _dated(spark, sf)
    return features.recency_months(df, features.fit_latest_month(df)).select("obs", "recency")


@query("absolute_month", DATED + "SELECT obs, year * 12 + month AS job_recency FROM dated")
def absolute_month(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select("obs", dates.absolute_month(F.col("year"), F.col("month")).alias("job_recency"))


@query(
    "year_norm",
    DATED + "SELECT obs, " + rnd("year - (SELECT coalesce(avg(year) FILTER (WHERE year > 1900), 2020) FROM dated)", "year_norm")
    + ", year - 2022 AS year_fixed FROM dated",
)
def year_norm(spark: SparkSession, sf: str) -> DataFrame:
    df = _dated(spark, sf)
    centred = features.year_norm(df, features.fit_mean_year(df))
    return centred.select("obs", rounded("year_norm"), (F.col("year") - 2022).alias("year_fixed"))


@query("quarter", DATED + "SELECT obs, CAST(floor((least(greatest(month, 1), 12) - 1) / 3.0) + 1 AS INTEGER) AS quarter FROM dated")
def quarter(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select("obs", dates.quarter_of(dates.clip_month(F.col("month"))).alias("quarter"))


def _flag_columns(prefix: str, words: dict[str, str], column: str) -> list[str]:
    return [
        f"CAST(regexp_matches(lower(coalesce({column}, 'unknown')), '{p}') AS INTEGER) AS {prefix}_{n}"
        for n, p in words.items()
    ]


@query(
    "title_flags",
    f"WITH {fx.TITLES_SQL} SELECT partkey, "
    + ", ".join(c for t, words in text.TITLE_KEYWORDS.items() for c in _flag_columns(t, words, "title")) + " FROM titles",
)
def title_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.derive(spark, sf, "part", fx.JOB_TITLES)
    flags = []
    for name, words in text.TITLE_KEYWORDS.items():
        flags += text.keyword_flags(F.col("title"), {f"{name}_{n}": p for n, p in words.items()})
    return df.select("partkey", *flags)


@query(
    "title_flags_documents",
    "SELECT doc_id, " + ", ".join(_flag_columns("intermediate", text.TITLE_KEYWORDS["intermediate"], "text")) + " FROM documents",
)
def title_flags_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The same flags over whole texts."""
    words = {f"intermediate_{n}": p for n, p in text.TITLE_KEYWORDS["intermediate"].items()}
    return table(spark, sf, "documents").select("doc_id", *text.keyword_flags(F.col("text"), words))


@query(
    "region_flags",
    f"WITH {fx.STATES_SQL} SELECT custkey, state, " + ", ".join(
        f"CASE WHEN state IN ({', '.join(repr(c) for c in codes)}) THEN 1 ELSE 0 END AS region_{r}" for r, codes in text.US_REGIONS.items()
    ) + " FROM states",
)
def region_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.derive(spark, sf, "customer", fx.CUSTOMER_STATES)
    return df.select("custkey", "state", *text.region_flags(F.col("state")))


@query(
    "rare_category_group",
    "WITH c AS (SELECT p_name, count(*) AS n FROM part GROUP BY p_name) "
    "SELECT p_partkey, CASE WHEN n >= 30 THEN p_name ELSE 'Other_Title' END AS title FROM part JOIN c USING (p_name)",
)
def rare_category_group(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    kept = encode.group_rare(part, "p_name", threshold=30)
    return encode.apply_group_rare(part, kept, "p_name", "title").select("p_partkey", "title")


@query(
    "topn_category_cap",
    "WITH k AS (SELECT p_name FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 20) "
    "SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM k) THEN p_name ELSE 'Other' END AS title FROM part",
)
def topn_category_cap(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    kept = encode.fit_top_categories(part, "p_name", 20)
    return encode.apply_group_rare(part, kept, "p_name", "title", "Other").select("p_partkey", "title")


def _map_sql(column: str, ranks: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {r}" for v, r in ranks.items()) + f" END AS {column}"


_RANKED = ["level", "education", "age_bucket", "years_experience_bucket"]


@query(
    "ordinal_map",
    f"WITH t AS (SELECT {fx.select_list(fx.ORDINALS)} FROM orders) SELECT obs, "
    + ", ".join(_map_sql(c, ORDINAL_MAPS[c]) for c in _RANKED) + " FROM t",
)
def ordinal_maps(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.derive(spark, sf, "orders", fx.ORDINALS)
    return df.select("obs", *[ordinal_map(F.col(c), ORDINAL_MAPS[c]).alias(c) for c in _RANKED])


VEC = f"WITH {fx.VECTORS_SQL} SELECT id, "


@query(
    "row_stats",
    VEC + ", ".join(
        rnd(e, f"block_{n}") for n, e in {
            "mean": "list_avg(vec)", "std": "list_aggregate(vec, 'stddev_samp')", "sum": "list_sum(vec)",
            "min": "list_min(vec)", "max": "list_max(vec)", "median": "list_median(vec)",
        }.items()
    ) + " FROM vectors",
)
def row_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = fx.vectors(spark, sf).select("id", *blocks.row_stats(F.col("vec"), "block"))
    return stats.select("id", *[rounded(c) for c in stats.columns if c != "id"])


@query(
    "row_nonzero",
    VEC + "CAST(len(list_filter(vec, lambda x: abs(x) >= 0.1)) AS INTEGER) AS block_non_zero_count, "
    + rnd("len(list_filter(vec, lambda x: abs(x) >= 0.1)) / len(vec)", "block_non_zero_ratio") + " FROM vectors",
)
def row_nonzero(spark: SparkSession, sf: str) -> DataFrame:
    """Entries below 0.1 are set to 0 first, since the embeddings hold no zeros."""
    sparse = F.transform("vec", lambda x: F.when(F.abs(x) >= 0.1, x).otherwise(F.lit(0.0)))
    df = fx.vectors(spark, sf).select("id", sparse.alias("vec")).select("id", *blocks.row_nonzero(F.col("vec"), "block"))
    return df.select("id", "block_non_zero_count", rounded("block_non_zero_ratio"))


_Q = "list_aggregate(vec, 'quantile_cont', {q})"


@query(
    "row_quantiles",
    VEC + rnd(_Q.format(q="CAST(0.25 AS DOUBLE)"), "block_q25") + ", " + rnd(_Q.format(q="CAST(0.75 AS DOUBLE)"), "block_q75") + ", "
    + rnd(f"{_Q.format(q='CAST(0.75 AS DOUBLE)')} - {_Q.format(q='CAST(0.25 AS DOUBLE)')}", "block_iqr") + " FROM vectors",
)
def row_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.vectors(spark, sf).select("id", *blocks.row_quantiles(F.col("vec"), "block"))
    return df.select("id", *[rounded(c) for c in df.columns if c != "id"])


@query(
    "power_terms",
    "SELECT p_partkey, " + ", ".join([
        rnd("p_retailprice * p_retailprice", "p_retailprice_squared", 4), rnd("p_retailprice * p_retailprice * p_retailprice", "p_retailprice_cubed", 1),
        rnd("sqrt(abs(p_retailprice))", "p_retailprice_sqrt"), rnd("ln(1 + p_retailprice)", "p_retailprice_log1p"),
        rnd("ln(1 + (p_retailprice - (SELECT min(p_retailprice) FROM part) + 0.000001))", "shifted_log"),
    ]) + " FROM part",
)
def power_terms(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    low, _ = scale.fit_range(part, "p_retailprice")
    shifted = numeric.shifted_log(F.col("p_retailprice"), low)
    df = part.select("p_partkey", *numeric.power_terms("p_retailprice"), shifted.alias("shifted_log"))
    digits = {"p_retailprice_squared": 4, "p_retailprice_cubed": 1}
    return df.select("p_partkey", *[rounded(c, digits=digits.get(c, 6)) for c in df.columns if c != "p_partkey"])


@query(
    "quantile_bin",
    "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r, count(*) OVER () AS n FROM orders) "
    "SELECT o_orderkey, CAST(greatest(((r - 1) * 5 + n - 2) // (n - 1) - 1, 0) AS INTEGER) AS bin FROM r",
)
def quantile_bin(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return scale.quantile_bins(orders, "o_totalprice", "o_orderkey", "bin").select("o_orderkey", "bin")


@query(
    "equal_width_bin",
    "WITH s AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part) "
    "SELECT p_partkey, CAST(greatest(ceil((p_retailprice - lo) / (hi - lo) * 5) - 1, 0) AS INTEGER) AS bin FROM part, s",
)
def equal_width_bin(spark: SparkSession, sf: str) -> DataFrame:
    return scale.equal_width_bins(table(spark, sf, "part"), "p_retailprice", "bin").select("p_partkey", "bin")


LINE_KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]
_NUMBERS = ["l_quantity", "l_discount", "l_tax"]


@query(
    "pair_products",
    "SELECT l_orderkey, l_partkey, l_linenumber, " + ", ".join(rnd(f"{a} * {b}", f"{a}_{b}_interact") for a, b in combinations(_NUMBERS, 2)) + " FROM lineitem",
)
def pair_products(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(*LINE_KEYS, *numeric.pair_products(_NUMBERS))
    return df.select(*LINE_KEYS, *[rounded(c) for c in df.columns if c not in LINE_KEYS])


FLAGS_SQL = f"WITH f AS (SELECT l_orderkey, l_partkey, l_linenumber, {fx.select_list(fx.LINE_FLAGS)} FROM lineitem) "
_FLAGS = list(fx.LINE_FLAGS)


def _flags(spark: SparkSession, sf: str) -> DataFrame:
    return fx.derive(spark, sf, "lineitem", {**{k: k for k in LINE_KEYS}, **fx.LINE_FLAGS})


@query("bool_sum", FLAGS_SQL + f"SELECT l_orderkey, l_partkey, l_linenumber, {' + '.join(_FLAGS)} AS boolean_sum, ({' + '.join(_FLAGS)}) * ({' + '.join(_FLAGS)}) AS boolean_sum_squared FROM f")
def bool_sum(spark: SparkSession, sf: str) -> DataFrame:
    total = numeric.flag_sum(_FLAGS)
    return _flags(spark, sf).select(*LINE_KEYS, total.alias("boolean_sum"), (total * total).alias("boolean_sum_squared"))


@query(
    "bool_pair_logic",
    FLAGS_SQL + "SELECT l_orderkey, l_partkey, l_linenumber, "
    + ", ".join(f"{a} & {b} AS {a}_and_{b}, {a} | {b} AS {a}_or_{b}" for a, b in combinations(_FLAGS, 2)) + " FROM f",
)
def bool_pair_logic(spark: SparkSession, sf: str) -> DataFrame:
    return _flags(spark, sf).select(*LINE_KEYS, *numeric.flag_pair_logic(_FLAGS))


_POLY = ["price", "flag_number", "other_number"]


@query(
    "polynomial_interactions",
    WITH + ", z AS (SELECT obs, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _POLY) + " FROM messy) SELECT obs, "
    + ", ".join([rnd(c, c, 4) for c in _POLY] + [rnd(f"{a} * {b}", f'"{a} {b}"', 4) for a, b in combinations(_POLY, 2)]) + " FROM z",
)
def polynomial_interactions(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.messy_orders(spark, sf).select("obs", *scale.polynomial_interactions(_POLY))
    return df.select("obs", *[rounded(F.col(f"`{c}`"), c, 4) for c in df.columns if c != "obs"])


@query(
    "standard_scale",
    f"WITH {fx.PARTS_SQL}, s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d, avg(c_acctbal) AS m2, stddev_pop(c_acctbal) AS d2 FROM train) "
    "SELECT o_orderkey, " + rnd("(o_totalprice - m) / d", "o_totalprice") + ", " + rnd("(c_acctbal - m2) / d2", "c_acctbal") + " FROM test, s",
)
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    train, test = fx.order_parts(spark, sf)
    names = ["o_totalprice", "c_acctbal"]
    scaled = scale.apply_standard(test.select("o_orderkey", *names), scale.fit_standard(train, names), names)
    return scaled.select("o_orderkey", *[rounded(c) for c in names])


_YJ = "CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1, 0.7) - 1) / 0.7 ELSE -(pow(1 - c_acctbal, 1.3) - 1) / 1.3 END"


@query("yeo_johnson_fixed", "SELECT c_custkey, " + rnd(_YJ, "moved", 4) + " FROM customer")
def yeo_johnson_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", rounded(numeric.yeo_johnson(F.col("c_acctbal"), 0.7), "moved", 4))


_YJ_ANY = (
    "CASE WHEN x >= 0 THEN CASE WHEN l = 0 THEN ln(1 + x) ELSE (pow(x + 1, l) - 1) / l END "
    "ELSE CASE WHEN l = 2 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - l) - 1) / (2 - l) END END"
)


@query(
    "yeo_johnson_lambda",
    "WITH g AS (SELECT CAST(i AS DOUBLE) / 100 AS l FROM unnest(generate_series(-300, 500)) t(i)), x AS (SELECT c_acctbal AS x FROM customer), "
    f"s AS (SELECT l, -count(*) / 2 * ln(var_pop({_YJ_ANY})) + (l - 1) * sum(sign(x) * ln(1 + abs(x))) AS score FROM g CROSS JOIN x GROUP BY l) "
    "SELECT " + rnd("arg_max(l, score)", "lam", 2) + " FROM s",
)
def yeo_johnson_lambda(spark: SparkSession, sf: str) -> DataFrame:
    """The most likely exponent to two places; the SQL tries every hundredth."""
    state = scale.fit_yeo_johnson(table(spark, sf, "customer"), "c_acctbal")
    return state.select(rounded("lam", digits=2))


@query("yeo_johnson")
def yeo_johnson(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted exponent comes from a search, which has no SQL twin."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return scale.apply_yeo_johnson(customer, scale.fit_yeo_johnson(customer, "c_acctbal"), "c_acctbal", "moved")
