"""Exact order statistics of columns of any length, without sorting or gathering a column.

An interval that holds a wanted rank is cut into equal-width cells; one pass over the table counts
the values of every cell of every open interval, and the cell with the rank becomes the next
interval. Passes repeat until the values left fit one task or are all equal. The driver only sees
cell counts, and the passes are scans with a small aggregate: a task counts its Arrow batches by numpy,
so no row is made for each of a table's columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.sizing import ONE_TASK_ROWS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CELLS = 4096
_ALL_CELLS = 1 << 17
_LEAST_CELLS = 32


@dataclass(frozen=True)
class Interval:
    """Values of a column in [low, high]: how many there are, and how many are smaller."""

    column: str
    low: float
    high: float
    count: int
    before: int = 0

    def holds(self):
        x = F.col(f"`{self.column}`")
        return (x >= F.lit(self.low)) & (x <= F.lit(self.high))

    def is_wide(self, one_task_rows: int) -> bool:
        return self.count > one_task_rows and self.high > self.low


_NUMBERS = ("double", "float", "long", "integer", "short", "byte")


def _values(column: pa.Array) -> np.ndarray:
    """The values that are not null, as doubles or 64-bit whole numbers."""
    x = column.drop_null().to_numpy(zero_copy_only=False)
    return x.astype(np.float64 if x.dtype.kind == "f" else np.int64, copy=False)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows, per column: how many numbers, the least and greatest, how many below and above all and not a number."""
    found: dict[int, list] = {}
    for batch in batches:
        for i, column in enumerate(batch.columns):
            x = _values(column)
            one = found.setdefault(i, [i, 0, None, None, None, None, 0, 0, 0])
            at = 2
            if x.dtype.kind == "f":
                at, plain = 4, np.isfinite(x)
                if not plain.all():
                    odd, x = x[~plain], x[plain]
                    for k, n in enumerate((odd == -np.inf, odd == np.inf, np.isnan(odd))):
                        one[6 + k] += int(n.sum())
            if len(x):
                low, high = x.min().item(), x.max().item()
                one[1] += len(x)
                one[at] = low if one[at] is None else min(one[at], low)
                one[at + 1] = high if one[at + 1] is None else max(one[at + 1], high)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["i", "n", "low_whole", "high_whole", "low_real", "high_real", "below", "above", "nan"]
    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found.values()], t) for k, t in enumerate(kinds)], names=names)


def _whole(df: DataFrame, columns: list[str]) -> dict[str, list[Interval]]:
    """Intervals of all values per column that has any, in order: below all numbers, the numbers, above, not a number.

    Infinities and NaN are intervals of one value, so that only finite ends are ever halved.
    """
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    out = {}
    other = [c for c in columns if kinds[c] not in _NUMBERS]
    if other:
        marks = [f(F.col(f"`{c}`")).alias(f"{f.__name__}{i}") for i, c in enumerate(other) for f in (F.count, F.min, F.max)]
        row = df.agg(*marks).first()
        out = {c: [Interval(c, row[f"min{i}"], row[f"max{i}"], row[f"count{i}"])] for i, c in enumerate(other) if row[f"count{i}"]}
    numbers = [c for c in columns if kinds[c] in _NUMBERS]
    if not numbers:
        return out
    schema = "i int, n bigint, low_whole bigint, high_whole bigint, low_real double, high_real double, below bigint, above bigint, nan bigint"
    ends = df.select(*[F.col(f"`{c}`") for c in numbers]).mapInArrow(_ends, schema).groupBy("i").agg(
        *[F.sum(c).alias(c) for c in ("n", "below", "above", "nan")],
        *[f(f"{e}_{v}").alias(f"{e}_{v}") for v in ("whole", "real") for e, f in (("low", F.min), ("high", F.max))],
    )
    for row in ends.collect():  # one row per column
        c = numbers[row["i"]]
        kind = "real" if kinds[c] in ("double", "float") else "whole"
        parts, before = [], 0
        for low, high, n in (
            (float("-inf"), float("-inf"), row["below"]), (row[f"low_{kind}"], row[f"high_{kind}"], row["n"]),
            (float("inf"), float("inf"), row["above"]), (float("nan"), float("nan"), row["nan"]),
        ):
            if n:
                parts.append(Interval(c, low, high, n, before))
                before += n
        if parts:
            out[c] = parts
    return out


def _total(parts: list[Interval]) -> int:
    return parts[-1].before + parts[-1].count


def _cell_counts(spots: list[tuple], most: int):
    """Of a task's rows, how many values lie in each of the ``most`` cells of each interval (column, low, high), and their ends."""
    whole = np.array([isinstance(low, int) for _, low, _ in spots])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(spots), most), np.int64)
        least, greatest = np.full(n.shape, np.inf), np.full(n.shape, -np.inf)
        first, last = np.full(n.shape, np.iinfo(np.int64).max), np.full(n.shape, np.iinfo(np.int64).min)
        for batch in batches:
            for j, (i, low, high) in enumerate(spots):
                x = _values(batch.column(i))
                x = x[(x >= low) & (x <= high)]
                if whole[j]:
                    # Distances of large numbers stay exact.
                    share = (x.view(np.uint64) - np.uint64(low % 2**64)).astype(np.float64) / float(high - low)
                else:
                    # Halves, so that the distance of the greatest numbers stays finite.
                    width = high * 0.5 - low * 0.5
                    share = (x * 0.5 - low * 0.5) / width if width > 0 else (x > low).astype(np.float64)
                cell = np.minimum(np.floor(share * most), most - 1).astype(np.int64)
                n[j] += np.bincount(cell, minlength=most)
                np.minimum.at((first if whole[j] else least)[j], cell, x)
                np.maximum.at((last if whole[j] else greatest)[j], cell, x)
        j, cell = np.nonzero(n)
        ends = [pa.array(v[j, cell], mask=skip[j]) for v, skip in ((first, ~whole), (last, ~whole), (least, whole), (greatest, whole))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(j.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(n[j, cell]), *ends],
            names=["j", "cell", "n", "low_whole", "high_whole", "low_real", "high_real"],
        )

    return run


def _spots(intervals: list[Interval]) -> tuple[list[str], list[tuple]]:
    """The columns of intervals, and each interval as (place of its column, low, high)."""
    columns = list(dict.fromkeys(p.column for p in intervals))
    return columns, [(columns.index(p.column), p.low, p.high) for p in intervals]


def _cells(df: DataFrame, intervals: list[Interval]) -> dict[Interval, list[Interval]]:
    """The non-empty cells of every interval, in order, from one pass.

    All intervals share ``_ALL_CELLS`` cells, and a row for a cell has the same few columns however many columns the table
    has: the least and greatest value, as a whole number or as a double.
    """
    most = max(_LEAST_CELLS, min(_CELLS, _ALL_CELLS // len(intervals)))
    columns, spots = _spots(intervals)
    schema = "j int, cell int, n bigint, low_whole bigint, high_whole bigint, low_real double, high_real double"
    hits = df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(_cell_counts(spots, most), schema)
    ends = [f(f"{e}_{v}").alias(f"{e}_{v}") for v in ("whole", "real") for e, f in (("low", F.min), ("high", F.max))]
    rows = hits.groupBy("j", "cell").agg(F.sum("n").alias("n"), *ends).collect()
    out: dict[Interval, list[Interval]] = {p: [] for p in intervals}
    for row in sorted(rows, key=lambda r: (r["j"], r["cell"])):
        part = intervals[row["j"]]
        kind = "whole" if isinstance(part.low, int) else "real"
        before = out[part][-1].before + out[part][-1].count if out[part] else part.before
        out[part].append(Interval(part.column, row[f"low_{kind}"], row[f"high_{kind}"], row["n"], before))
    return out


def _values_inside(spots: list[tuple]):
    """Of a task's rows the values of each interval (column, low, high): (i, whole, real)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j, (i, low, high) in enumerate(spots):
                x = _values(batch.column(i))
                x = x[(x >= low) & (x <= high)]
                if len(x):
                    both = [pa.array(x) if (x.dtype.kind == "f") == real else pa.nulls(len(x), t) for real, t in ((False, pa.int64()), (True, pa.float64()))]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), j, np.int32)), *both], names=["i", "whole", "real"])

    return run


def _at(cells: list[Interval], rank: int) -> Interval:
    """The cell that holds a 0-based rank."""
    return next(c for c in cells if rank < c.before + c.count)


def locate(df: DataFrame, wanted: dict, one_task_rows: int) -> dict:
    """Narrow ``{key: (interval, rank)}`` until every interval fits one task or holds one value."""
    found = dict(wanted)
    while True:
        wide = list(dict.fromkeys(p for p, _ in found.values() if p.is_wide(one_task_rows)))
        if not wide:
            return found
        cells = _cells(df.select(*dict.fromkeys(p.column for p in wide)), wide)
        found = {k: (_at(cells[p], r), r) if p in cells else (p, r) for k, (p, r) in found.items()}


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probability: float = 0.5,
    one_task_rows: int = ONE_TASK_ROWS,
) -> dict[str, float | None]:
    """Linearly interpolated quantile of each column, nulls left out.

    What is left of all columns together fits one task of ``one_task_rows`` values.
    """
    columns = list(columns)
    if not columns:
        return {}
    # Decimals become doubles, as their quantiles are.
    df = df.select(*[F.col(f"`{c}`").cast("double").alias(c) if df.schema[c].dataType.typeName() == "decimal" else F.col(f"`{c}`") for c in columns])
    wholes = _whole(df, columns)
    place = {c: (_total(p) - 1) * probability for c, p in wholes.items()}
    wanted = {(c, end): (_at(p, end(place[c])), end(place[c])) for c, p in wholes.items() for end in (math.floor, math.ceil)}
    ends = locate(df, wanted, max(1, one_task_rows // max(1, len(set(wanted.values())))))
    found = {spot: float(spot[0].low) for spot in ends.values()}
    mixed = [spot for spot in found if spot[0].low < spot[0].high]
    if mixed:
        used, spots = _spots([p for p, _ in mixed])
        inside = df.select(*[F.col(f"`{c}`") for c in used]).mapInArrow(_values_inside(spots), "i int, whole bigint, real double")
        # Each interval has at most one_task_rows rows, and so have all together.
        number = F.row_number().over(Window.partitionBy("i").orderBy("whole", "real"))
        asked = F.get(F.array(*[F.lit(r - p.before + 1) for p, r in mixed]), F.col("i"))
        for row in inside.withColumn("number", number).where(F.col("number") == asked).collect():  # one row per spot
            found[mixed[row["i"]]] = float(row["real"] if row["whole"] is None else row["whole"])
    out = {}
    for c in columns:
        if c not in wholes:
            out[c] = None
            continue
        low, high = found[ends[(c, math.floor)]], found[ends[(c, math.ceil)]]
        share = place[c] - math.floor(place[c])
        out[c] = low if low == high or not share else low + (high - low) * share
    return out


def rows_at_ranks(
    df: DataFrame, value: str, tie: str, ranks: list[int], one_task_rows: int = ONE_TASK_ROWS
) -> list[tuple]:
    """(value, tie) of the rows with the given 1-based ranks in the order of value, then tie.

    ``tie`` is numeric and unique. A value shared by more rows than fit one task is resolved by
    narrowing the tie column among its rows.
    """
    data = df.select(value, tie).where(F.col(value).isNotNull())
    kind = data.schema[value].dataType
    if kind.typeName() in ("date", "timestamp"):
        # Days or microseconds in place of the dates, and back.
        to = F.unix_date if kind.typeName() == "date" else F.unix_micros
        back = F.date_from_unix_date if kind.typeName() == "date" else F.timestamp_micros
        found = rows_at_ranks(data.withColumn(value, to(F.col(value))), value, tie, ranks, one_task_rows)
        row = data.limit(0).sparkSession.range(1).select(*[back(F.lit(v)).alias(f"v{i}") for i, (v, _) in enumerate(found)]).first()
        return [(row[i], t) for i, (_, t) in enumerate(found)]
    if data.schema[tie].dataType.typeName() not in ("long", "integer", "short", "byte", "double", "float"):
        raise TypeError(f"{tie} must be numeric")
    whole = _whole(data, [value])[value]
    spots = locate(data, {r: (_at(whole, r - 1), r - 1) for r in ranks}, one_task_rows)
    out: dict[int, tuple] = {}
    small: dict[Interval, list[int]] = {}
    for rank, (part, place) in spots.items():
        if part.count <= one_task_rows:
            small.setdefault(part, []).append(rank)
        else:
            same = data.where(F.col(value) == F.lit(part.low)).select(tie)
            ties = _whole(same, [tie])[tie]
            inner, _ = locate(same, {rank: (_at(ties, place - part.before), place - part.before)}, one_task_rows)[rank]
            order = place - part.before - inner.before
            # One interval of at most one_task_rows rows.
            row = same.where(inner.holds()).orderBy(tie).offset(order).limit(1).first()
            out[rank] = (part.low, row[tie])
    if small:
        parts = list(small)
        tags = F.array(*[F.when(p.holds(), F.lit(i)) for i, p in enumerate(parts)])
        tagged = data.where(F.exists(tags, lambda t: t.isNotNull())).select(
            value, tie, F.explode(F.filter(tags, lambda t: t.isNotNull())).alias("part")
        )
        order = Window.partitionBy("part").orderBy(value, tie)
        picks = [(i, r - p.before, r) for i, p in enumerate(parts) for r in small[p]]
        hit = F.struct("part", "place").isin([F.struct(F.lit(i), F.lit(p)) for i, p, _ in picks])
        ranked = tagged.withColumn("place", F.row_number().over(order)).where(hit).collect()
        by_place = {(r["part"], r["place"]): (r[value], r[tie]) for r in ranked}
        out |= {r: by_place[(i, p)] for i, p, r in picks}
    return [out[r] for r in ranks]


def is_after(value: str, tie: str, row: tuple):
    """Whether a row comes after the given (value, tie)."""
    x, t = F.col(value), F.col(tie)
    return (x > F.lit(row[0])) | ((x == F.lit(row[0])) & (t > F.lit(row[1])))
