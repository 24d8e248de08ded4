"""Run registered queries and compare them with their SQL by rows, columns and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from rowloom.session import local_session  # noqa: E402
from rowloom.sources.files import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "tolist") and not isinstance(value, str):
        value = value.tolist()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


# Spark type -> type of the comparison engine; arrays are not compared.
SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
}


def declared_types(df, description) -> list[str]:
    """Columns whose declared types differ."""
    want = {d[0]: str(d[1]) for d in description}
    return [
        f"{f.name}: {f.dataType.simpleString()} vs {want[f.name]}"
        for f in df.schema.fields if SAME_TYPE.get(f.dataType.simpleString()) != want[f.name]
    ]


def types_of(rows: list[tuple]) -> list[str]:
    out = []
    for i in range(len(rows[0]) if rows else 0):
        kinds = {type(r[i]).__name__ for r in rows if r[i] is not None}
        out.append("/".join(sorted(kinds)))
    return out


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, str]:
    df = entry.queries()[name](spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return ("rows" if got_rows else "EMPTY"), f"{len(got_rows)} rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return "COLUMNS", f"{sorted(df.columns)} vs {sorted(columns)}"
    differ = declared_types(df, result.description)
    if differ:
        return "SCHEMA", "; ".join(differ)
    got, want = rows_of(df.columns, got_rows), rows_of(columns, want_rows)
    if len(got) != len(want):
        return "COUNT", f"{len(got)} vs {len(want)}"
    if types_of(got) != types_of(want):
        return "TYPES", f"{list(zip(sorted(columns), types_of(got), types_of(want)))}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return "VALUES", f"{len(bad)} of {len(got)} differ, e.g. {bad[0]}"[:600]
    return "ok", f"{len(got)} rows"


if __name__ == "__main__":
    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    session = local_session(8)
    connection = connect(folder)
    for n in names:
        start = time.time()
        try:
            status, note = compare(session, connection, n, folder)
        except Exception as error:  # noqa: BLE001
            status, note = "ERROR", f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{status:8s} {n:28s} {time.time() - start:6.2f}s  {note}", flush=True)
        session.catalog.clearCache()
