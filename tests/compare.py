"""Order-free comparison of a Spark result with the same query in DuckDB."""

import math

import duckdb

from catalog.shapes import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else f"{float(value):.6f}"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
          "boolean": "BOOLEAN"}


def differences(frame, con, sql):
    """Empty when both results have the same columns, types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    out = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    kinds = {d[0]: str(d[1]) for d in result.description}
    for name, kind in frame.dtypes:
        if _KINDS.get(kind, kind) != kinds[name]:
            out.append(f"type of {name}: {kind} against {kinds[name]}")
    mine, theirs = _rows(frame.columns, frame.collect()), _rows(names, result.fetchall())
    if len(mine) != len(theirs):
        out.append(f"{len(mine)} rows against {len(theirs)}")
    if mine != theirs:
        a, b = sorted(set(mine) - set(theirs))[:2], sorted(set(theirs) - set(mine))[:2]
        out.append(f"columns {sorted(frame.columns)}\n  only here {a}\n  only there {b}")
    return out
