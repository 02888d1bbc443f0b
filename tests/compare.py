"""Compare a query with its SQL twin: rows as multisets, values exact or within 1e-9."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import numpy as np

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_twin(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value is np.nan:
        return None
    if isinstance(value, (float, np.floating)):
        return None if math.isnan(value) else float(f"{float(value):.12g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(v) for v in value)
    return value


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def differences(df, con, twin: str) -> list[str]:
    """What differs between the frame and the SQL; empty when they agree."""
    cursor = con.execute(twin)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} against {kinds[name]}")
    order = sorted(names)
    spots = [names.index(c) for c in order]
    mine = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[i]) for i in spots) for r in expected), key=repr)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    if mine != theirs:
        pairs = [(a, b) for a, b in zip(mine, theirs) if a != b]
        found.append(f"{len(pairs)} rows differ, first {order}: {pairs[:2]}")
    return found
