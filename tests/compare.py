"""Compare a Spark query with its SQL counterpart, row for row and type for type."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, con, sql: str, limit: int = 5) -> list[str]:
    """What differs, in words; empty when both agree."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    theirs = _rows(names, relation.fetchall())
    ours = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if not kinds[name].upper().startswith(_KINDS.get(kind, kind.upper())):
            found.append(f"type of {name}: {kind} against {kinds[name]}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} against {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, columns {sorted(names)}")
        found += [f"  {a} against {b}" for a, b in wrong[:limit]]
    return found
