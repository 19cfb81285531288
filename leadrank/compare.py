"""Compare a query result with its oracle, used by tests and tools."""

from __future__ import annotations

from pathlib import Path

# The test tables.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or type(value).__name__ == "NAType":
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        if value != value:
            return None
        return int(value) if value.is_integer() else value
    return value


def differences(ours, theirs) -> str:
    """Empty when both frames hold the same rows; else a short description."""
    left, right = sorted(ours.columns), sorted(theirs.columns)
    if left != right:
        return f"columns {left} / {right}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"

    def rows(frame):
        columns = [[_plain(v) for v in frame[c]] for c in left]
        return sorted(zip(*columns), key=repr)

    a, b = rows(ours), rows(theirs)
    if a == b:
        return ""
    apart = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(apart)} rows differ, first {str(apart[0])[:600]}"
