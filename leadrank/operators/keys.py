"""Key tables: weighted phrases, sectors or centroids compared with every row.

A key table is small in practice (a dozen phrases, some thousand sectors), and
then it is one broadcast matrix: each row is compared with all keys where it
lies, with no join. Its size in bytes is checked first. A larger key table comes
in several parts within that size, and rows meet one part after the other, still
where they lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

#: Largest key table, or part of one, that is broadcast.
MAX_KEY_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Key:
    name: str
    weight: float


@dataclass(frozen=True)
class KeyTable:
    """Keys as columns, in order: dense vectors as a matrix, sparse ones as Arrow lists of (dim, v)."""

    names: list[str]
    weights: object
    order: list[tuple]
    vec: object = None
    terms: object = None

    def __len__(self) -> int:
        return len(self.names)

    def part(self, start: int, stop: int) -> "KeyTable":
        cut = slice(start, stop)
        terms = None if self.terms is None else self.terms.slice(start, max(0, min(stop, len(self)) - start))
        return KeyTable(self.names[cut], self.weights[cut], self.order[cut], None if self.vec is None else self.vec[cut], terms)


def _sized(keys: DataFrame):
    """Bytes of a key row, as they are held."""
    size = F.lit(64).cast("bigint") + F.octet_length("name")
    for name, width in (("vec", 8), ("terms", 16)):
        if name in keys.columns:
            size = size + width * F.greatest(F.size(name), F.lit(0))
    return size


def _fetched(keys: DataFrame) -> KeyTable:
    """The key rows as Arrow columns on the driver, ordered by ``pos``, if there is one, and name."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from leadrank.functions.vectors import matrix_of

    shape = [F.col("vec").cast("array<double>").alias("vec")] if "vec" in keys.columns else []
    shape += ["terms"] if "terms" in keys.columns else []
    pos = F.col("pos") if "pos" in keys.columns else F.lit(0)
    found = keys.select("name", F.col("weight").cast("double").alias("weight"), pos.cast("bigint").alias("pos"), *shape).toArrow()
    # A null name has its place before all others.
    found = found.take(pc.sort_indices(found, [("pos", "ascending"), ("name", "ascending")], null_placement="at_start"))
    columns = {name: found.column(name).combine_chunks() for name in found.column_names}
    columns = {name: c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for name, c in columns.items()}
    names = columns["name"].to_pylist()
    return KeyTable(
        names,
        columns["weight"].to_numpy(zero_copy_only=False).astype(np.float64),
        list(zip(columns["pos"].to_pylist(), names, strict=True)),
        matrix_of(columns["vec"]) if "vec" in columns else None,
        columns.get("terms"),
    )


def _known_bytes(keys: DataFrame) -> int | None:
    """Bytes of a table that is on the driver already, which the planner knows exactly; None for any other."""
    plan = keys._jdf.queryExecution().optimizedPlan()
    return int(plan.stats().sizeInBytes()) if plan.getClass().getSimpleName() == "LocalRelation" else None


def _bytes(keys: DataFrame) -> int:
    known = _known_bytes(keys)
    return known if known is not None else int(keys.agg(F.sum(_sized(keys)).alias("bytes")).first()["bytes"] or 0)


def key_tables(keys: DataFrame, max_bytes: int | None = None) -> list[KeyTable]:
    """The key table in parts of at most ``max_bytes``; one part, perhaps an empty one, where it fits."""
    limit = MAX_KEY_BYTES if max_bytes is None else max_bytes
    total = _bytes(keys)
    if total <= limit:
        return [_fetched(keys)]
    # Twice as many parts as needed on average, so that an uneven one fits as well.
    n = 2 * -(-total // limit)
    parts = [_fetched(keys.where(F.pmod(F.xxhash64("name"), F.lit(n)) == k)) for k in range(n)]
    return [part for part in parts if len(part)]


def local_keys(keys: DataFrame, max_bytes: int | None = None) -> list[Key] | None:
    """Names and weights on the driver, or None when they are too large."""
    plain = keys.select("name", "weight", *(["pos"] if "pos" in keys.columns else []))
    limit = MAX_KEY_BYTES if max_bytes is None else max_bytes
    if _bytes(plain) > limit:
        return None
    found = _fetched(plain)
    return [Key(name, float(weight)) for name, weight in zip(found.names, found.weights, strict=True)]
