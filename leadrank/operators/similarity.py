"""Similarity of rows and keys, soft TF-IDF scores, closest key.

Rows without a vector (no word in the text, a null or zero vector) stay, with
null similarities and scores, and count as rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from leadrank.functions import vectors as V
from leadrank.operators import keys as K
from leadrank.operators.keys import KeyTable, key_tables
from leadrank.session import Reuse, spread

#: Rows whose similarities are computed at once.
STEP_ROWS = 1024


@dataclass(frozen=True)
class Dense:
    """Rows that carry a dense vector column."""

    column: str = "vec"

    def prepared(self, rows: DataFrame) -> tuple[DataFrame, Column]:
        return rows, F.col(self.column).cast("array<double>")

    def tiles(self, table: KeyTable) -> list[KeyTable]:
        """The table in parts whose matrices may be sent."""
        return [table]

    def key_side(self, tables: list[KeyTable]):
        """What a task needs of the keys."""
        import numpy as np

        return V.unit_rows(np.concatenate([t.vec for t in tables])).T

    @staticmethod
    def cosines(side, column):
        import numpy as np

        rows = V.matrix_of(column)
        if rows.shape[1] == 0:
            # No row of the batch has a vector.
            return np.full((len(rows), side.shape[1]), np.nan)
        return V.unit_rows(rows) @ side


@dataclass(frozen=True)
class HashedText:
    """Rows that carry text, embedded as a hashed bag of words where they lie.

    Words are hashed and counted in the JVM; the counts of a batch meet the key
    matrix in numpy. Only slots that some key uses take part in the products,
    but the norm covers the whole text.
    """

    column: str = "text"
    dims: int = 256

    def prepared(self, rows: DataFrame) -> tuple[DataFrame, Column]:
        return spread(rows), V.term_counts(F.col(self.column), self.dims)

    def tiles(self, table: KeyTable) -> list[KeyTable]:
        # A key's row of the matrix is as wide as slots are used.
        used = len(_slots([table])[0])
        step = max(1, K.MAX_KEY_BYTES // (8 * max(1, used)))
        return [table.part(a, a + step) for a in range(0, max(1, len(table)), step)]

    def key_side(self, tables: list[KeyTable]):
        import numpy as np

        used, dim, value, key = _slots(tables)
        matrix = np.zeros((len(used), sum(map(len, tables))))
        np.add.at(matrix, (np.searchsorted(used, dim), key), value)
        return used, matrix

    @staticmethod
    def cosines(side, column):
        import numpy as np
        import pyarrow.compute as pc

        used, matrix = side
        sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
        flat = pc.list_flatten(column)
        dim, n = (np.asarray(flat.field(i), dtype=np.int64) for i in (0, 1))
        row = np.repeat(np.arange(len(sizes)), sizes)
        norm = np.sqrt(np.bincount(row, n * n, len(sizes)))
        at = np.searchsorted(used, dim)
        hit = at < len(used)
        hit[hit] = used[at[hit]] == dim[hit]
        counts = np.zeros((len(sizes), len(used)))
        counts[row[hit], at[hit]] = n[hit]
        with np.errstate(divide="ignore", invalid="ignore"):
            return (counts @ matrix) / np.where(norm > 0, norm, np.nan)[:, None]


def _slots(tables: list[KeyTable]):
    """Slots that some key uses; and slot, value and key number of every term."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pa.chunked_array([t.terms for t in tables]).combine_chunks() if tables else None
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
    flat = pc.list_flatten(lists)
    dim, value = np.asarray(flat.field(0), dtype=np.int64), np.asarray(flat.field(1), dtype=np.float64)
    return np.unique(dim), dim, value, np.repeat(np.arange(len(sizes)), sizes)


def _rounds(groups: dict[str, DataFrame], shape) -> list[dict[str, KeyTable]]:
    """Key tables of all groups, so that those of a round may be sent together; one round where they are small."""
    rounds: list[dict[str, KeyTable]] = [{}]
    for name, keys in groups.items():
        tiles = [t for table in key_tables(keys) for t in shape.tiles(table) if len(t)]
        rounds[0] |= {name: t for t in tiles[:1]}
        rounds += [{name: t} for t in tiles[1:]]
    return [r for r in rounds if r]


def _compared(rows: DataFrame, keep: list[str], keys: list[KeyTable], shape, mode: str, finish, made: StructType) -> DataFrame:
    """``finish(similarities, kept columns)`` of every batch; rows stay where they lie.

    The key matrix is broadcast once; its size was checked by ``key_tables``.
    """
    V._require_mode(mode)
    rows, column = shape.prepared(rows)
    kept = rows.select(*keep, column.alias("_x"))
    schema = StructType([f for f in kept.schema.fields if f.name != "_x"])
    for field in made.fields:
        schema = schema.add(field)
    side = rows.sparkSession.sparkContext.broadcast(shape.key_side(keys))
    cosines = shape.cosines

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                sims = V.similarity_values(cosines(side.value, part.column("_x")), mode)
                arrays = finish(sims, [part.column(c) for c in keep])
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return kept.mapInArrow(run, schema)


def _sims(rows: DataFrame, keep: list[str], keys: list[KeyTable], shape, mode: str) -> DataFrame:
    """``keep`` columns and ``sims``, one similarity per key."""

    def finish(sims, kept):
        return [*kept, V.list_array(sims)]

    return _compared(rows, keep, keys, shape, mode, finish, StructType().add("sims", ArrayType(DoubleType())))


def similarity_rows(rows: DataFrame, row_id: str, keys: DataFrame, shape, mode: str = "mult") -> DataFrame:
    """Long form ``(row_id, name, sim)`` of all similarities."""
    V._require_mode(mode)
    made = StructType().add("name", StringType()).add("sim", DoubleType())

    def tile(table: KeyTable) -> DataFrame:
        names = table.names

        def finish(sims, kept):
            import numpy as np
            import pyarrow as pa

            at = pa.array(np.repeat(np.arange(len(sims)), len(names)))
            return [kept[0].take(at), pa.array(names * len(sims), pa.string()), pa.array(sims.ravel(), from_pandas=True)]

        return _compared(rows, [row_id], [table], shape, mode, finish, made)

    tiles = [tile(t) for r in _rounds({"": keys}, shape) for t in r.values()]
    if not tiles:
        none = F.lit(None)
        return rows.select(row_id, none.cast("string").alias("name"), none.cast("double").alias("sim")).limit(0)
    return reduce(DataFrame.unionAll, tiles)


def soft_idf(total: Column, count: Column) -> Column:
    """ln(rows / summed similarity); null where the sum is not positive."""
    return F.when(total > 0, F.ln(count / total))


def soft_idf_table(rows: DataFrame, row_id: str, keys: DataFrame, shape, mode: str = "mult") -> DataFrame:
    """Per key: ``(name, idf)`` over all rows."""
    sims = similarity_rows(rows, row_id, keys, shape, mode)
    return sims.groupBy("name").agg(soft_idf(F.sum("sim"), F.count(F.lit(1))).alias("idf"))


def soft_scores(
    rows: DataFrame,
    row_id: str,
    groups: dict[str, DataFrame],
    shape,
    mode: str = "mult",
    weighting: str = "soft_idf",
    carry: dict[str, Column] | None = None,
    reuse: Reuse | None = None,
) -> DataFrame:
    """One score per row and key group: the sum of similarity * idf * weight.

    ``groups`` maps an output column to its key table. All groups are compared
    in one pass. With ``weighting="none"`` the idf factor is left out.
    ``carry`` names small columns to keep next to the scores.
    """
    reuse = reuse or Reuse()
    carry = carry or {}
    rounds = _rounds(groups, shape)
    if not rounds:
        raise ValueError("at least one key is needed")
    parts = [_round_scores(rows, row_id, r, list(groups), shape, mode, weighting, carry, reuse) for r in rounds]
    if len(parts) == 1:
        return parts[0]
    # Only ids and sums meet; a row without a vector has null in every part.
    together = reduce(DataFrame.unionAll, parts).groupBy(row_id)
    return reuse.keep(together.agg(*[F.first(c).alias(c) for c in carry], *[F.sum(g).alias(g) for g in groups]))


def _round_scores(rows, row_id, tables: dict[str, KeyTable], names: list[str], shape, mode, weighting, carry, reuse) -> DataFrame:
    """Scores from the key tables of one round, 0 for groups that have none in it."""
    import numpy as np

    width = sum(map(len, tables.values()))
    factors = np.zeros((width, len(names)))
    start = 0
    for name, table in tables.items():
        factors[start : start + len(table), names.index(name)] = table.weights
        start += len(table)
    # Read twice: for the idf of each key and for the scores.
    sims = reuse.keep(_sims(rows.withColumns(carry), [row_id, *carry], list(tables.values()), shape, mode))
    if weighting != "none":
        idfs = np.zeros(width)
        totals = _sums(sims, width).groupBy("pos").agg(soft_idf(F.sum("total"), F.sum("n")).alias("idf"))
        # One number per key; a key without an idf adds nothing.
        for row in totals.collect():
            idfs[row["pos"]] = row["idf"] or 0.0
        factors *= idfs[:, None]

    def weigh(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = V.matrix_of(batch.column("sims"))
            scores = np.where(np.isnan(x), 0.0, x) @ factors
            scores[np.isnan(x).all(axis=1)] = np.nan
            made = [pa.array(scores[:, i], from_pandas=True) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], *names])

    schema = StructType([f for f in sims.schema.fields if f.name != "sims"])
    for name in names:
        schema = schema.add(name, DoubleType())
    return sims.mapInArrow(weigh, schema)


def _sums(sims: DataFrame, width: int) -> DataFrame:
    """``(pos, total, n)``: per key and task, the summed similarity and the number of rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total, n = np.zeros(width), 0
        for batch in batches:
            if batch.num_rows:
                total += np.nansum(V.matrix_of(batch.column(0)), axis=0)
                n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width, dtype=np.int32)), pa.array(total), pa.array(np.full(width, n))], names=["pos", "total", "n"]
            )

    return sims.select("sims").mapInArrow(run, "pos int, total double, n bigint")


def best_key(rows: DataFrame, row_id: str, keys: DataFrame, shape, mode: str = "mult") -> DataFrame:
    """The most similar key of each row: ``(row_id, name, sim)``.

    The first key wins ties, by ``pos`` where the keys have one, else by name. A
    row without a vector has no key.
    """
    V._require_mode(mode)
    made = StructType().add("name", StringType()).add("sim", DoubleType()).add("pos", LongType())

    def tile(table: KeyTable) -> DataFrame:
        names, places = table.names, [p for p, _ in table.order]

        def finish(sims, kept):
            import numpy as np
            import pyarrow as pa

            known = ~np.isnan(sims).all(axis=1)
            # Equal keys may differ in the last digits, by where they stand in the matrix.
            at = np.where(np.isnan(sims), -np.inf, np.round(sims, 12)).argmax(axis=1)
            best = np.where(known, sims[np.arange(len(sims)), at], np.nan)
            found = [names[i] if k else None for i, k in zip(at.tolist(), known.tolist())]
            pos = [places[i] if k else None for i, k in zip(at.tolist(), known.tolist())]
            return [kept[0], pa.array(found, pa.string()), pa.array(best, from_pandas=True), pa.array(pos, pa.int64())]

        return _compared(rows, [row_id], [table], shape, mode, finish, made)

    tiles = [tile(t) for r in _rounds({"": keys}, shape) for t in r.values()]
    if not tiles:
        none = F.lit(None)
        return rows.select(row_id, none.cast("string").alias("name"), none.cast("double").alias("sim"))
    if len(tiles) == 1:
        return tiles[0].drop("pos")
    # Of equal similarities the first key has the smallest (pos, name).
    option = F.when(F.col("sim").isNotNull(), F.struct((-F.round("sim", 12)).alias("n"), "pos", "name", "sim"))
    chosen = reduce(DataFrame.unionAll, tiles).groupBy(row_id).agg(F.min(option).alias("m"))
    return chosen.select(row_id, F.col("m.name").alias("name"), F.col("m.sim").alias("sim"))
