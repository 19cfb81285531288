"""Vector expressions.

Sparse text vectors are arrays of ``(dim, v)`` built per row, so embedding a
text never shuffles. Dense vectors are compared with a small key matrix in
Arrow batches; the same formulas exist as JVM expressions for the case where
the keys arrive as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from leadrank.functions.text import let, word_tokens

MODES = ("cosine", "euclid", "mult", "legacy_mult", "add")

# Unit vectors whose cosine is this close to 1 count as equal: below it the
# distance sqrt(2 - 2 cos) would be rounding noise.
EQUAL_GAP = 1e-12


def _require_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown similarity mode {mode!r}; expected one of {MODES}")


def unit_distance(cos: Column) -> Column:
    """Euclidean distance of two unit vectors with the given cosine."""
    gap = F.lit(1.0) - cos
    return F.when(gap < EQUAL_GAP, F.lit(0.0)).otherwise(F.sqrt(gap * 2.0))


def similarity(cos: Column, mode: str, alpha: float = 0.5) -> Column:
    """Similarity of two unit vectors from their cosine.

    ``mult`` is distance times scaled cosine. It is not monotone: it is zero
    for equal and for opposite vectors and largest at cosine 1/3. ``add`` rises
    with the cosine and suits users who want closeness.
    """
    _require_mode(mode)
    if mode == "cosine":
        return cos
    dist = unit_distance(cos)
    if mode == "euclid":
        return dist
    if mode == "mult":
        return dist * (cos + 1.0) / 2.0
    if mode == "legacy_mult":
        return dist * cos
    return (cos + 1.0) * (alpha / 2.0) + F.lit(1.0 - alpha) / (dist + 1.0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vec: Column) -> Column:
    """Unit vector; null elements for a zero vector."""
    return let(F.nullif(l2_norm(vec), F.lit(0.0)), lambda n: F.transform(vec, lambda x: x / n))


def hash_dim(token: Column, dims: int) -> Column:
    """Slot of a token: first 32 bits of its MD5, modulo ``dims``."""
    prefix = F.substring(F.md5(token.cast("binary")), 1, 8)
    return (F.conv(prefix, 16, 10).cast("bigint") % dims).cast("int")


def term_counts(text: Column, dims: int) -> Column:
    """``array<struct<dim int, n int>>`` ordered by dim.

    Sorts the slots of one text and reads off the runs, which is linear after
    the sort and needs no shuffle.
    """
    slots = F.sort_array(F.transform(word_tokens(text), lambda t: hash_dim(t, dims)))

    def runs(d: Column) -> Column:
        # Places where a slot differs from the one before it.
        before = F.concat(F.array(F.lit(-1)), d)
        starts = let(
            before,
            lambda b: F.filter(
                F.transform(d, lambda x, i: F.when(x != F.get(b, i), i)), lambda i: i.isNotNull()
            ),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda p, i: F.struct(
                    F.get(d, p).alias("dim"),
                    (F.coalesce(F.get(s, i + 1), F.size(d)) - p).alias("n"),
                ),
            ),
        )

    return let(slots, runs)


def counts_norm(counts: Column) -> Column:
    """L2 norm of a term-count vector; null when it is empty."""
    total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + (x.n * x.n).cast("double"))
    return F.nullif(F.sqrt(total), F.lit(0.0))


def hash_vector(text: Column, dims: int, normalize: bool = True) -> Column:
    """Hashed bag of words as ``array<struct<dim int, v double>>``."""

    def weigh(counts: Column) -> Column:
        if normalize:
            return let(
                counts_norm(counts),
                lambda n: F.transform(counts, lambda x: F.struct(x.dim.alias("dim"), (x.n / n).alias("v"))),
            )
        return F.transform(counts, lambda x: F.struct(x.dim.alias("dim"), x.n.cast("double").alias("v")))

    return let(term_counts(text, dims), weigh)


#: Bytes of words that are taken apart at once, and words whose slots a task remembers at most.
STEP_BYTES, KNOWN_WORDS = 1 << 22, 1 << 18


def word_slots(column, dims: int, known: dict):
    """Of an Arrow column of ``spaced_words``, in steps: first row, rows, and row and slot of each word.

    The slots are those of ``hash_dim``. Each different word of a step is hashed
    once, and not again if ``known``, the caller's for a whole task, has it.
    """
    import hashlib

    import numpy as np
    import pyarrow.compute as pc

    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))])
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + STEP_BYTES, side="right")) - 1)
        parts = pc.split_pattern(column.slice(start, stop - start), b" ")
        words = pc.dictionary_encode(pc.list_flatten(parts))
        slots = np.empty(len(words.dictionary), np.int64)
        for i, word in enumerate(words.dictionary.to_pylist()):
            at = known.get(word)
            if at is None:
                # Nothing lies between two spaces but at the ends.
                at = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:4], "big") % dims if word else -1
                if len(known) < KNOWN_WORDS:
                    known[word] = at
            slots[i] = at
        slot = slots[words.indices.to_numpy()]
        row = np.repeat(np.arange(stop - start), np.asarray(pc.fill_null(pc.list_value_length(parts), 0), dtype=np.int64))
        held = slot >= 0
        yield start, stop - start, row[held], slot[held]
        start = stop


def matrix_of(column):
    """Rows of an Arrow list column as a matrix; a null list is a row of NaN.

    Lists of unequal length are an error: cut up evenly they would mix rows.
    """
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.list_value_length(column)
    lengths = pc.unique(pc.drop_null(sizes)).to_pylist()
    if len(lengths) > 1:
        raise ValueError(f"vectors of unequal length: {sorted(lengths)[:5]}")
    width = lengths[0] if lengths else 0
    flat = np.asarray(pc.list_flatten(column), dtype=np.float64)
    if column.null_count == 0 or width == 0:
        return flat.reshape(len(column), width)
    out = np.full((len(column), width), np.nan)
    out[pc.is_valid(column).to_numpy(zero_copy_only=False)] = flat.reshape(-1, width)
    return out


def list_array(matrix):
    """Arrow lists from the rows of a matrix; NaN becomes null."""
    import numpy as np
    import pyarrow as pa

    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), from_pandas=True))


def map_vectors(rows: DataFrame, keep: list[str], vec: str, compute, out: str, out_type: DataType) -> DataFrame:
    """``keep`` columns and ``out``, computed from a dense vector column in Arrow batches.

    ``compute`` gets the batch's vectors as a matrix and the batch itself, and
    returns an Arrow array. The work stays where the rows lie.
    """
    kept = rows.select(*keep, F.col(vec).cast("array<double>").alias("_vec"))
    schema = StructType([f for f in kept.schema.fields if f.name != "_vec"]).add(out, out_type)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            made = compute(matrix_of(batch.column("_vec")), batch)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [made], names=[*keep, out])

    return kept.mapInArrow(run, schema)


def similarity_values(cos, mode: str, alpha: float = 0.5):
    """``similarity`` on a matrix of cosines."""
    import numpy as np

    if mode == "cosine":
        return cos
    gap = 1.0 - cos
    dist = np.where(gap < EQUAL_GAP, 0.0, np.sqrt(2.0 * np.maximum(gap, 0.0)))
    dist = np.where(np.isnan(cos), np.nan, dist)
    if mode == "euclid":
        return dist
    if mode == "mult":
        return dist * (cos + 1.0) / 2.0
    if mode == "legacy_mult":
        return dist * cos
    return (cos + 1.0) * (alpha / 2.0) + (1.0 - alpha) / (dist + 1.0)


def unit_rows(x):
    """Rows scaled to length one; NaN for zero rows."""
    import numpy as np

    with np.errstate(divide="ignore", invalid="ignore"):
        return x / np.linalg.norm(x, axis=1, keepdims=True)
