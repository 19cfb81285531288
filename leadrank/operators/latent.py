"""Learned text vectors: a latent semantic projection of the corpus's own terms.

Texts are rows of a sparse matrix: words hashed to slots, ``1 + ln n`` times the
slot's idf, scaled to length one. Its leading right singular vectors, found by
block power iteration from a random start, are the projection; a text's vector is
its row times them, scaled to length one. Nothing is downloaded and no model file
is needed.

Texts are taken apart once for the fit; their counts are kept as packed numbers. Each
round is one pass over those: a task multiplies its rows with the block, back with
their transpose, and passes on one row per slot it has met; Spark adds those up. The
block has ``slots`` times ``k`` plus a margin numbers, whatever the size of the corpus,
and is broadcast to the next round. Rows are multiplied some dozen at a time: slots
that enough of them share as a dense matrix, the others term by term.

Same seed, same vectors, but for rounding in sums. Texts without words have a null
vector. Singular values that vanish give dimensions that are zero everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from leadrank.functions.text import spaced_words
from leadrank.functions.vectors import list_array, matrix_of, word_slots
from leadrank.session import Reuse, spread

SLOTS, DIMENSIONS, MARGIN, ROUNDS = 1 << 14, 64, 8, 3
#: Rows, and cells of their matrix, that are multiplied with the block at once: few
#: megabytes, which stay with the process, while larger ones go back to the system each time.
STEP_ROWS, STEP_CELLS = 4096, 1 << 20
#: A slot that more than this share of the rows has is multiplied as a dense column.
DENSE_SHARE = 0.005
#: Terms of the other slots that are multiplied at once.
STEP_TERMS = 8_000


@dataclass(frozen=True)
class Latent:
    """The projection: idf of each slot, basis (slots by dimensions), singular values."""

    idf: object
    basis: object
    values: object

    @property
    def slots(self) -> int:
        return len(self.idf)


def _counted(column, slots: int, known: dict):
    """Of an Arrow column of ``spaced_words``, in steps: terms of each row, and slot and count of each term."""
    import numpy as np

    for _, n, row, slot in word_slots(column, slots, known):
        at, count = np.unique(row * slots + slot, return_counts=True)
        yield np.bincount(at // slots, minlength=n), at % slots, count


def _packed(terms: DataFrame, slots: int) -> DataFrame:
    """``(_x)``: slot and count of each term of a text as pairs of 32-bit numbers."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known: dict = {}
        for batch in batches:
            for sizes, slot, count in _counted(batch.column(0), slots, known):
                ends = np.concatenate([[0], 8 * np.cumsum(sizes)]).astype(np.int32)
                pairs = np.stack([slot, count], axis=1).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pairs.tobytes())])
                yield pa.RecordBatch.from_arrays([column], names=["_x"])

    return terms.mapInArrow(run, "_x binary")


def _unpacked(column):
    """Terms of each row, and slot and count of each term, of an Arrow column of packed terms."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = np.asarray(pc.binary_length(column), dtype=np.int64) // 8
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int32)[column.offset] if len(column) else 0
    pairs = np.frombuffer(data or pa.py_buffer(b""), np.int32, 2 * int(sizes.sum()), int(start)).reshape(-1, 2)
    return sizes, pairs[:, 0], pairs[:, 1]


def _steps(sizes, slot, count, idf):
    """First row, rows and sparse matrix of some rows at a time."""
    import numpy as np

    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    step = max(1, min(STEP_ROWS, STEP_CELLS // len(idf)))
    for start in range(0, len(sizes), step):
        n = min(step, len(sizes) - start)
        part = slice(ends[start], ends[start + n])
        row, names = np.repeat(np.arange(n), sizes[start : start + n]), slot[part].astype(np.int64)
        weight = (1.0 + np.log(count[part])) * idf[names]
        norm = np.sqrt(np.bincount(row, weight * weight, n))
        weight /= np.where(norm > 0, norm, 1.0)[row]
        yield start, n, _parted(n, row, names, weight, len(idf))


def _parted(n, row, slot, weight, slots: int):
    """A sparse matrix in two: names and dense columns of its frequent slots; and row, slot and weight of the other terms."""
    import numpy as np

    often = np.bincount(slot, minlength=slots) > DENSE_SHARE * n
    names = np.flatnonzero(often)
    dense = np.zeros((n, len(names)))
    held = often[slot]
    dense[row[held], np.searchsorted(names, slot[held])] = weight[held]
    return names, dense, (row[~held], slot[~held], weight[~held])


def _add_products(out, to, of, weight, block):
    """Add to the rows ``to`` of ``out``, in order, rows ``of`` of the block times their weights."""
    import numpy as np

    for a in range(0, len(to), STEP_TERMS):
        part = slice(a, a + STEP_TERMS)
        names, first = np.unique(to[part], return_index=True)
        out[names] += np.add.reduceat(block[of[part]] * weight[part, None], first, axis=0)


def _times(parted, block):
    """Rows of the sparse matrix times the block."""
    names, dense, (row, slot, weight) = parted
    out = dense @ block[names]
    _add_products(out, row, slot, weight, block)
    return out


def _add_back(total, parted, made):
    """Add the transpose of the sparse matrix times ``made`` to ``total``."""
    import numpy as np

    names, dense, (row, slot, weight) = parted
    total[names] += dense.T @ made
    order = np.argsort(slot, kind="stable")
    _add_products(total, slot[order], row[order], weight[order], made)


def _document_frequencies(terms: DataFrame, slots: int):
    """Number of texts with each slot, and of texts with any word."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        counts, texts = np.zeros(slots, np.int64), 0
        for batch in batches:
            sizes, slot, _ = _unpacked(batch.column(0))
            counts += np.bincount(slot, minlength=slots)
            texts += int(np.count_nonzero(sizes))
        held = np.append(np.flatnonzero(counts), -1)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(np.append(counts[held[:-1]], texts))], names=["slot", "n"])

    found = terms.select("_x").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    counts = {r["slot"]: r["n"] for r in found}
    return np.array([counts.get(i, 0) for i in range(slots)], dtype=np.float64), counts.get(-1, 0)


def _applied(terms: DataFrame, idf, block, inner: bool = False):
    """Transpose of the matrix times the matrix times the block; with ``inner``, transpose of the block times that."""
    import numpy as np

    sent = terms.sparkSession.sparkContext.broadcast((idf, block))
    rows, width = (block.shape[1] if inner else len(block)), block.shape[1]

    def run(batches):
        import pyarrow as pa

        idf, block = sent.value
        total = np.zeros((rows, width))
        for batch in batches:
            for _, _, parted in _steps(*_unpacked(batch.column(0)), idf):
                made = _times(parted, block)
                if inner:
                    total += made.T @ made
                else:
                    _add_back(total, parted, made)
        held = np.flatnonzero(np.abs(total).max(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), list_array(total[held])], names=["slot", "v"])

    parts = terms.select("_x").mapInArrow(run, "slot int, v array<double>")
    added = parts.groupBy("slot").agg(Summarizer.sum(array_to_vector("v")).alias("v")).select("slot", vector_to_array("v").alias("v"))
    # One row per slot.
    found = added.toArrow()
    out = np.zeros((rows, width))
    if found.num_rows:
        out[found.column("slot").to_numpy()] = matrix_of(found.column("v").combine_chunks())
    return out


def fit_latent(docs: DataFrame, text: str, k: int = DIMENSIONS, slots: int = SLOTS, rounds: int = ROUNDS, margin: int = MARGIN, seed: int = 0) -> Latent:
    """The projection onto the ``k`` leading dimensions of the texts."""
    import numpy as np

    with Reuse() as reuse:
        terms = reuse.keep(_packed(spread(docs).select(spaced_words(F.col(text)).alias("_words")), slots))
        frequency, texts = _document_frequencies(terms, slots)
        idf = np.log((1.0 + texts) / (1.0 + frequency)) + 1.0
        block, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(slots, min(slots, k + margin))))
        for _ in range(rounds):
            block, _ = np.linalg.qr(_applied(terms, idf, block))
        inner = _applied(terms, idf, block, inner=True)
    squares, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-squares)[:k]
    values = np.sqrt(np.maximum(squares[order], 0.0))
    basis = block @ turn[:, order]
    # The largest component of each dimension is positive.
    signs = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    basis = basis * np.where(signs == 0, 1.0, signs)
    lost = values <= 1e-9 * max(1e-300, values.max(initial=0.0))
    basis[:, lost] = 0.0
    return Latent(idf, basis, np.where(lost, 0.0, values))


def with_latent(rows: DataFrame, keep: list[Column | str], text: str, model: Latent, out: str = "vec") -> DataFrame:
    """``keep`` columns and the unit vector of the text; null for a text without words or without any dimension."""
    import numpy as np

    texts = spread(rows).select(*keep, spaced_words(F.col(text)).alias("_words"))
    names = texts.columns[:-1]
    schema = StructType(texts.schema.fields[:-1]).add(out, ArrayType(DoubleType()))
    sent = rows.sparkSession.sparkContext.broadcast((model.idf, model.basis))

    def run(batches):
        import pyarrow as pa

        idf, basis = sent.value
        known: dict = {}
        for batch in batches:
            first = 0
            for sizes, slot, count in _counted(batch.column(len(names)), len(idf), known):
                for start, n, parted in _steps(sizes, slot, count, idf):
                    made = _times(parted, basis)
                    norm = np.linalg.norm(made, axis=1)
                    made /= np.where(norm > 1e-12, norm, 1.0)[:, None]
                    lists = list_array(made)
                    vectors = pa.ListArray.from_arrays(lists.offsets, lists.values, mask=pa.array(norm <= 1e-12))
                    yield pa.RecordBatch.from_arrays([*(c.slice(first + start, n) for c in batch.columns[:-1]), vectors], names=[*names, out])
                first += len(sizes)

    return texts.mapInArrow(run, schema)


def latent_keys(phrases: DataFrame, model: Latent) -> DataFrame:
    """Key table ``(name, weight, vec)`` from ``(name, weight)``; phrases without a vector drop out."""
    weight = F.col("weight").cast("double").alias("weight")
    return with_latent(phrases, ["name", weight], "name", model).where("vec is not null")
