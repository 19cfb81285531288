"""Clusters of companies by their descriptions, with vectors that are kept from run to run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from leadrank.functions.text import spaced_words
from leadrank.functions.vectors import list_array, word_slots
from leadrank.operators.clusters import k_sweep, kmeans
from leadrank.session import Reuse
from leadrank.sources.vector_cache import vectors_of

DIMS = 64


def hashed_dense(todo: DataFrame, dims: int = DIMS) -> DataFrame:
    """``(key, vec)`` of ``(key, text)``: the hashed bag of words as a dense vector; zero for a text without words.

    The vectors are those of ``hash_vector``. A word is hashed once per step of a
    batch; as an expression, each of the ``dims`` numbers would hash the text again.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known: dict = {}
        for batch in batches:
            for start, n, row, slot in word_slots(batch.column(1), dims, known):
                counts = np.bincount(row * dims + slot, minlength=n * dims).reshape(n, dims)
                norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True).astype(np.float64))
                made = counts / np.where(norm > 0, norm, 1.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, n), list_array(made)], names=["key", "vec"])

    key = StructType([todo.schema["key"]])
    return todo.select("key", spaced_words(F.col("text")).alias("_words")).mapInArrow(run, key.add("vec", ArrayType(DoubleType())))


def company_clusters(
    companies: DataFrame, row_id: str, text: str, cache: str, k: int, embed: Callable[[DataFrame], DataFrame] = hashed_dense, seed: int = 0, reuse: Reuse | None = None
) -> DataFrame:
    """``(row_id, cluster)``; only texts that the cache lacks are embedded."""
    rows = vectors_of(companies.sparkSession, cache, companies.select(row_id, text), text, embed)
    return kmeans(rows, row_id, "vec", k, seed, reuse)[1]


def company_sweep(
    companies: DataFrame, row_id: str, text: str, cache: str, ks=range(2, 100), embed: Callable[[DataFrame], DataFrame] = hashed_dense, seed: int = 0
) -> DataFrame:
    """``(k, silhouette, error)`` of the companies' vectors, kept in the same cache."""
    rows = vectors_of(companies.sparkSession, cache, companies.select(row_id, text), text, embed)
    return k_sweep(rows, row_id, "vec", ks, seed, exact=True)
