"""Text and token tables to vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from leadrank.functions.text import has_words, sentences
from leadrank.functions.vectors import hash_vector
from leadrank.operators.rows import exploded, inlined
from leadrank.session import spread


def hashed_terms(
    texts: DataFrame, row_id: str, text: str, dims: int = 256, normalize: bool = True
) -> DataFrame:
    """``(row_id, terms)``: hashed bag of words; texts without words drop out."""
    usable = spread(texts.select(row_id, text)).where(has_words(F.col(text)))
    return usable.select(row_id, hash_vector(F.col(text), dims, normalize).alias("terms"))


def hashed_terms_long(
    texts: DataFrame, row_id: str, text: str, dims: int = 256, normalize: bool = True
) -> DataFrame:
    """``(row_id, dim, v)`` rows of the same vectors."""
    terms = hashed_terms(texts, row_id, text, dims, normalize)
    return inlined(terms, [row_id], F.col("terms"), ["dim", "v"])


def sentence_rows(texts: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(row_id, pos, sentence)``"""
    return exploded(texts, [row_id], sentences(F.col(text)), "sentence", "pos")


def phrase_vectors(phrases: DataFrame, dims: int = 256) -> DataFrame:
    """Key table ``(name, weight, terms)`` from ``(name, weight)``."""
    terms = hash_vector(F.col("name"), dims)
    usable = phrases.where(has_words(F.col("name")))
    return usable.select("name", F.col("weight").cast("double").alias("weight"), terms.alias("terms"))


def mean_pool(tokens: DataFrame, row_id: str, vec: str, mask: str) -> DataFrame:
    """``(row_id, vec)``: mean of the token vectors with mask 1.

    Sums are kept per task and merged, so a row with very many tokens costs no
    more than others. A row with no real token gets the zero vector.
    """
    masked = F.transform(F.col(vec).cast("array<double>"), lambda x: x * F.col(mask))
    pooled = tokens.groupBy(row_id).agg(
        Summarizer.sum(array_to_vector(masked)).alias("_sum"),
        F.greatest(F.sum(mask).cast("double"), F.lit(1e-9)).alias("_n"),
    )
    summed = pooled.select(row_id, vector_to_array("_sum").alias("_s"), "_n")
    return summed.select(row_id, F.transform("_s", lambda x: x / F.col("_n")).alias("vec"))


def embed_with(
    texts: DataFrame,
    row_id: str,
    text: str,
    make_model: Callable[[], Callable[[list[str]], object]],
    batch_rows: int = 64,
) -> DataFrame:
    """``(row_id, vec)`` from a user's model.

    ``make_model`` runs once per task and returns a function from a list of
    texts to a 2-d array. Vectors are scaled to unit length.
    """
    id_type = texts.schema[row_id].dataType.simpleString()

    def run(batches):
        import numpy as np

        model = make_model()
        for pdf in batches:
            for start in range(0, len(pdf), batch_rows):
                part = pdf.iloc[start : start + batch_rows]
                vecs = np.asarray(model(part[text].tolist()), dtype=np.float64)
                norms = np.linalg.norm(vecs, axis=1, keepdims=True)
                vecs = np.divide(vecs, norms, out=np.zeros_like(vecs), where=norms > 0)
                yield part[[row_id]].assign(vec=list(vecs))

    return (
        texts.where(F.col(text).isNotNull())
        .select(row_id, text)
        .mapInPandas(run, f"`{row_id}` {id_type}, vec array<double>")
    )
