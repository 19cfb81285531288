"""Ranking jobs over vectors and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadrank.functions.text import sentences
from leadrank.operators.embedding import phrase_vectors
from leadrank.operators.latent import Latent, fit_latent, latent_keys, with_latent
from leadrank.operators.ranking import best_first, combined, ranked, top_n
from leadrank.operators.similarity import Dense, HashedText, best_key, soft_scores
from leadrank.operators.sites import site_scores
from leadrank.session import Reuse


def scored_rows(
    rows: DataFrame,
    row_id: str,
    keywords: DataFrame,
    shape,
    sectors: DataFrame | None = None,
    mode: str = "mult",
    combine: str = "sum",
    carry: dict[str, Column] | None = None,
    reuse: Reuse | None = None,
) -> DataFrame:
    """``(row_id, carry.., keyword_score, sector_score, score)``, not ordered.

    ``sector_score`` is null when no sector is given.
    """
    groups = {"keyword_score": keywords}
    if sectors is not None:
        groups["sector_score"] = sectors
    scored = soft_scores(rows, row_id, groups, shape, mode, carry=carry, reuse=reuse)
    scored = combined(scored, "keyword_score", None if sectors is None else "sector_score", combine)
    if sectors is None:
        scored = scored.withColumn("sector_score", F.lit(None).cast("double"))
    return scored.select(row_id, *(carry or {}), "keyword_score", "sector_score", "score")


def relevance_rank(rows, row_id, keywords, shape, sectors=None, mode="mult", combine="sum", reuse=None) -> DataFrame:
    """All rows with scores and rank, best first."""
    reuse = reuse or Reuse()
    scored = scored_rows(rows, row_id, keywords, shape, sectors, mode, combine, reuse=reuse)
    return ranked(scored, best_first("score", row_id), reuse=reuse)


def legacy_rank(rows, row_id, keywords, shape, sectors=None, reuse=None) -> DataFrame:
    """The older scoring: distance times plain cosine, scaled parts multiplied."""
    return relevance_rank(rows, row_id, keywords, shape, sectors, "legacy_mult", "product", reuse)


def sector_phrases(texts: DataFrame, text: str) -> DataFrame:
    """Sentences of a free-text sector as a key table of weight 1."""
    parts = texts.where(F.col(text).isNotNull() & (F.col(text) != "")).select(
        F.explode(sentences(F.col(text))).alias("name")
    )
    return parts.distinct().select("name", F.lit(1.0).alias("weight"))


def text_rank(
    rows, row_id, text, phrases, sectors=None, dims=256, mode="mult", combine="sum", reuse=None
) -> DataFrame:
    """``relevance_rank`` over texts, embedded as hashed words."""
    return relevance_rank(
        rows,
        row_id,
        phrase_vectors(phrases, dims),
        HashedText(text, dims),
        None if sectors is None else phrase_vectors(sectors, dims),
        mode,
        combine,
        reuse,
    )


def latent_rank(
    rows, row_id, text, phrases, sectors=None, model: Latent | None = None, mode="mult", combine="sum", reuse=None
) -> DataFrame:
    """``relevance_rank`` over texts, embedded by a projection learned from them (or by ``model``)."""
    reuse = reuse or Reuse()
    model = model or fit_latent(rows, text)
    vectors = reuse.keep(with_latent(rows, [row_id], text, model))
    keys = latent_keys(phrases, model)
    return relevance_rank(vectors, row_id, keys, Dense("vec"), None if sectors is None else latent_keys(sectors, model), mode, combine, reuse)


def latent_sector(rows, row_id, text, sectors, model: Latent | None = None, mode="mult") -> DataFrame:
    """``predict_sector`` over texts, embedded by a projection learned from them (or by ``model``)."""
    model = model or fit_latent(rows, text)
    return predict_sector(with_latent(rows, [row_id], text, model), row_id, latent_keys(sectors, model), Dense("vec"), mode)


def predict_sector(rows, row_id, sectors, shape, mode="mult") -> DataFrame:
    """``(row_id, predicted_sector, sim)``: the most similar sector."""
    best = best_key(rows, row_id, sectors, shape, mode)
    return best.select(row_id, F.col("name").alias("predicted_sector"), "sim")


def cosine_scores(rows, row_id, keywords, shape) -> DataFrame:
    """``(row_id, score)``: weighted cosine sum, neither idf nor scaling."""
    return soft_scores(rows, row_id, {"score": keywords}, shape, "cosine", weighting="none")


def cosine_top(rows, row_id, keywords, shape, n=500) -> DataFrame:
    return top_n(cosine_scores(rows, row_id, keywords, shape), best_first("score", row_id), n)


def site_rank(pages, keys, lang="en", reuse=None) -> DataFrame:
    """Sites by presence score per million characters of their text."""
    return ranked(site_scores(pages, keys, lang), best_first("density", "site"), reuse=reuse)
