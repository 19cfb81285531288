"""The lead list: clean companies, keep reachable ones, rank, cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadrank.functions.text import reply_tail, word_count
from leadrank.operators import contacts as C
from leadrank.operators.embedding import phrase_vectors
from leadrank.operators.prompts import request_table, row_prompt
from leadrank.operators.ranking import best_first, choose_top
from leadrank.operators.similarity import HashedText
from leadrank.plans.relevance import scored_rows, sector_phrases
from leadrank.session import Reuse, durable
from leadrank.sources.keywords import keyword_table, read_keywords

BROADCAST_ROWS = 100_000
ROW_ID = "_row"


def lead_ranking(
    companies: DataFrame,
    row_id: str,
    phrases: DataFrame,
    sectors: DataFrame | None = None,
    description: str = "Description",
    verify_email: bool = True,
    rename: bool = True,
    min_words: int = 20,
    n: int = 500,
    dims: int = 256,
    mode: str = "mult",
    reuse: Reuse | None = None,
) -> DataFrame:
    """Best ``n`` companies with all their columns, scores and rank.

    ``row_id`` must be unique.
    The length filter comes after scoring: idf and scaling are taken over all
    reachable companies. Only ids and scores go through scoring; the columns of
    the companies that made the cut are joined back at the end, and only their
    contact slots are rewritten.
    """
    cleaned = C.drop_merge_leftovers(companies) if rename else companies
    base = cleaned.where(C.has_plausible_contact()) if verify_email else cleaned
    base = C.drop_missing(base, description)
    scored = scored_rows(
        base.select(row_id, description),
        row_id,
        phrase_vectors(phrases, dims),
        HashedText(description, dims),
        None if sectors is None else phrase_vectors(sectors, dims),
        mode,
        carry={"_words": word_count(F.col(description))},
        reuse=reuse,
    )
    cut = choose_top(scored, best_first("score", row_id), F.col("_words"), min_words, n).drop("_words")
    if n <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    best = cleaned.join(cut, row_id)
    return C.compact_contacts(best) if verify_email else best


def lead_requests(
    best: DataFrame, row_id: str, instructions: str, examples: DataFrame | None = None, columns: list[str] | None = None
) -> DataFrame:
    """``(row_id, prompt, messages)``: a request for a chat model for each lead.

    The prompt names the lead's ``columns`` (all by default) that hold a value;
    ``examples`` as in ``request_table``.
    """
    asked = best.select(row_id, row_prompt(best, columns).alias("prompt"))
    return request_table(asked, "prompt", instructions, examples)


def with_replies(best: DataFrame, row_id: str, replies: DataFrame, out: str = "WLYB") -> DataFrame:
    """Leads with the reason from the model's ``(row_id, reply)``, one reply a lead at most.

    A lead without a reply, or whose reply gives no reason, stays with null.
    """
    reasons = replies.select(F.col(row_id).alias("_lead"), reply_tail(F.col("reply")).alias(out))
    return best.join(reasons, F.col(row_id) == F.col("_lead"), "left").drop("_lead")


def rank_company_file(
    spark: SparkSession, path: str, keywords: dict[str, float] | str, sector: str | None = None, **options
) -> DataFrame:
    """``lead_ranking`` of a company CSV. ``keywords`` is a mapping or the path of a JSON file.

    Columns are read as text, in whatever set the file has. Such a file is one
    task to read; its rows get numbers there and are dealt over all cores, and a
    checkpoint fixes both and spares reading the CSV twice.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    cores = spark.sparkContext.defaultParallelism
    companies = durable(raw.withColumn(ROW_ID, F.monotonically_increasing_id()).repartition(cores))
    phrases = read_keywords(spark, keywords) if isinstance(keywords, str) else keyword_table(spark, keywords)
    sectors = None
    if sector:
        sectors = sector_phrases(spark.createDataFrame([(sector,)], "sector string"), "sector")
    return lead_ranking(companies, ROW_ID, phrases, sectors, **options).drop(ROW_ID)
