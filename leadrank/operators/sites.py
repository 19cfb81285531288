"""Stored web pages: visible text, text per site, keyword ranking of sites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadrank.functions.html import html_text
from leadrank.operators.phrases import density, hits, key_parts
from leadrank.operators.ranking import running_total
from leadrank.session import Reuse, spread

#: Bytes of text at which a site goes on in another part.
PART_BYTES = 64 * 1024 * 1024


def site_of(url: Column) -> Column:
    """Lower-case host, or null for an unusable address."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def in_language(url: Column, lang: str) -> Column:
    """Does the path start with the language code?"""
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")).rlike(f"^/{lang}(/|$)"), F.lit(False))


def page_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` from ``(page_id, url, html)``."""
    return pages.select("page_id", "url", html_text(F.col("html")).alias("text"))


def _kept_pages(pages: DataFrame, lang: str) -> DataFrame:
    """``(site, page_id, html)`` of each site's home page and its pages in ``lang``.

    Pages in the language need no look-up; among the others, home pages are found
    by page id, which is unique, so no site is a hot value of the join.
    """
    sited = pages.select("page_id", "url", "html", site_of(F.col("url")).alias("site")).where(F.col("site").isNotNull())
    homes = sited.groupBy("site").agg(F.min("page_id").alias("page_id")).select("page_id")
    wanted = in_language(F.col("url"), lang)
    others = sited.where(~wanted).join(homes, "page_id", "left_semi").select(*sited.columns)
    return sited.where(wanted).unionByName(others).select("site", "page_id", "html")


def _texts(kept: DataFrame) -> DataFrame:
    return spread(kept).select("site", "page_id", html_text(F.col("html")).alias("text"))


def site_pages(pages: DataFrame, lang: str = "en") -> DataFrame:
    """``(site, page_id, text)``: each site's home page and its pages in ``lang``.

    The home page is the one with the lowest id, whatever its language.
    """
    return _texts(_kept_pages(pages, lang))


def site_text(
    pages: DataFrame, lang: str = "en", part_bytes: int = PART_BYTES, reuse: Reuse | None = None
) -> DataFrame:
    """``(site, part, text)``: the home page's text, one space, and the other pages' without anything between.

    A site is one part as long as its pages hold no more than ``part_bytes``, and
    its texts move once. Only larger sites are numbered: those continue in part 1,
    2, ..., so no task ever gathers a whole huge site; the parts put together are
    the full text.
    """
    reuse = reuse or Reuse()
    kept = reuse.keep(_kept_pages(pages, lang))
    # A text is at most twice as long as its page: few short names stand for longer characters.
    sizes = kept.groupBy("site").agg(F.sum(F.octet_length("html") * 2).alias("_bytes"))
    large = reuse.keep(sizes.where(F.col("_bytes") > part_bytes).select("site"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page_id", "text"))), lambda x: x.text)
    # The home page has the lowest id of its site, so it is the first.
    first = F.concat(F.get(ordered, F.lit(0)), F.lit(" "), F.array_join(F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))), ""))
    none = F.lit(0).cast("bigint").alias("part")
    if large.isEmpty():
        return _texts(kept).groupBy("site").agg(first.alias("text")).select("site", none, "text")
    # Pages are told apart by their unique ids, so that no site is a hot value of a join.
    ids = reuse.keep(kept.select("site", "page_id").join(large, "site", "left_semi").select("page_id"))
    small = _texts(kept.join(ids, "page_id", "left_anti")).groupBy("site").agg(first.alias("text"))
    texts = reuse.keep(_texts(kept.join(ids, "page_id", "left_semi")))
    lengths = texts.select("site", "page_id", F.octet_length("text").alias("_bytes"))
    placed = running_total(lengths, ["site"], ["page_id"], F.col("_bytes"), "_before", reuse)
    placed = placed.select("page_id", F.floor(F.col("_before") / part_bytes).cast("bigint").alias("part"))
    parted = texts.join(placed, "page_id").groupBy("site", "part")
    parted = parted.agg(F.when(F.col("part") == 0, first).otherwise(F.array_join(ordered, "")).alias("text"))
    return small.select("site", none, "text").unionByName(parted)


def site_scores(pages: DataFrame, keys: DataFrame, lang: str = "en") -> DataFrame:
    """``(site, score, chars, density)``: presence score per million characters.

    Counts are taken per page and added up per site, so the text of a site is
    never gathered. A phrase does not run over from one page to the next; the
    length counts the space behind the home page.
    """
    texts = site_pages(pages, lang)
    chars = F.length("text").cast("bigint").alias("chars")
    spark = pages.sparkSession
    scores = []
    for part in key_parts(keys) or [[]]:
        found = hits(texts, ["site", chars], F.col("text"), part, True)
        # A site's count of a phrase is the sum over its pages; -1 stands for the page itself.
        page = F.struct(F.lit(-1).alias("i"), (F.col("chars")).alias("n"))
        counts = found.select("site", F.explode(F.concat(F.array(page), F.coalesce("hits", F.array()))).alias("h"))
        sums = counts.groupBy("site", "h.i").agg(F.sum("h.n").alias("n"))
        weights = spark.createDataFrame([(i, k.weight) for i, k in enumerate(part)], "i int, weight double")
        # The weights are within the size that may be sent.
        weighed = sums.join(F.broadcast(weights), "i", "left")
        own = F.when(F.col("i") >= 0, F.col("weight") * (F.col("n") + 2)).otherwise(F.lit(0.0))
        length = F.when(F.col("i") < 0, F.col("n"))
        scores.append(weighed.groupBy("site").agg(F.sum(own).alias("score"), (F.max(length) + 1).alias("chars")))
    scored = reduce(DataFrame.unionAll, scores)
    if len(scores) > 1:
        scored = scored.groupBy("site").agg(F.sum("score").alias("score"), F.max("chars").alias("chars"))
    return scored.select("site", "score", "chars", density(F.col("score"), F.col("chars")).alias("density"))
