"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadrank.llm.shared import stored_anew


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``(a, b)`` edges; the component is its smallest id.

    Each round ties the neighbours of every id to the smallest of them, first
    the larger neighbours, then the smaller ones, until nothing changes: a
    number of rounds that grows with the logarithm of the longest path. A round
    is two aggregations that combine before they shuffle and two joins that
    Spark may split, so an id with very many neighbours is no bottleneck. Each
    round is a table in the shared folder, and that of the round before goes. Edges from an id to itself and
    repeated edges do no harm; no edges give no rows.
    """
    now, place = stored_anew(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi != lo").distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large, place = stored_anew(large, "large-star", place)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now, place = stored_anew(small.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "small-star", place)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionAll(roots)
