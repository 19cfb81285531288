"""Keyword tables from JSON objects ``{"phrase": weight}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadrank.functions.text import spaced_tokens
from leadrank.operators.rows import exploded


def parse_keywords(objects: DataFrame, set_id: str, json: str, tokenize: bool = False) -> DataFrame:
    """``(set_id, name, weight)``, one row per distinct lower-case phrase.

    Phrases are lower-cased; where that makes two equal, the last one wins.
    A weight that is not an integer fails the job.
    """
    entries = objects.select(
        set_id, F.map_entries(F.from_json(F.col(json), "map<string,bigint>")).alias("_e"), F.col(json).alias("_json")
    )
    checked = entries.withColumn(
        "_e",
        F.when(
            F.col("_e").isNull() | F.exists("_e", lambda e: e.value.isNull()),
            F.raise_error(F.concat(F.lit("keyword weights must be integers: "), F.coalesce("_json", F.lit("null")))),
        ).otherwise(F.col("_e")),
    )
    rows = exploded(checked, [set_id], F.col("_e"), "e", "pos")
    name = F.lower("e.key")
    if tokenize:
        name = spaced_tokens(name)
    return rows.groupBy(set_id, name.alias("name")).agg(F.max_by("e.value", "pos").alias("weight"))


def read_keywords(spark: SparkSession, path: str, tokenize: bool = False) -> DataFrame:
    """Keyword table ``(name, weight)`` from one JSON file."""
    text = spark.read.text(path, wholetext=True).select(F.lit(0).alias("_set"), "value")
    return parse_keywords(text, "_set", "value", tokenize).select(
        "name", F.col("weight").cast("double").alias("weight")
    )


def keyword_table(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    """Keyword table ``(name, weight)`` from a Python mapping; it stays on the driver, so its size is known."""
    import pyarrow as pa

    columns = {"name": pa.array(list(weights), pa.string()), "weight": pa.array([float(v) for v in weights.values()], pa.float64())}
    return spark.createDataFrame(pa.table(columns))
