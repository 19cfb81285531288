"""Lexical scores: whole-word counts, presence score, substring TF-IDF.

All phrases of a key table are one automaton, sent to the workers, and each text
runs through it once where it lies: no text is shuffled and no pattern is matched
per phrase. A key table beyond the size that is sent at once goes in several
parts, each a pass over the texts. Only small rows per phrase and task are
shuffled for document frequencies. Phrases that are patterns themselves
(``escape=False``) are counted by Spark's regular expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leadrank.functions.automaton import build, occurrences
from leadrank.functions.text import phrase_count, spaced_tokens, word_count
from leadrank.operators.keys import MAX_KEY_BYTES, Key, local_keys
from leadrank.operators.ranking import minmax
from leadrank.operators.rows import exploded
from leadrank.session import Reuse, spread

#: Rows of a record batch of the grid of documents and phrases, at most.
GRID_ROWS = 1 << 16


def key_parts(keys: DataFrame, max_bytes: int | None = None) -> list[list[Key]]:
    """The key table in parts that may be sent at once; by name order within each part."""
    limit = MAX_KEY_BYTES if max_bytes is None else max_bytes
    plain = keys.select("name", "weight")
    whole = local_keys(plain, max_bytes=limit)
    if whole is not None:
        return [whole]
    total = plain.agg(F.sum(F.octet_length("name") + F.lit(64))).first()[0]
    # Twice as many parts as needed on average, so that an uneven one fits as well.
    n = 2 * -(-total // limit)
    found = [local_keys(plain.where(F.pmod(F.xxhash64("name"), F.lit(n)) == k), max_bytes=1 << 62) for k in range(n)]
    return [part for part in found if part]


Emit = Callable[[pa.RecordBatch, list[dict[int, int] | None]], Iterator[pa.RecordBatch]]


def scanned(docs: DataFrame, columns: list[Column | str], text: Column, names: list[str], whole_words: bool, schema: T.StructType, emit: Emit) -> DataFrame:
    """``emit`` on batches of ``columns`` and the occurrences in each text (None for a null text)."""
    sent = docs.sparkSession.sparkContext.broadcast(build(names, whole_words))
    body = F.lower(text) if whole_words else text
    rows = spread(docs).select(*columns, body.alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = sent.value
        for batch in batches:
            found = [None if t is None else occurrences(t, finder) for t in (x.as_py() for x in batch.column(batch.num_columns - 1))]
            kept = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            yield from emit(kept, found)

    return rows.mapInArrow(run, schema)


def tokenized(spark: SparkSession, names: list[str]) -> list[str]:
    """The names as they look in tokenized texts."""
    rows = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    return [r["name"] for r in rows.select("i", spaced_tokens(F.col("name")).alias("name")).orderBy("i").collect()]


def grid(docs: DataFrame, columns: list[Column | str], text: Column, keys: DataFrame, whole_words: bool, tokenize: bool = False) -> DataFrame:
    """``columns``, ``name`` and ``n``: a row for each document and phrase; ``n`` is null for a null text."""
    before = docs.select(*columns).schema

    def part(some: list[Key]) -> DataFrame:
        names = [k.name for k in some]
        schema = T.StructType([*before.fields, T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
        absent = [k for k, name in enumerate(names) if name == "" and not whole_words]

        def emit(kept: pa.RecordBatch, found: list[dict[int, int] | None]) -> Iterator[pa.RecordBatch]:
            step = max(1, GRID_ROWS // max(1, len(names)))
            labels = pa.array(names, pa.string())
            for a in range(0, len(found), step):
                group = found[a : a + step]
                n, null = np.zeros((len(group), len(names)), np.int64), np.zeros((len(group), len(names)), bool)
                for i, counts in enumerate(group):
                    if counts is None:
                        null[i] = True
                    else:
                        n[i, list(counts)] = list(counts.values())
                null[:, absent] = True
                at = pa.array(np.repeat(np.arange(a, a + len(group)), len(names)))
                places = pa.array(np.tile(np.arange(len(names)), len(group)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(at) for c in kept.columns), labels.take(places), pa.array(n.reshape(-1), mask=null.reshape(-1))], names=schema.names
                )

        forms = tokenized(docs.sparkSession, names) if tokenize else names
        return scanned(docs, columns, text, forms, whole_words, schema, emit)

    return reduce(DataFrame.unionAll, map(part, key_parts(keys) or [[]]))


def hits(docs: DataFrame, columns: list[Column | str], text: Column, keys: list[Key], whole_words: bool) -> DataFrame:
    """``columns`` and ``hits``: (place in ``keys``, n) of the phrases that occur; null for a null text."""
    hit = T.StructType().add("i", T.IntegerType()).add("n", T.LongType())
    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("hits", T.ArrayType(hit))])
    kind = pa.list_(pa.struct([("i", pa.int32()), ("n", pa.int64())]))

    def emit(kept: pa.RecordBatch, found: list[dict[int, int] | None]) -> Iterator[pa.RecordBatch]:
        lists = [None if c is None else [{"i": i, "n": n} for i, n in sorted(c.items())] for c in found]
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(lists, kind)], names=schema.names)

    return scanned(docs, columns, text, [k.name for k in keys], whole_words, schema, emit)


def word_counter(text: Column, tokenize: bool, escape: bool):
    if not tokenize:
        return lambda name: phrase_count(text, name, escape)
    return lambda name: phrase_count(text, spaced_tokens(name), escape)


def pattern_values(docs: DataFrame, doc_id: str, keys: DataFrame, value, carry: list[Column] | None = None) -> DataFrame:
    """``hits: array<struct<name, weight, n>>`` per document, for phrases that are patterns; ``value(name)`` gives n."""
    made = F.array(
        *[
            F.struct(F.lit(k.name).alias("name"), F.lit(k.weight).alias("weight"), value(F.lit(k.name)).alias("n"))
            for part in key_parts(keys)
            for k in part
        ]
    )
    return spread(docs).select(doc_id, *(carry or []), made.alias("hits"))


def phrase_counts(
    docs: DataFrame, doc_id: str, text: str, keys: DataFrame, tokenize: bool = False, escape: bool = True
) -> DataFrame:
    """``(doc_id, name, n)``: whole-word, case-blind occurrences of each phrase."""
    body = spaced_tokens(F.col(text)) if tokenize else F.col(text)
    if not escape:
        docs = docs.withColumn(text, body)
        found = pattern_values(docs, doc_id, keys, word_counter(F.col(text), tokenize, escape))
        return exploded(found, [doc_id], F.col("hits"), "h").select(doc_id, "h.name", F.col("h.n").cast("bigint").alias("n"))
    return grid(docs, [doc_id], body, keys, True, tokenize)


def presence(hits: Column) -> Column:
    """Sum of weight * count, plus twice the weight of each phrase seen."""
    return F.aggregate(
        hits,
        F.lit(0.0),
        lambda acc, h: acc + h.weight * (h.n + F.when(h.n > 0, F.lit(2)).otherwise(F.lit(0))),
    )


def presence_score(
    docs: DataFrame, doc_id: str, text: str, keys: DataFrame, tokenize: bool = False, escape: bool = True
) -> DataFrame:
    """``(doc_id, score, density)``; density is per million characters of text."""
    length = F.length(text).cast("bigint").alias("chars")
    body = spaced_tokens(F.col(text)) if tokenize else F.col(text)
    if not escape:
        patterned = docs.withColumn("_body", body)
        found = pattern_values(patterned, doc_id, keys, word_counter(F.col("_body"), tokenize, escape), [length])
        scored = found.select(doc_id, "chars", presence(F.col("hits")).alias("score"))
        return scored.select(doc_id, "score", density(F.col("score"), F.col("chars")).alias("density"))
    parts = key_parts(keys) or [[]]
    schema = T.StructType([*docs.select(doc_id, length).schema.fields, T.StructField("score", T.DoubleType())])

    def scores(some: list[Key]) -> DataFrame:
        weights = [k.weight for k in some]

        def emit(kept: pa.RecordBatch, found: list[dict[int, int] | None]) -> Iterator[pa.RecordBatch]:
            made = [None if c is None else float(sum(weights[i] * (n + 2) for i, n in sorted(c.items()))) for c in found]
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(made, pa.float64())], names=schema.names)

        names = [k.name for k in some]
        return scanned(docs, [doc_id, length], body, tokenized(docs.sparkSession, names) if tokenize else names, True, schema, emit)

    scored = reduce(DataFrame.unionAll, map(scores, parts))
    if len(parts) > 1:
        scored = scored.groupBy(doc_id).agg(F.first("chars").alias("chars"), F.sum("score").alias("score"))
    return scored.select(doc_id, "score", density(F.col("score"), F.col("chars")).alias("density"))


def density(score: Column, chars: Column) -> Column:
    return score * 1e6 / F.nullif(chars, F.lit(0))


def term_frequency(docs: DataFrame, doc_id: str, text: str, keys: DataFrame) -> DataFrame:
    """``(doc_id, name, tf)``: substring count over word count, case-sensitive."""
    found = grid(docs, [doc_id, word_count(F.col(text)).alias("words")], F.col(text), keys, False)
    return found.select(doc_id, "name", (F.col("n") / F.nullif(F.col("words"), F.lit(0))).alias("tf"))


def _containment_idf(docs_total: Column, docs_with: Column) -> Column:
    return F.ln(docs_total / (docs_with + 1))


def containment_idf(docs: DataFrame, doc_id: str, text: str, keys: DataFrame) -> DataFrame:
    """``(name, docs_with, idf)`` with idf = ln(documents / (1 + documents containing)).

    A task passes on one row per phrase. Every text contains the empty phrase;
    a null text contains none and counts as a document.
    """
    schema = "name string, docs_with bigint, _all bigint"

    def part(some: list[Key]) -> DataFrame:
        names = [k.name for k in some]
        empty = [i for i, name in enumerate(names) if name == ""]
        sent = docs.sparkSession.sparkContext.broadcast(build(names, False))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, total = np.zeros(len(names), np.int64), 0
            for batch in batches:
                for x in batch.column(0):
                    total += 1
                    if x.is_valid:
                        seen[[*occurrences(x.as_py(), sent.value), *empty]] += 1
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(seen), pa.array(np.full(len(names), total))], names=["name", "docs_with", "_all"])

        return spread(docs).select(text).mapInArrow(run, schema)

    found = reduce(DataFrame.unionAll, map(part, key_parts(keys) or [[]]))
    return (
        found.groupBy("name")
        .agg(F.sum("docs_with").alias("docs_with"), F.sum("_all").alias("_all"))
        .select("name", "docs_with", _containment_idf(F.col("_all"), F.col("docs_with")).alias("idf"))
    )


def tf_idf(docs: DataFrame, doc_id: str, text: str, keys: DataFrame) -> DataFrame:
    """``(doc_id, name, weight, tf, idf, tfidf)`` for every document and key.

    One row per key, idf and weight, is joined by name: broadcast where the key
    table is within the size that may be sent, left to the planner otherwise.
    """
    per_key = containment_idf(docs, doc_id, text, keys).select("name", "idf").join(keys.select("name", "weight"), "name")
    if local_keys(keys.select("name", "weight")) is not None:
        per_key = F.broadcast(per_key)
    return term_frequency(docs, doc_id, text, keys).join(per_key, "name").select(
        doc_id, "name", "weight", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def tf_idf_scores(
    docs: DataFrame, doc_id: str, text: str, keys: DataFrame, reuse: Reuse | None = None
) -> DataFrame:
    """``(doc_id, raw, score)``: weighted TF-IDF sum per document, min-max scaled.

    The texts are read once; what is kept of them are the phrases that occur. An
    empty phrase adds nothing.
    """
    reuse = reuse or Reuse()
    parts = key_parts(keys)
    if len(parts) != 1:
        cells = tf_idf(docs, doc_id, text, keys)
        raw = cells.groupBy(doc_id).agg(F.sum(F.col("weight") * F.col("tfidf")).alias("raw"))
        return minmax(reuse.keep(raw), {"raw": "score"})
    words = word_count(F.col(text)).alias("words")
    found = reuse.keep(hits(docs, [doc_id, words], F.col(text), parts[0], False))
    seen = found.select(F.explode("hits").alias("h")).groupBy("h.i").agg(F.count(F.lit(1)).alias("docs_with"))
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    table = docs.sparkSession.createDataFrame([(i, k.weight) for i, k in enumerate(parts[0])], "i int, weight double")
    # One row: the factor of each key, in the keys' order. No subquery may stand in a function with a lambda.
    factor = F.col("weight") * _containment_idf(F.col("total"), F.coalesce("docs_with", F.lit(0)))
    factors = table.join(seen, "i", "left").withColumn("total", total).select("i", factor.alias("f"))
    factors = factors.agg(F.array_sort(F.collect_list(F.struct("i", "f"))).alias("a")).select(F.transform("a", lambda x: x.f).alias("a"))
    terms = F.aggregate("hits", F.lit(0.0), lambda acc, h: acc + h.n * F.get("_factors", h.i))
    raw = found.withColumn("_factors", factors.scalar()).select(
        doc_id, (terms / F.nullif(F.col("words"), F.lit(0))).alias("raw")
    )
    return minmax(reuse.keep(raw), {"raw": "score"})
