"""Stored vectors, keyed by the content of their text.

The cache is a folder of commits. A commit is a Parquet folder of new vectors
under a name of its own and, once that is whole, a manifest that names it. Readers
follow manifests alone, so a run that stops half way leaves nothing that counts,
and two runs at once never see each other's halves. A manifest's number is claimed
by creating its file, which a file system does for one of several runs only; an
empty manifest is a claim that was never used.

Keys are content addresses. They are dealt to buckets by their first digits, and
a commit is laid out by bucket, so that a look-up of some keys reads only their
buckets. Runs that embed the same text at once both commit it; of several commits
that hold a key, the one with the smallest number counts, so each key has one
vector whatever the order of the runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Buckets, as first hexadecimal digits of a key.
BUCKET_DIGITS = 2


def text_key(text) -> F.Column:
    return F.sha2(text, 256)


def bucket_of(key) -> F.Column:
    return F.substring(key, 1, BUCKET_DIGITS)


def keyed_texts(texts: DataFrame, text: str) -> DataFrame:
    """``(key, text)`` of the distinct texts.

    Copies are merged before the shuffle, so a text with very many copies does
    not load one task.
    """
    keyed = texts.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    return keyed.dropDuplicates(["key"])


def missing_texts(texts: DataFrame, text: str, cached: DataFrame) -> DataFrame:
    """``(key, text)`` of the distinct texts whose key is not in ``cached``."""
    return keyed_texts(texts, text).join(cached.select("key"), "key", "left_anti")


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def manifests(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, commit, schema) of every commit that counts, in order of their numbers."""
    system, where = _files(spark, f"{path}/manifests")
    if not system.exists(where):
        return []
    names = [status.getPath().getName() for status in system.listStatus(where) if status.getPath().getName().endswith(".json")]
    if not names:
        return []
    rows = spark.read.schema("number long, commit string, schema string").json([f"{path}/manifests/{n}" for n in names]).collect()
    return sorted((r["number"], r["commit"], r["schema"]) for r in rows)


def _commit(spark: SparkSession, path: str, name: str, schema: str) -> int:
    """Write the manifest of a commit under the first free number."""
    from py4j.protocol import Py4JJavaError

    number = max([m[0] for m in manifests(spark, path)], default=-1) + 1
    while True:
        system, target = _files(spark, f"{path}/manifests/{number:012d}.json")
        try:
            out = system.create(target, False)
        except Py4JJavaError as error:
            if not system.exists(target):
                raise error
            number += 1
            continue
        out.write(json.dumps({"number": number, "commit": name, "schema": schema}).encode())
        out.close()
        return number


def read_cache(spark: SparkSession, path: str, buckets: list[str] | None = None) -> DataFrame | None:
    """All vectors that count, one row a key; None for a cache without a commit.

    ``buckets`` limits the read to those first digits. Columns that came with a
    later commit are null in earlier ones.
    """
    found = manifests(spark, path)
    if not found:
        return None
    fields = {f.name: f for _, _, schema in found for f in _parsed(schema).fields}
    whole = T.StructType([*fields.values(), T.StructField("commit", T.StringType()), T.StructField("bucket", T.StringType())])
    places = [f"{path}/commits/commit={name}" for _, name, _ in found]
    rows = spark.read.schema(whole).option("basePath", f"{path}/commits").parquet(*places)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    if len(found) > 1:
        # Keys of several commits are few; only they and their commits are looked at, no vectors.
        numbers = F.create_map(*[F.lit(x) for number, name, _ in found for x in (name, number)])
        numbered = rows.withColumn("_number", F.element_at(numbers, F.col("commit")))
        again = numbered.groupBy("key").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        again = again.select(F.col("key").alias("_again"), "_first")
        joined = numbered.join(again, F.col("key") == F.col("_again"), "left")
        rows = joined.where(F.col("_first").isNull() | (F.col("_number") == F.col("_first")))
    return rows.select(*fields)


def _parsed(schema: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema))


def cached_vectors(
    spark: SparkSession, path: str, texts: DataFrame, text: str, embed: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """All stored vectors after embedding and committing the missing ones.

    ``embed`` turns ``(key, text)`` into ``(key, ...)``. Changed texts have new
    keys, so a stale vector is never returned for them. A run that has nothing to
    add commits nothing.
    """
    cached = read_cache(spark, path)
    todo = keyed_texts(texts, text) if cached is None else missing_texts(texts, text, cached)
    made = embed(todo)
    name = uuid.uuid4().hex
    laid_out = made.withColumn("bucket", bucket_of(F.col("key")))
    # One file a bucket; a key has one digest, so buckets are even.
    place = f"{path}/commits/commit={name}"
    laid_out.repartition("bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(place)
    if cached is None or not spark.read.schema("key string").parquet(place).isEmpty():
        _commit(spark, path, name, made.schema.json())
    return read_cache(spark, path)


def vectors_of(spark: SparkSession, path: str, rows: DataFrame, text: str, embed: Callable[[DataFrame], DataFrame], vec: str = "vec") -> DataFrame:
    """``rows`` with the vector of their text from the cache, embedding only texts that have none there.

    Rows with equal texts share a vector; rows without a text have null. The cache
    has one row a key, so a text of very many rows is hot on one side only, which
    adaptive execution splits.
    """
    cached = cached_vectors(spark, path, rows, text, embed).select(F.col("key").alias("_key"), F.col(vec).alias(vec))
    keyed = rows.withColumn("_at", text_key(F.col(text)))
    return keyed.join(cached, F.col("_at") == F.col("_key"), "left").drop("_at", "_key")
