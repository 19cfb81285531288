"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadrank.llm import (
    decontaminate,
    heap_bounds,
    importance,
    language,
    packed_ids,
    quality,
    quantised,
    retrieval_packing,
    secrets,
    sentencepieces,
    simhash,
    substrings,
    warc,
)
from leadrank.llm.shared import stored
from leadrank.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quantised(spark, sf_dir):
    found = quantised.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query
def op2_warc(spark, sf_dir):
    folder = scratch_path(spark, "warc")
    read = warc.read(warc.write(table(spark, sf_dir, "pages"), folder), folder)
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", simhash.hexadecimal(F.col("print")).alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op5_quality(spark, sf_dir):
    featured = stored(quality.features(table(spark, sf_dir, "documents")), "quality-features")
    model = quality.learn(featured, table(spark, sf_dir, "labels"))
    scored = quality.score(featured, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op6_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan_versions(docs, scratch_path(spark, "blob-ledger"), path="doc_id")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans"
    )


@query
def op7_substrings(spark, sf_dir):
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.digests(sentencepieces.encode_decode(docs, vocabulary("piece_bpe_32k.model")))


@query
def op9_packed_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "packed-ids")
    manifest = packed_ids.write_packed(docs, vocabulary("byte_bpe_50k.json"), folder)
    return packed_ids.digests(packed_ids.read_packed(manifest, folder))


@query
def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op11_clusters(spark, sf_dir):
    found = heap_bounds.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join("centroid", ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


@query
def op12_packing(spark, sf_dir):
    pieces = retrieval_packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op13_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
