"""Corpus pipeline: five stages, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``:

* quality: documents that the quality model scores below 0.3 go. The model
  learns from the labelled documents among those given; rows without an id are
  scored like all others.
* near duplicates: of documents whose SimHash fingerprints are linked, one stays:
  the one with the smallest doc_id, one with an id before any without.
* decontamination: documents whose text holds 0.8 or more of a benchmark item go.
* secrets: findings are cut out of the texts; ``n_chars`` follows.
* encoding: doc_id, the number of SentencePiece ids, and digests of the ids and
  of the decoded text.

Stages judge rows, not ids: a row is known by its file and place, so rows that
share an id, or have none, are judged each for itself. What an operator finds
goes to the rows as notes in the shared folder (see ``row_notes``), and texts are
read once more but never shuffled or joined for it. Null texts count as empty:
they are scored, linked with other empty texts, hold no item and no secret, and
are encoded as empty. Texts of any length are worked on whole. Empty tables pass
through. Columns beyond those of ``documents`` pass through the first four stages;
names that start with ``__lr_`` are the pipeline's own.
"""

from __future__ import annotations

import sys
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from leadrank.llm import decontaminate, quality, secrets, sentencepieces, simhash  # noqa: E402
from leadrank.llm.queries import table, vocabulary  # noqa: E402
from leadrank.llm.row_notes import FILE, ROW, located, with_notes, without, without_rows, write_notes  # noqa: E402
from leadrank.llm.secrets import redact  # noqa: E402
from leadrank.llm.shared import stored  # noqa: E402
from leadrank.session import scratch_path  # noqa: E402


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = located(docs)
    featured = stored(quality.features(rows, others=[FILE, ROW]), "pipeline-features")
    model = quality.learn(featured, table(spark, sf_dir, "labels"))
    return without(rows, quality.score(featured, model).where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = located(docs)
    found = stored(simhash.near_duplicates(rows, shingle=3, bits=3, others=[FILE, ROW]), "pipeline-groups")
    # Ids first, rows without one last; the place tells equal ids apart.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW)
    stays = found.groupBy("root").agg(F.min(place).alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = found.join(stays.select("root", "stays"), "root").where(place != F.col("stays"))
    return without(rows, gone)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = located(docs)
    placed = rows.withColumn("__lr_place", F.struct(FILE, ROW))
    hits = decontaminate.contaminated(placed, table(spark, sf_dir, "benchmark"), key="__lr_place")
    # This stage runs no Python on the executors.
    return without_rows(rows, hits.select("__lr_place.*"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = located(docs)
    placed = rows.withColumn("__lr_place", F.struct(FILE, ROW))
    found = secrets.scan_versions(placed, scratch_path(spark, "pipeline-ledger"), path="__lr_place")
    notes = found.where("spans <> ''").select("__lr_place.*", F.col("spans").alias("note"))
    place, schema = docs.columns.index("text"), docs.schema

    def cut(batch: pa.RecordBatch, spans: dict[int, str | None]) -> pa.RecordBatch:
        if not spans:
            return batch
        texts = batch.column(place).to_pylist()
        for k, line in spans.items():
            texts[k] = redact([texts[k]], [line])[0]
        columns = batch.columns
        columns[place] = pa.array(texts, batch.schema.field(place).type)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    clean = with_notes(rows, write_notes(notes), cut)
    return clean.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = sentencepieces.encode_decode(docs.select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))
    return sentencepieces.digests(made)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("encoding", encoded),
]

#: SQL has no form of the first, second and last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table in the shared folder between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
