"""Secret scan over an incremental blob ledger.

Every version of every text is addressed by the SHA-256 of its content. The
ledger holds one row per (blob, rule version) that was ever scanned. A run finds
the blobs that have no such row, scans one copy of each, appends the findings
and joins them back to every path that holds the blob, now or in earlier
versions. A second run over the same versions scans nothing; a new rule version
scans every blob once more.

Blobs are counted and matched by address alone, with partial aggregation, so a
text that a third of all paths share moves once. The scan itself runs whole
texts through three patterns; spans are code points, end exclusive, the whole
match; a match that fails its length test is dropped, with what it covers.

A null text counts as empty and has no findings. Repeated paths and versions
stay as rows. Paths may be null. An empty table scans nothing. Very long texts are
scanned whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadrank.llm.shared import batch

#: Changes with the patterns below; findings of another version do not count.
RULES = "base-1"
# Kind, pattern, group whose length counts, least length.
KINDS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
LEDGER = "blob string, rule_version string, n_assign bigint, n_access bigint, n_hex bigint, spans string"


def compiled() -> list:
    import re

    # The hex pattern in this form skips failing runs early; the runs it gives are the same.
    faster = {"hex": r"[0-9a-f]{16,}", "access": r"AKIA[A-Z0-9]{14,}"}
    flags = {"assign": re.IGNORECASE | re.ASCII}
    return [(kind, re.compile(faster.get(kind, p), flags.get(kind, 0)), group, least) for kind, p, group, least in KINDS]


def spans_of(text: str | None, rules: list) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every finding, in order."""
    found = []
    for number, (_, pattern, group, least) in enumerate(rules):
        for m in pattern.finditer(text or ""):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def scan(blobs: DataFrame, rule_version: str = RULES) -> DataFrame:
    """Findings of each ``(blob, text)`` row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = compiled()
        names = [r[0] for r in rules]
        kinds = ["blob", "rule_version", *[f"n_{n}" for n in names], "spans"]
        schema = pa.schema([(k, pa.int64() if k.startswith("n_") else pa.string()) for k in kinds])
        for rows in batches:
            out: dict[str, list] = {k: [] for k in kinds}
            out["blob"] = rows.column(0).to_pylist()
            for text in rows.column(1):
                spans = spans_of(text.as_py(), rules)
                out["rule_version"].append(rule_version)
                for number, name in enumerate(names):
                    out[f"n_{name}"].append(sum(s[1] == number for s in spans))
                out["spans"].append(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans))
            yield batch(out, schema)

    return blobs.select("blob", "text").mapInArrow(run, LEDGER)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; a folder that is not there yet is an empty ledger."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def scan_versions(
    versions: DataFrame, ledger: str, path: str = "path", text: str = "text", rule_version: str = RULES
) -> DataFrame:
    """``(path, blob, n_assign, n_access, n_hex, spans)`` of every row of ``versions``.

    ``ledger`` is a folder that grows by the blobs this run is the first to scan.
    """
    spark = versions.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    held = versions.select(F.col(path).alias("path"), F.sha2(whole.cast("binary"), 256).alias("blob"), whole.alias("text"))
    seen = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version).select("blob")
    # One path for each unseen blob; its row brings the text.
    unseen = held.groupBy("blob").agg(F.min(F.struct("path")).alias("first")).join(seen, "blob", "left_anti")
    first = unseen.select(F.col("blob").alias("b"), F.col("first.path").alias("p"))
    texts = held.join(first, (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("p")), "left_semi")
    # A repeated row may bring the same blob twice.
    scan(texts, rule_version).dropDuplicates(["blob"]).write.mode("append").parquet(ledger)
    # Two writers at once may both have scanned a blob; their findings are the same.
    known = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == rule_version).dropDuplicates(["blob"])
    return held.select("path", "blob").join(known, "blob", "left").select(
        F.col("path").alias(path), "blob", "n_assign", "n_access", "n_hex", "spans"
    )


def redact(texts: list[str | None], spans: list[str | None], mark: str = "[secret]") -> list[str | None]:
    """Texts with every span, or run of overlapping spans, replaced by ``mark``."""
    out = []
    for text, line in zip(texts, spans, strict=True):
        if text is None or not line:
            out.append(text)
            continue
        parts, at = [], 0
        for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in line.split(",")):
            if a >= at:
                parts.extend((text[at:a], mark))
            at = max(at, b)
        out.append("".join(parts) + text[at:])
    return out
