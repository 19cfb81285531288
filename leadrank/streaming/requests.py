"""Ranking requests from a form, as a stream of rows.

Each request names a company file and brings its own phrases and sector. The
stream's checkpoint remembers what was handled; results and errors are written
under the request's id with overwrite, so a replayed batch changes nothing. Rows
of a sheet have numbers: each is a request of its own, even where it repeats
another, and requests are taken up in the order of their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leadrank.plans.leads import rank_company_file
from leadrank.session import Reuse

# Column order is that of the form sheet.
REQUEST_SCHEMA = StructType(
    [StructField(name, StringType()) for name in ("submitted", "email", "sector", "phrases", "link")]
)
PHRASE_TYPE = "array<struct<name:string,weight:double>>"


def read_requests(spark: SparkSession, folder: str, fmt: str = "json", max_files: int = 100) -> DataFrame:
    """Stream of form rows from files that appear in ``folder``."""
    reader = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(fmt).load(folder)


def phrase_entries(text: Column) -> Column:
    """``phrase=weight`` lines as ``array<struct<name, weight>>``.

    The weight is 1 unless a line has exactly one ``=``; it is null when it is
    not a number. Blank phrases are dropped; the last of equal phrases wins.
    """
    lines = F.transform(F.split(text, "\n"), lambda line: F.split(line, "="))
    entries = F.transform(
        lines,
        lambda p: F.struct(
            F.regexp_replace(F.get(p, F.lit(0)), r'^"+|"+$', "").alias("name"),
            F.when(
                F.size(p) == 2, F.regexp_replace(F.get(p, F.lit(1)), r"^,+|,+$", "").try_cast("double")
            )
            .otherwise(F.lit(1.0))
            .alias("weight"),
        ),
    )
    return F.filter(entries, lambda e: F.trim(e["name"]) != "")


def last_wins(entries: Column) -> Column:
    return F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["name"] == e["name"]),
    )


def parse_requests(rows: DataFrame) -> DataFrame:
    """``(request_id, email, sector, phrases, file_id, error)`` from form rows, and ``row`` where they have numbers.

    Narrow, so it runs on a stream or a table. ``error`` is null for a request
    that can be worked on.
    """
    fields = [F.coalesce(F.col(c), F.lit("")) for c in REQUEST_SCHEMA.fieldNames()]
    numbers = ["row"] if "row" in rows.columns else []
    fields += [F.col(c).cast("string") for c in numbers]
    staged = rows.withColumn("_entries", phrase_entries(F.coalesce("phrases", F.lit(""))))
    bad_weight = F.exists("_entries", lambda e: e.weight.isNull())
    return staged.select(
        F.sha2(F.concat_ws("\x1f", *fields), 256).alias("request_id"),
        "email",
        "sector",
        last_wins(F.col("_entries")).cast(PHRASE_TYPE).alias("phrases"),
        F.trim(F.element_at(F.split("link", "="), -1)).alias("file_id"),
        F.when(bad_weight, F.lit("a weight is not a number"))
        .when(F.size("_entries") == 0, F.lit("no phrase given"))
        .alias("error"),
        *numbers,
    )


def gate_requests(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``file_name`` and mark requests whose file is not a ``.csv``.

    ``files`` is ``(file_id, file_name)``; file ids are unique.
    """
    named = parsed.join(files, "file_id", "left")
    is_csv = F.coalesce(F.endswith("file_name", F.lit(".csv")), F.lit(False))
    return named.withColumn("error", F.coalesce("error", F.when(~is_csv, F.lit("the file is not a .csv"))))


def store_parsed(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Write parsed requests to a parquet table; returns the started query."""
    writer = (
        parse_requests(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, once).start()


def _trigger(writer, once: bool):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")


def company_file_scorer(spark: SparkSession, folder: str, **options) -> Callable[[dict, Reuse], DataFrame]:
    """Scorer that ranks the request's company CSV from ``folder``."""

    def score(request: dict, reuse: Reuse) -> DataFrame:
        path = f"{folder}/{request['file_name']}"
        return rank_company_file(spark, path, request["phrases"], request["sector"], reuse=reuse, **options)

    return score


def _store_errors(problems: DataFrame, out: str) -> None:
    """Write ``(request_id, error)`` rows under ``out/errors``, each over its own former one, in one job."""
    writer = problems.select("request_id", "error").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("request_id").parquet(f"{out}/errors")


def _drop_error(spark: SparkSession, out: str, request_id: str) -> None:
    """Remove the error of an earlier, failed try."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/errors/request_id={request_id}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def answer_requests(
    stream: DataFrame,
    files: DataFrame,
    score: Callable[[dict, Reuse], DataFrame],
    out: str,
    checkpoint: str,
    once: bool = True,
    at_once: int = 4,
):
    """Score every request of the stream; returns the started query.

    ``score`` gets a request as a dict (``phrases`` maps name to weight) and
    returns its result table, which is stored under ``out/results``; what it
    keeps in the ``Reuse`` is freed then. Rejected and failed requests go to
    ``out/errors`` with their reason, and the stream goes on. All rejects of a
    batch are one write. Accepted requests come to the driver a window at a time
    and ``at_once`` of them are scored together, each a distributed job; with 1
    they are answered strictly one after the other, in the order of their rows
    where these have numbers. A success removes the error of an earlier try.
    """

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession

        def answer(request: dict) -> tuple[str, str] | None:
            request["phrases"] = {p["name"]: p["weight"] for p in request["phrases"]}
            request_id = request["request_id"]
            try:
                with Reuse() as reuse:
                    score(request, reuse).write.mode("overwrite").parquet(f"{out}/results/request_id={request_id}")
                _drop_error(spark, out, request_id)
            except Exception as failure:  # a failed request must not stop the stream
                return request_id, f"{type(failure).__name__}: {failure}"
            return None

        with Reuse() as reuse:
            gated = reuse.keep(gate_requests(parse_requests(batch), files))
            _store_errors(gated.where("error is not null"), out)
            # A request that arrives twice in a batch is one.
            accepted = gated.where("error is null").dropDuplicates(["request_id"])
            accepted = (accepted.orderBy("row") if "row" in accepted.columns else accepted).toLocalIterator()
            with ThreadPoolExecutor(at_once) as pool:
                while window := [row.asDict() for row in islice(accepted, 16 * at_once)]:
                    if failed := [f for f in pool.map(answer, window) if f is not None]:
                        _store_errors(spark.createDataFrame(failed, "request_id string, error string"), out)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, once).start()
