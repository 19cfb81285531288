import random

import pytest
from pyspark.sql import functions as F

from leadrank.llm import row_notes
from leadrank.llm.row_notes import FILE, ROW


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("rows") / "t.parquet")
    spark.range(100_000).select((F.col("id") % 7).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.col("id").alias("n")).repartition(3, "n").write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("sent", [0, 1000])
@pytest.mark.parametrize("share", [0.0, 0.01, 1.0])
def test_rows_go_by_file_and_place(spark, table, share, sent):
    rows = row_notes.located(table)
    gone = rows.where(F.rand(3) < share) if share < 1 else rows
    numbers = {r.n for r in gone.collect()}
    # The same rows, whatever way they are told.
    marked = rows.where(F.col("n").isin(sorted(numbers)) if 0 < share < 1 else F.lit(share == 1.0))
    want = sorted(set(range(100_000)) - numbers)
    for left in (row_notes.without(rows, marked), row_notes.without_rows(rows, marked, sent)):
        assert left.columns == ["doc_id", "text", "n"]
        assert [r.n for r in left.select("n").orderBy("n").collect()] == want


def test_notes_come_to_their_rows(spark, table, monkeypatch):
    rng = random.Random(1)
    told = {k: f"note {k}" for k in rng.sample(range(100_000), 300)}
    notes = spark.createDataFrame(list(told.items()), "k long, note string")
    rows = row_notes.located(table)
    folder = row_notes.write_notes(rows.join(notes, F.col("n") == F.col("k")).select(FILE, ROW, "note"))

    def work(batch, found):
        import pyarrow as pa

        texts = batch.column(1).to_pylist()
        for k, note in found.items():
            texts[k] = note
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts), batch.column(2)], names=batch.schema.names)

    got = {r.n: r.text for r in row_notes.with_notes(rows, folder, work).collect()}
    assert got == {k: told.get(k, f"text {k}") for k in range(100_000)}


def test_tables_from_elsewhere_are_written_first(spark):
    rows = row_notes.located(spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string").repartition(1))
    assert sorted(r[ROW] for r in rows.collect()) == [0, 1, 2]
    assert row_notes.without(rows, rows.where(F.col(ROW) == 1)).count() == 2
    empty = row_notes.located(spark.createDataFrame([], "doc_id long, text string"))
    assert row_notes.without(empty, empty).count() == 0 and row_notes.without_rows(empty, empty).count() == 0
