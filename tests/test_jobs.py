import pytest
from pyspark.sql import functions as F

from leadrank import fixtures as X
from leadrank.functions.contacts import slot_column
from leadrank.plans import leads
from leadrank.session import Reuse, durable, scratch_path
from leadrank.sources.form_sheet import read_sheet
from leadrank.sources import tables
from leadrank.sources.keywords import keyword_table
from leadrank.streaming import requests

AWKWARD = [
    (1, 'say "hi", then\nleave', True),
    (2, " padded\t", False),
    (3, None, None),
    (4, "back\\slash", True),
    (5, "one, two", False),
]


@pytest.mark.parametrize("writer", ["plain", "ranked"])
def test_csv_round_trip(spark, tmp_path, writer):
    df = spark.createDataFrame(AWKWARD, "rank int, text string, flag boolean")
    path = str(tmp_path / "out")
    if writer == "plain":
        tables.write_csv(df, path)
    else:
        tables.write_ranked(df, path, fmt="csv")
    assert sorted(tuple(r) for r in tables.read_csv(spark, path, df.schema).collect()) == AWKWARD


def test_ranked_sink(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "rank int, text string, flag boolean")
    tables.write_ranked(df, str(tmp_path / "p"))
    assert tables.read_parquet(spark, str(tmp_path / "p"), ["rank"]).count() == 5
    with pytest.raises(ValueError, match="rank"):
        tables.write_ranked(df.drop("rank"), str(tmp_path / "q"))


def test_company_schema():
    names = tables.company_schema().fieldNames()
    assert "Description" in names and slot_column("email", 3) in names and len(names) == 21


def test_lead_ranking_keeps_all_columns(spark, sf):
    rows = X.companies(spark, sf).join(X.contacts(spark, sf), "company_id").withColumnRenamed("lang", "lang_x")
    with Reuse() as reuse:
        best = leads.lead_ranking(rows, "company_id", X.phrases(spark), n=10, reuse=reuse).toPandas()
    assert len(best) == 10 and "lang" in best.columns and "source" in best.columns
    assert sorted(best["rank"]) == list(range(1, 11))
    assert (best[slot_column("email", 1)] != "").all()


def test_durable_cuts_lineage(spark):
    df = durable(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90


FORM = {
    "submitted": "t",
    "email": "e@x.com",
    "sector": "",
    "phrases": '"a"=2,\nb\nc=1=2\n\nb=4',
    "link": "https://f.example.com/open?id= f1 ",
}


def form(spark, *rows):
    return spark.createDataFrame([{**FORM, **r} for r in rows], requests.REQUEST_SCHEMA)


def test_request_parse(spark):
    row = requests.parse_requests(form(spark, {})).first()
    assert [(p["name"], p.weight) for p in row.phrases] == [("a", 2.0), ("c", 1.0), ("b", 4.0)]
    assert row.file_id == "f1" and row.error is None
    bad = requests.parse_requests(form(spark, {"phrases": "a=x"}, {"phrases": "\n"})).collect()
    assert [r.error for r in bad] == ["a weight is not a number", "no phrase given"]


def test_stream_resumes_after_the_last_request(spark):
    inbox, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    form(spark, {}, {"submitted": "u"}).write.json(inbox)
    run = lambda: requests.store_parsed(requests.read_requests(spark, inbox), out, state).awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 2
    run()
    assert spark.read.parquet(out).count() == 2
    form(spark, {"submitted": "v"}).write.mode("append").json(inbox)
    run()
    assert spark.read.parquet(out).count() == 3


def lines(*rows):
    import json

    return "".join(json.dumps({**FORM, **r}) + "\n" for r in rows)


def test_the_sheet_resumes_at_the_next_row(spark, tmp_path):
    """Stop and start; half-written rows wait; equal rows are requests of their own."""
    sheet, out, state = tmp_path / "sheet", str(tmp_path / "out"), str(tmp_path / "state")
    sheet.mkdir()
    run = lambda: requests.store_parsed(read_sheet(spark, str(sheet)), out, state).awaitTermination()
    found = lambda: sorted(r.row for r in spark.read.parquet(out).collect())
    (sheet / "a.jsonl").write_text(lines({}, {}, {"phrases": "x=y"}))
    run()
    assert found() == [0, 1, 2]
    run()
    assert found() == [0, 1, 2]
    more = lines({"email": "half"})
    with open(sheet / "a.jsonl", "a") as f:
        f.write(lines({}) + more[:20])
    run()
    assert found() == [0, 1, 2, 3]
    with open(sheet / "a.jsonl", "a") as f:
        f.write(more[20:] + "no json\n\n")
    (sheet / "b.jsonl").write_text(lines({"email": "next file"}))
    run()
    rows = {r.row: r for r in spark.read.parquet(out).collect()}
    assert sorted(rows) == list(range(8)) and len({r.request_id for r in rows.values()}) == 8
    assert rows[4].email == "half" and rows[7].email == "next file"
    assert [rows[k].error for k in (2, 5, 6)] == ["a weight is not a number", "no phrase given", "no phrase given"]


def test_long_sheets_are_cut_at_marks(spark, tmp_path, monkeypatch):
    from leadrank.sources import form_sheet

    monkeypatch.setattr(form_sheet, "MARK_ROWS", 7)
    monkeypatch.setattr(form_sheet, "CHUNK", 50)
    for k, n in enumerate([20, 0, 1, 33]):
        (tmp_path / f"{k}.jsonl").write_text(lines(*[{"email": f"{k}-{i}"} for i in range(n)]))
    reader = form_sheet.SheetReader(str(tmp_path))
    want = [f"{k}-{i}" for k, n in enumerate([20, 0, 1, 33]) for i in range(n)]
    assert reader.latestOffset() == {"row": 54}
    for a, b in [(0, 54), (3, 5), (6, 8), (19, 22), (20, 21), (53, 54), (10, 10)]:
        parts = form_sheet.SheetReader(str(tmp_path)).partitions({"row": a}, {"row": b})
        assert a == b or len(parts) >= (b - a) // 7
        got = [r for p in parts for r in reader.read(p)]
        assert [r[1] for r in got] == want[a:b] and [r[-1] for r in got] == list(range(a, b))


def test_rows_are_answered_once_and_in_order(spark, tmp_path):
    sheet, out, state = tmp_path / "sheet", str(tmp_path / "out"), str(tmp_path / "state")
    sheet.mkdir()
    files = spark.createDataFrame([("f1", "list.csv")], "file_id string, file_name string")
    seen = []

    def score(request, reuse):
        seen.append(request["row"])
        return keyword_table(spark, request["phrases"])

    def run():
        requests.answer_requests(read_sheet(spark, str(sheet)), files, score, out, state, at_once=1).awaitTermination()

    (sheet / "a.jsonl").write_text(lines({}, {"phrases": "a=x"}, {}, {}, {}))
    run()
    with open(sheet / "a.jsonl", "a") as f:
        f.write(lines({}, {}))
    run()
    assert seen == [0, 2, 3, 4, 5, 6]
    assert len({r.request_id for r in spark.read.parquet(f"{out}/results").collect()}) == 6


def test_answers_and_errors(spark):
    inbox, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    rows = [{}, {"link": "id=f2"}, {"phrases": "a=x"}, {"email": "boom"}, {"link": "id=unknown"}]
    form(spark, *rows).write.json(inbox)
    files = spark.createDataFrame([("f1", "list.csv"), ("f2", "list.xlsx")], "file_id string, file_name string")

    def score(request, reuse):
        if request["email"] == "boom":
            raise RuntimeError("no file")
        return keyword_table(spark, request["phrases"])

    requests.answer_requests(requests.read_requests(spark, inbox), files, score, out, state).awaitTermination()
    assert spark.read.parquet(f"{out}/results").count() == 3
    errors = sorted(r.error for r in spark.read.parquet(f"{out}/errors").collect())
    assert errors == ["RuntimeError: no file", "a weight is not a number", "the file is not a .csv", "the file is not a .csv"]


def company_file(spark, folder, name):
    rows = X.companies(spark, "/root/testdata/sf0.001").join(X.contacts(spark, "/root/testdata/sf0.001"), "company_id")
    df = rows.withColumnRenamed("lang", "lang_x").withColumn("lang_y", F.lit("?"))
    tables.write_csv(df.coalesce(1), f"{folder}/{name}")
    return rows


def test_company_file_equals_the_table(spark, tmp_path):
    rows = company_file(spark, tmp_path, "list.csv")
    (tmp_path / "keys.json").write_text('{"And the": 10, "worthless": 20}')
    got = leads.rank_company_file(spark, str(tmp_path / "list.csv"), str(tmp_path / "keys.json"), "Thatin. Of the", n=30)
    assert "_row" not in got.columns and "lang" in got.columns
    from leadrank.plans.relevance import sector_phrases

    sectors = sector_phrases(spark.createDataFrame([("Thatin. Of the",)], "s string"), "s")
    want = leads.lead_ranking(rows, "company_id", keyword_table(spark, {"and the": 10, "worthless": 20}), sectors, n=30)
    pick = lambda df: sorted((round(r["score"], 9), int(r["company_id"])) for r in df.collect())
    assert pick(got) == pick(want)


def test_request_with_company_file(spark, tmp_path):
    company_file(spark, tmp_path, "list.csv")
    inbox, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    form(spark, {"phrases": "and the=2", "sector": "Thatin. Of the"}, {"phrases": "and the", "link": "id=f3"}).write.json(inbox)
    files = spark.createDataFrame([("f1", "list.csv"), ("f3", "gone.csv")], "file_id string, file_name string")
    scorer = requests.company_file_scorer(spark, str(tmp_path), n=5)
    requests.answer_requests(requests.read_requests(spark, inbox), files, scorer, out, state).awaitTermination()
    assert spark.read.parquet(f"{out}/results").count() == 5
    assert "PATH_NOT_FOUND" in spark.read.parquet(f"{out}/errors").first().error
