import pytest
from pyspark.sql import Window, functions as F

from leadrank.operators import messages, ranking, sites


def numbers(spark, n):
    # Two thirds of the rows share one score and one group.
    hot = F.col("id") % 3 != 0
    return spark.range(n).select(
        "id",
        F.when(hot, F.lit(0.5)).otherwise((F.col("id") * 7919 % 101) / 101).alias("score"),
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 11).cast("string")).alias("g"),
    )


def test_rank_equals_a_window(spark):
    df = numbers(spark, 1000).union(spark.createDataFrame([(5000, None, "x")], "id long, score double, g string"))
    order = ranking.best_first("score", "id")
    want = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    got = ranking.ranked(df, order)
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)


def test_numbering_with_hot_groups(spark):
    # 2,000 small groups, and one that holds most rows and spans all partitions.
    df = spark.range(12_000).select("id", F.when(F.col("id") < 2000, F.col("id")).otherwise(-1).alias("g"), (F.col("id") % 7).alias("score"))
    df = df.unionAll(df.where("id < 500").select(F.col("id") + 20_000, "g", "score"))
    got = ranking.numbered(df, ["g"], ["score", "id"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("score", "id")).cast("bigint"))
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)


def test_numbering_of_a_null_group(spark):
    df = spark.range(50).select("id", F.when(F.col("id") > 45, F.lit("a")).alias("g"))
    got = ranking.numbered(df, ["g"], ["id"], "n").collect()
    assert sorted((r.id, r.n) for r in got) == [(i, i + 1 if i <= 45 else i - 45) for i in range(50)]


def test_minmax(spark):
    df = spark.createDataFrame([(1, 2.0, 7.0), (2, 4.0, 7.0), (3, None, 7.0)], "id int, x double, c double")
    rows = ranking.minmax(df, {"x": "sx", "c": "sc"}).orderBy("id").collect()
    assert [(r.sx, r.sc) for r in rows] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]


@pytest.mark.parametrize("rows, n, expected", [(2000, -1, 100), (250, -1, 25), (250, 40, 40), (9, -1, 0)])
def test_choose_top(spark, rows, n, expected):
    df = spark.range(rows).select("id", F.col("id").cast("double").alias("score"), F.lit(20).alias("words"))
    got = ranking.choose_top(df, ranking.best_first("score", "id"), F.col("words"), 20, n)
    assert got.count() == expected


def test_choose_top_counts_before_the_length_filter(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("score"), (F.col("id") % 50).alias("words"))
    got = ranking.choose_top(df, ranking.best_first("score", "id"), F.col("words"), 20, -1)
    assert [r.id for r in got.orderBy("rank").collect()] == list(range(99, 89, -1))


def test_combine_product(spark):
    df = spark.createDataFrame([(1, 0.0, 4.0), (2, 10.0, 2.0), (3, 5.0, 3.0)], "id int, k double, s double")
    rows = ranking.combined(df, "k", "s", "product").orderBy("id").collect()
    assert [(r.k, r.s, r.score) for r in rows] == [(0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.5, 0.5, 1.0)]


def mail(spark):
    rows = [
        ("m1", 3, "Ann@x.com", ["me@x.com"], "c1"),
        ("m2", 1, "ann@x.com ", ["me@x.com", "Bo@x.com", "bo@x.com"], "c2"),
        ("m3", 2, "me@x.com", ["ann@x.com"], "c3"),
        ("m4", 2, "zed@x.com", ["me@x.com"], "c4"),
    ]
    return spark.createDataFrame(rows, "message_id string, sent int, from_addr string, to_addrs array<string>, content string")


def people(spark):
    return spark.createDataFrame([("ann@x.com",), ("bo@x.com",), ("cy@x.com",)], "email string")


def test_long_table(spark):
    got = messages.long_table(people(spark), mail(spark)).collect()
    assert sorted(tuple(r) for r in got) == [
        ("ann@x.com", "from", 1, "c2"),
        ("ann@x.com", "from", 2, "c1"),
        ("ann@x.com", "to", 1, "c3"),
        ("bo@x.com", "to", 1, "c2"),
    ]


def test_wide_table(spark):
    long = messages.long_table(people(spark), mail(spark))
    wide = messages.wide_table(people(spark), long)
    assert wide.columns == ["email", "row", "from_1", "from_2", "to_1"]
    want = [("ann@x.com", 0, "c2", "c1", "c3"), ("bo@x.com", 0, None, None, "c2"), ("cy@x.com", 0, None, None, None)]
    assert sorted(tuple(r) for r in wide.collect()) == want
    direct = messages.wide_mail(people(spark), mail(spark))
    assert direct.columns == wide.columns and sorted(tuple(r) for r in direct.collect()) == want
    cut = {(r.email, r.row): r for r in messages.wide_mail(people(spark), mail(spark), max_columns=2).collect()}
    assert set(cut) == {("ann@x.com", 0), ("ann@x.com", 1), ("bo@x.com", 0), ("cy@x.com", 0)}
    assert (cut["ann@x.com", 0].from_1, cut["ann@x.com", 1].from_1, cut["ann@x.com", 0].to_1) == ("c2", "c1", "c3")
    none = messages.wide_mail(people(spark), mail(spark).limit(0))
    assert none.columns == ["email", "row"] and none.count() == 3


def test_wide_table_goes_on_in_further_rows(spark):
    long = spark.range(1500).select(
        F.lit("ann@x.com").alias("email"), F.lit("to").alias("direction"), (F.col("id") + 1).alias("message_index"), F.col("id").cast("string").alias("message_content")
    )
    wide = messages.wide_table(people(spark), long, max_columns=1000)
    rows = {(r.email, r.row): r for r in wide.collect()}
    assert set(rows) == {("ann@x.com", 0), ("ann@x.com", 1), ("ann@x.com", 2), ("bo@x.com", 0), ("cy@x.com", 0)}
    assert [rows["ann@x.com", k][f"to_{i}"] for k in range(3) for i in range(1, 501)] == [str(i) for i in range(1500)]


def test_bodies_stay_out_of_the_match(spark):
    plan = messages.matched_ids(people(spark), mail(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Join")[0]


def test_large_top_n_has_no_single_partition(spark):
    df = spark.range(1000).select("id", (F.col("id") % 13).alias("score"))
    cut = ranking.top_n(df, [F.desc("score"), F.asc("id")], 3_000_000)
    assert cut.count() == 1000 and cut.where("rank = 1").first().score == 12
    ranked = ranking.top_n(df, [F.desc("score"), F.asc("id")], 200_000)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "TakeOrdered" not in plan


@pytest.mark.parametrize("n", [100_001, 3_000_000, 4_999_999, 6_000_000])
def test_large_cuts_equal_the_sorted_cut(spark, n):
    """Survivors of the sketch, ranked, are the first rows of the whole order."""
    total = 5_000_000
    df = spark.range(total).select("id", ((F.col("id") * 7919) % 1_000_003 % 50_021).cast("double").alias("score"))
    order = ranking.best_first("score", "id")
    kept = ranking.survivors(df, order.leading, n)
    rows = kept.count()
    assert rows >= min(n, total) and (n > total or rows <= n + total * 5e-4 + 200)
    cut = ranking.top_n(df, order, n)
    assert cut.count() == min(n, total)
    # Every row of the cut is before every row outside, and ranks count up.
    last = cut.orderBy(F.desc("rank")).first()
    assert last["rank"] == min(n, total)
    before = df.where((F.col("score") > last.score) | ((F.col("score") == last.score) & (F.col("id") <= last.id)))
    assert before.count() == min(n, total)
    some = cut.where(F.col("rank") % 499_979 == 1).collect()
    for r in some:
        ahead = df.where((F.col("score") > r.score) | ((F.col("score") == r.score) & (F.col("id") < r.id))).count()
        assert ahead == r["rank"] - 1


def test_cuts_with_ties_nulls_and_nans(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ONE_TASK_ROWS", 5)
    rows = [(i, s) for i, s in enumerate([None, 1.0, float("nan"), 1.0, None, 2.0, 1.0, 1.0, 0.0, 3.0, 1.0, float("nan")])]
    df = spark.createDataFrame(rows, "id long, score double")
    order = ranking.best_first("score", "id")
    want = [r.id for r in df.orderBy(*order).collect()]
    for n in (6, 7, 9, 11, 12, 40):
        got = ranking.top_n(df, order, n).orderBy("rank").collect()
        assert [r.id for r in got] == want[:n] and [r["rank"] for r in got] == list(range(1, len(got) + 1))


def payload(spark, parts):
    import json

    record = {"headers": [{"name": "To", "value": "x"}, {"name": "Subject", "value": "Hi"}], "parts": parts}
    df = spark.createDataFrame([(json.dumps(record),)], "j string")
    parsed = df.select(messages.payload_of(F.col("j")).alias("p"))
    return parsed.select(messages.message_text(F.col("p")).alias("t")).first().t


def part(kind, text=None, parts=None):
    import base64

    out = {"mimeType": kind, "body": {}}
    if text is not None:
        out["body"]["data"] = base64.urlsafe_b64encode(text.encode()).decode()
    if parts is not None:
        out["parts"] = parts
    return out


def test_message_text(spark):
    plain = part("text/plain", "été ÿ?>~")
    assert payload(spark, [part("text/html", "x"), plain]) == "Subject: Hi\n\nété ÿ?>~"
    assert payload(spark, [part("multipart/mixed", None, [part("multipart/alternative", None, [plain])])]).endswith("ÿ?>~")
    # The first multipart child ends the search, and single-part mail has no text.
    assert payload(spark, [part("multipart/mixed", None, [part("text/html", "x")]), plain]) == "Subject: Hi\n\n"
    assert payload(spark, None) == "Subject: Hi\n\n"


def extracted(parts):
    """A recursive reading of the same rule."""
    import base64

    for p in parts or []:
        if p["mimeType"] == "text/plain" and "data" in p["body"]:
            return base64.urlsafe_b64decode(p["body"]["data"]).decode()
        if "parts" in p:
            return extracted(p["parts"])
    return ""


@pytest.mark.parametrize("seed", range(6))
def test_message_text_at_any_depth(spark, seed):
    import json
    import random

    rng = random.Random(seed)

    def tree(depth):
        parts = []
        for _ in range(rng.randint(1, 3)):
            kind = rng.choice(["text/plain", "text/html", "multipart/mixed"])
            if depth and kind == "multipart/mixed":
                parts.append(part(kind, None, tree(depth - 1)))
            else:
                parts.append(part(kind, f"{kind} {depth} {rng.random()}" if rng.random() < 0.7 else None))
        return parts

    deep = [part("text/plain", "the bottom")]
    for _ in range(12):
        deep = [part("text/html", "no"), part("multipart/mixed", None, deep)]
    payloads = [deep, [], [part("multipart/mixed", None, [])]] + [tree(10) for _ in range(20)]
    rows = [(i, json.dumps({"headers": [], "parts": p})) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "i int, j string").select("i", messages.message_text(messages.payload_of(F.col("j"))).alias("t"))
    assert {r.i: r.t for r in df.collect()} == {i: "Subject: \n\n" + extracted(p) for i, p in enumerate(payloads)}


def web(spark):
    rows = [
        (1, "https://A.example.com/fr/home", "<p>and the</p>"),
        (2, "https://a.example.com/en/x?q=1", "<p>and the and</p>"),
        (3, "http://a.example.com/de/y", "<p>and the</p>"),
        (4, "https://a.example.com/en", "<p>the</p>"),
        (5, "https://b.example.com/", "<p>none</p>"),
        (6, "not a url", "<p>and the</p>"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_site_text_and_parts(spark):
    # One space behind the home page, nothing between the others.
    got = sites.site_text(web(spark)).collect()
    assert sorted(tuple(r) for r in got) == [("a.example.com", 0, "and the and the andthe"), ("b.example.com", 0, "none ")]
    cut = sites.site_text(web(spark), part_bytes=15).collect()
    assert sorted(tuple(r) for r in cut) == [
        ("a.example.com", 0, "and the and the and"),
        ("a.example.com", 1, "the"),
        ("b.example.com", 0, "none "),
    ]


@pytest.mark.parametrize("blocked", [False, True])
def test_site_scores_equal_scores_of_the_whole_text(spark, monkeypatch, blocked):
    from leadrank.operators import phrases
    from leadrank.operators.phrases import presence_score
    from leadrank.sources.keywords import keyword_table

    if blocked:
        monkeypatch.setattr(phrases, "MAX_KEY_BYTES", 70)
    keys = keyword_table(spark, {"and the": 10, "none": 1})
    got = sorted((r.site, r.score, r.density) for r in sites.site_scores(web(spark), keys).collect())
    # Pages joined by line breaks: a phrase cannot run over one. The length holds one space.
    pages = sites.site_pages(web(spark)).groupBy("site").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "text"))), lambda x: x.text), "\n").alias("text"),
        (F.sum(F.length("text")) + 1).alias("chars"),
    )
    want = [
        (r.site, r.score, r.score * 1e6 / r.chars)
        for r in presence_score(pages, "site", "text", keys).join(pages, "site").orderBy("site").collect()
    ]
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1:] == pytest.approx(w[1:])
