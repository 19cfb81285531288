import math

import pytest
from pyspark.sql import functions as F

from leadrank.functions import text as T
from leadrank.functions.html import html_text, visible_text
from leadrank.operators import phrases, prompts
from leadrank.sources.keywords import keyword_table, parse_keywords, read_keywords


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, t string")


def test_sentences(spark):
    assert one(spark, T.sentences(F.col("t")), t="Ab c. D e? f! 9") == ["Ab c.", "D e?", "f! 9"]
    assert one(spark, T.sentences(F.col("t")), t="a.b. é x") == ["a.b. é x"]


def test_word_count_and_strip(spark):
    assert one(spark, T.word_count(F.col("t")), t="\t a\x0bb\n c ") == 3
    assert one(spark, T.word_count(F.col("t")), t=" \n") == 0
    assert one(spark, T.clean_field(F.col("t")), t="\t Dee\x0b") == "dee"


def test_phrase_count_whole_words(spark):
    count = lambda phrase, escape=True: T.phrase_count(F.col("t"), F.lit(phrase), escape)
    assert one(spark, count("msp"), t="msp MSP cloud msps") == 2
    assert one(spark, count("la"), t="là la éla laé") == 1
    assert one(spark, count("a.b"), t="a.b axb") == 1
    assert one(spark, count("a.b", False), t="a.b axb") == 2
    assert one(spark, count("a a"), t="a a a a a") == 2


def test_presence_score_and_density(spark):
    keys = keyword_table(spark, {"msp": 5, "cloud": 5})
    row = phrases.presence_score(docs(spark, "msp MSP cloud"), "id", "t", keys).first()
    assert row.score == 35
    assert row.density == pytest.approx(35 * 1e6 / 13)


def test_token_normalization(spark):
    keys = keyword_table(spark, {"back-up": 1})
    found = phrases.phrase_counts(docs(spark, "A back - up, and BACK-UP."), "id", "t", keys, tokenize=True)
    assert found.first().n == 2


def test_term_frequency(spark):
    keys = keyword_table(spark, {"aa": 1, "zz": 1})
    rows = {r.name: r.tf for r in phrases.term_frequency(docs(spark, "aaaa b"), "id", "t", keys).collect()}
    assert rows == {"aa": 1.0, "zz": 0.0}


def test_tf_idf_small_case(spark):
    table = docs(spark, "document text here", "another document text", "keyword1 here")
    keys = keyword_table(spark, {"keyword1": 1.5, "document": 2.0})
    cells = {(r.id, r.name): r.tfidf for r in phrases.tf_idf(table, "id", "t", keys).collect()}
    assert cells[(2, "keyword1")] == pytest.approx(0.5 * math.log(3 / 2))
    assert cells[(0, "document")] == pytest.approx(math.log(3 / 3) / 3)
    scores = {r.id: r.score for r in phrases.tf_idf_scores(table, "id", "t", keys).collect()}
    assert scores == {0: 0.0, 1: 0.0, 2: 1.0}


def test_large_phrase_tables_go_in_parts(spark, monkeypatch):
    table = docs(spark, "msp MSP cloud", "cloud and cloud", "none")
    keys = keyword_table(spark, {"msp": 5, "cloud": 5, "and": 2})
    direct = [
        sorted(phrases.phrase_counts(table, "id", "t", keys).collect()),
        sorted(phrases.presence_score(table, "id", "t", keys).collect()),
        sorted(phrases.tf_idf(table, "id", "t", keys).collect()),
        sorted(phrases.tf_idf_scores(table, "id", "t", keys).collect()),
    ]
    monkeypatch.setattr(phrases, "MAX_KEY_BYTES", 70)
    assert len(phrases.key_parts(keys)) > 1
    joined = [
        sorted(phrases.phrase_counts(table, "id", "t", keys).collect()),
        sorted(phrases.presence_score(table, "id", "t", keys).collect()),
        sorted(phrases.tf_idf(table, "id", "t", keys).collect()),
        sorted(phrases.tf_idf_scores(table, "id", "t", keys).collect()),
    ]
    for a, b in zip(direct, joined):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert tuple(x) == pytest.approx(tuple(y))


ODD_TEXTS = [
    "", " ", "la", "là la éla laé LA", "a a a a a", "ab-ab ab_ab ab", "c++ c++x xc++ ++c", "Straße STRASSE ſt ST", "K k K ΑΣ ας σ Σ",
    "mark\u0301 mark e\u0301a ea", "x\u200dy x y", "٣ 3 a٣", "İi ıI i̇", "日本 日本語 日", "😀a 😀 a", "a.b a.b.a.b axb", "AB aB\tAb\nab", "_a_ a", "№ n o", "\x00a a",
]
ODD_PHRASES = [
    "la", "a a", "ab", "c++", "++c", "+", "straße", "st", "k", "ας", "Σ", "mark", "ea", "x", "٣", "i", "İ", "日本", "😀", "a.b", "A.B.A", "_a_", "a", "aa", "№", "\\E", "-", " ",
]


def test_counts_are_those_of_the_pattern(spark):
    """The automaton against a regular expression per phrase."""
    table = docs(spark, *ODD_TEXTS)
    keys = keyword_table(spark, {p: 1 for p in ODD_PHRASES})
    names = [r.name for r in keys.collect()]
    counts = F.array(*[F.struct(F.lit(p).alias("name"), T.phrase_count(F.col("t"), F.lit(p)).cast("bigint").alias("n")) for p in names])
    want = table.select("id", F.inline(counts))
    got = phrases.phrase_counts(table, "id", "t", keys)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    parts = F.array(*[F.struct(F.lit(p).alias("name"), T.substring_count(F.col("t"), F.lit(p)).alias("n")) for p in names])
    want = table.select("id", F.inline(parts))
    got = phrases.grid(table, ["id"], F.col("t"), keys, False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_random_counts(spark, seed):
    import random
    import re

    rng = random.Random(seed)
    alphabet = "aAbB é-._ "
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(60)]
    names = sorted({"".join(rng.choices("ab é-", k=rng.randint(1, 4))) for _ in range(60)})
    got = {(r.id, r.name): r.n for r in phrases.phrase_counts(docs(spark, *texts), "id", "t", spark.createDataFrame([(n, 1.0) for n in names], "name string, weight double")).collect()}
    for i, t in enumerate(texts):
        for n in names:
            assert got[i, n] == len(re.findall(r"\b" + re.escape(n) + r"\b", t.lower(), re.IGNORECASE)), (t, n)


def test_null_texts_and_empty_phrases(spark):
    table = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "id long, t string")
    keys = spark.createDataFrame([("", 1.0), ("a", 2.0)], "name string, weight double")
    got = {(r.id, r.name): r.n for r in phrases.phrase_counts(table, "id", "t", keys).collect()}
    assert got == {(1, ""): None, (1, "a"): None, (2, ""): 0, (2, "a"): 0, (3, ""): 4, (3, "a"): 1}
    scores = {r.id: r.score for r in phrases.presence_score(table, "id", "t", keys).collect()}
    assert scores == {1: None, 2: 0.0, 3: 12.0}
    seen = {r.name: (r.docs_with, r.idf) for r in phrases.containment_idf(table, "id", "t", keys).collect()}
    assert seen == {"": (2, 0.0), "a": (1, pytest.approx(math.log(1.5)))}
    empty = table.limit(0)
    assert phrases.phrase_counts(empty, "id", "t", keys).collect() == []
    assert phrases.phrase_counts(table, "id", "t", keys.limit(0)).collect() == []


def test_ten_thousand_phrases_move_no_text(spark):
    """One pass, no join and no shuffle of texts; the counts are those of a few patterns."""
    import contextlib
    import io

    names = [f"w{i} w{i + 1}" for i in range(9_990)] + ["w1", "w2 w3 w4", "W5", "w5 w6", "zz", "w", "1 w2", "w7 w8 w9 w10", "w8 w9", "w9"]
    keys = spark.createDataFrame([(n, 1.0) for n in dict.fromkeys(names)], "name string, weight double")
    table = docs(spark, *[" ".join(f"w{j % 40}" for j in range(i, i + 200)) for i in range(50)])
    scored = phrases.presence_score(table.hint("coalesce", 1), "id", "t", keys)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        scored.explain()
    assert "Join" not in out.getvalue() and "Generate" not in out.getvalue()
    picked = list(dict.fromkeys(names[:60] + names[-10:]))
    weighted = F.array(*[F.struct(F.lit(1.0).alias("weight"), T.phrase_count(F.col("t"), F.lit(n)).alias("n")) for n in picked if n.lower() != "w5"])
    some = keys.where(F.col("name").isin([n for n in picked if n != "W5"]))
    got = {r.id: r.score for r in phrases.presence_score(table, "id", "t", some).collect()}
    assert got == {r.id: r.s for r in table.select("id", phrases.presence(weighted).alias("s")).collect()}
    assert {r.id for r in scored.where("score > 0").collect()} == set(range(50))


def test_reply_tail(spark):
    assert one(spark, T.reply_tail(F.col("t")), t="because of x\ny") == "of x"
    assert one(spark, T.reply_tail(F.col("t")), t="none") is None


def test_html_text(spark):
    page = "<html><head><title>x</title></head><body><!-- a <b> --><p>A&amp;B <b>c</b></p><script>var t='</p>';</script> &lt;d&gt;</body>"
    assert one(spark, html_text(F.col("t")), t=page) == "A&B c <d>"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<head><script>..</script><title>TITLE</title></head>x", "x"),
        ('<script>a="</style>"; leak()</script>x', "x"),
        ("<script\ntype=a>code()</script >x<SCRIPT>more</Script>y", "x y"),
        ("<header>kept</header><styled>too</styled><style>p{}</style>", "kept too"),
        ("<!-- <script> -->seen<!-- </script> -->", "seen"),
        ("before<script>never closed", "before"),
        ("caf&eacute; &#8217;&#x2019; &amp;lt; &bogus; &nbsp;|&#160;| a&b &#55296; &#0;", "café ’’ &lt; &bogus; | | a&b &#55296; &#0;"),
        ("", ""),
    ],
)
def test_html_text_cases(spark, page, text):
    assert one(spark, html_text(F.col("t")), t=page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<a title="1 > 0">go</a>', "go"),
        ("<a title='>' href=x\"y>z</a>", "z"),
        ("a < b <c> d", "a < b d"),
        ("<p hidden>x<p>y", "y"),
        ("<ul><li HIDDEN=until-found>a<ul><li>b</ul><li>c</ul>", "c"),
        ("<section><b hidden>q</section>r", "r"),
        ("<div hidden><div>x</div>y</div>z", "z"),
        ("<img alt='a>b' hidden>c<br hidden>d", "c d"),
        ('<p data-hidden="hidden" title="hidden">s', "s"),
        ("x<template><p>t</p></template>y", "x y"),
        ('<a href="x>go</a> more', "go more"),
        ("x<!-->y<!--a--!>z<!-- never closed", "x y z"),
        ("<!DOCTYPE html><?xml a?>x</ y>z</>", "x z"),
        ("<textarea><b>&amp;</textarea>t", "<b>& t"),
        ("<title>T<b></title>u<title>", "u"),
        ("<script/>a</script >b", "b"),
        ("shown<a href=never", "shown"),
        ("&copy;&copy &notit; &hellip;&CounterClockwiseContourIntegral;", "©&copy &notit; …∳"),
        ("</p></p>x<b><i></b>y</i>", "x y"),
        ("", ""),
        ("<", "<"),
        ("<a", ""),
    ],
)
def test_pages_as_browsers_read_them(spark, page, text):
    assert visible_text(page) == text
    assert one(spark, html_text(F.col("t")), t=page) == text


def test_html_text_of_odd_pages(spark):
    assert one(spark, html_text(F.col("t")), t=None) is None
    assert visible_text("<b>" * 50_000 + "x" + "</b>" * 50_000) == "x"
    assert visible_text("</i>" * 50_000 + "<p hidden>" + "<b>" * 50_000) == ""
    assert visible_text("<a " + "x=1 " * 50_000 + ">y") == "y"
    assert visible_text("<a " + '"' * 50_001) == "" and visible_text("<!--" * 20_000) == ""


def test_founders(spark):
    reply = "Sure.\n Founder 1: Ann Lee, CEO, Chair \nFounder 2: Solo\nFounder 3 no colon\nFounder 4: Bo, CTO: x, y"
    rows = prompts.founders(docs(spark, reply), "id", "t").collect()
    assert [(r.name, r.role) for r in rows] == [("Ann Lee", "CEO, Chair"), ("Bo", "CTO")]


def test_row_prompt(spark):
    df = spark.createDataFrame([(None, 17.0, False, 3)], "a string, b double, c boolean, d int")
    assert df.select(prompts.row_prompt(df).alias("p")).first().p == "b: 17.0, c: False, d: 3"


NUMBERS = [0.0, 1.5, -2.25, 3127000.0, 12345678.9, -98765432.125, 1e15, 1.5e16, 1e22, -1.25e300,
           0.001, 0.0001, 0.00012345, -0.00099, 1.5e-05, 1e-10, 123456789012345.6, 1e7]


def test_plain_number_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in NUMBERS], "x double")
    rows = df.select("x", prompts.plain_number(F.col("x")).alias("s")).collect()
    assert [(r.x, r.s) for r in rows] == [(r.x, repr(r.x)) for r in rows]


def test_request_table_orders_examples(spark):
    examples = spark.createDataFrame([(2, "i2", "o2"), (1, "i1", "o1")], "idx int, input string, output string")
    built = prompts.request_table(docs(spark, "ask"), "t", "do", examples).first().messages
    assert [(m.role, m.content) for m in built] == [
        ("system", "do"), ("user", "i1"), ("assistant", "o1"), ("user", "i2"), ("assistant", "o2"), ("user", "ask"),
    ]


def test_row_prefix_variants(spark):
    table = docs(spark, "a", "b", "c")
    filled = prompts.limited_result(table, "id", 2, "r", F.upper("t"))
    assert [r.r for r in filled.orderBy("id").collect()] == ["A", "B", None]


def test_keyword_files(spark, tmp_path):
    path = tmp_path / "keys.json"
    path.write_text('{"MSP": 5,\n "Managed IT": 10, "msp": 7}')
    assert sorted((r.name, r.weight) for r in read_keywords(spark, str(path)).collect()) == [("managed it", 10.0), ("msp", 7.0)]


@pytest.mark.parametrize("bad", ['{"a": 1.5}', '{"a": "5"}', '{"a": true}', '{"a": null}', "[1]", "{"])
def test_keyword_weights_must_be_integers(spark, bad):
    table = docs(spark, bad)
    with pytest.raises(Exception, match="keyword weights must be integers"):
        parse_keywords(table, "id", "t").collect()
