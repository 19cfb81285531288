"""The pipeline against its rules, stage by stage, on a small table."""

import hashlib
import random

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece

from leadrank.llm import secrets


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    """Good and bad documents, copies, a leaked item and a secret; labels for most."""
    rng = random.Random(1)
    words = ["".join(rng.choices("aeioutrnsl", k=rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(" ".join(rng.choices(words, k=9)).capitalize() + "." for _ in range(n // 9))
    item = " ".join(rng.sample(words, 30))
    good = {i: prose(rng.randint(60, 200)) for i in range(1, 60)}
    bad = {i: " ".join(f"{w.upper()}%%%" for w in rng.choices(words, k=80)) for i in range(100, 140)}
    docs = good | bad
    docs |= {201: good[1], 202: good[2] + " ", 203: good[3].replace("\n", " ").upper()}
    docs |= {210: prose(40) + " " + item + " " + prose(40)}
    docs |= {220: prose(60) + " password = abcdef123456ghi " + prose(30)}
    folder = tmp_path_factory.mktemp("corpus")
    save = lambda name, rows, schema: spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    save("documents", [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(300, None, None, None, None), (301, "", None, None, 0), (None, good[4], "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    save("labels", [(i, int(i < 100), 0) for i in docs if i < 200], "doc_id long, quality int, toxic int")
    save("benchmark", [(1, item), (2, None)], "item_id long, text string")
    return str(folder), docs, bad


def test_run(spark, corpus):
    folder, docs, bad = corpus
    found = corpus_pipeline.run(spark, folder)
    rows = {r.doc_id: r for r in found.collect()}
    # Bad ones, later copies (upper case is the same here only where the model keeps it) and the leak are gone.
    assert not set(rows) & set(bad)
    assert not set(rows) & {201, 202, 203, 210}
    assert set(range(1, 60)) <= set(rows) and 220 in rows
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i in [*range(1, 60), 220]:
        text = secrets.redact([docs[i]], ["assign:%d:%d" % (docs[i].index("password"), docs[i].index("ghi") + 3) if i == 220 else None])[0]
        ids = library.encode(text)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").selectExpr("*", "'x' as id", "'y' as spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus[0])
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name


def test_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_leaks_go_by_text_and_not_by_id(spark, corpus):
    folder, texts, _ = corpus
    rows = [(7, texts[210]), (7, texts[1]), (None, texts[210]), (None, texts[2]), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.decontaminated(spark, docs, folder).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [rows[1], rows[3], rows[4]]))


def kept(stage, spark, rows, folder):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(str, map(tuple, stage(spark, docs, folder).collect())))


def test_near_duplicates_go_by_row_and_not_by_id(spark, corpus):
    folder, texts, _ = corpus
    a, b, c = texts[1], texts[2], texts[5]
    rows = [(1, a), (7, a), (7, b), (9, c), (9, c), (9, c), (None, a), (None, texts[6]), (None, texts[6])]
    left = kept(corpus_pipeline.near_duplicates, spark, rows, folder)
    assert left == sorted(map(str, [(1, a), (7, b), (9, c), (None, texts[6])]))


def test_empty_and_null_texts_are_one_group(spark, corpus):
    left = kept(corpus_pipeline.near_duplicates, spark, [(3, None), (2, ""), (4, " \n"), (5, corpus[1][1])], corpus[0])
    assert left == sorted(map(str, [(2, ""), (5, corpus[1][1])]))


def test_quality_judges_rows_that_share_an_id(spark, corpus):
    folder, texts, bad = corpus
    # Ids without a label, so that the model learns the same.
    more = [(300, texts[9]), (None, texts[7])]
    rows = [(i, texts[i]) for i in texts if i < 200] + more + [(300, texts[110]), (None, texts[111])]
    left = kept(corpus_pipeline.good_quality, spark, rows, folder)
    assert left == sorted(map(str, [(i, texts[i]) for i in range(1, 60)] + more))


def test_secrets_go_from_rows_that_share_an_id(spark, corpus):
    folder, texts, _ = corpus
    one = texts[220]
    cut = secrets.redact([one], ["assign:%d:%d" % (one.index("password"), one.index("ghi") + 3)])[0]
    rows = [(1, one), (1, texts[3]), (None, one), (None, None), (2, one), (2, one)]
    left = kept(corpus_pipeline.without_secrets, spark, rows, folder)
    assert left == sorted(map(str, [(1, cut), (1, texts[3]), (None, cut), (None, None), (2, cut), (2, cut)]))
    assert "abcdef123456ghi" not in "".join(left)


def test_run_against_brute_force(spark, corpus, words_of):
    """The rows of run() from the operators' own brute-force rules, stage by stage."""
    from test_decontaminate import brute as leaks
    from test_simhash import components, print_of

    folder, texts, _ = corpus
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    scored = corpus_pipeline.good_quality(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    good = {str((r.doc_id, r.text)) for r in scored.collect()}
    left = [d for d in docs if str(d) in good]
    left.sort(key=lambda d: (d[0] is None, d[0] or 0))
    linked = components([(k, print_of(t, words_of)) for k, (_, t) in enumerate(left)])
    left = [left[k] for k, component in enumerate(linked) if component == k]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    gone = {k for k, *_ in leaks([(k, t) for k, (_, t) in enumerate(left)], items)}
    left = [d for k, d in enumerate(left) if k not in gone]
    rules = secrets.compiled()
    names = [r[0] for r in rules]
    line = lambda t: ",".join(f"{names[n]}:{a}:{b}" for a, n, b in secrets.spans_of(t, rules))
    left = [(i, secrets.redact([t], [line(t)])[0]) for i, t in left]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, text in left:
        ids = library.encode(text or "")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else "")))
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
