import zlib

import numpy as np

from leadrank.llm import quality
from leadrank.llm.queries import all_queries


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = {r.doc_id: r for r in all_queries()["op5_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [i for i, r in got.items() if r.held_out and i in labels]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert np.mean([got[i].predicted == labels[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def plain_features(text):
    """The features by the book."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(quality.FEATURES)
    n, words = len(raw), raw.split()
    n_words = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x] or [b""]
    among = lambda low, high: sum(low <= b <= high for b in raw)
    visible = among(33, 126)
    letters, digits = among(65, 90) + among(97, 122), among(48, 57)
    return [
        np.log1p(n),
        sum(len(w) for w in words) / n_words,
        among(65, 90) / n,
        (visible - letters - digits) / n,
        sum(chr(b) in "#$%&*<=>@[\\]^_`{|}~!" for b in raw) / n,
        digits / n,
        sum(b > 127 for b in raw) / n,
        len(set(words)) / n_words,
        sum(a == b for a, b in zip(words, words[1:])) / n_words,
        len(set(lines)) / len(lines),
        n_words / len(lines),
        n_words / max(1, sum(chr(b) in ".?" for b in raw)),
    ]


def test_features_are_those_of_a_plain_version(spark, docs_of, odd_texts):
    texts = [*odd_texts, "A line.\nA line.\n\nWhat? No! 12%", "é" * 50, "word " * 200_000]
    for t in texts:
        assert np.allclose(quality.text_features(t), plain_features(t)), t
    found = {r.doc_id: r.x for r in quality.features(docs_of(list(enumerate(texts)))).collect()}
    assert all(np.allclose(found[i], plain_features(t)) for i, t in enumerate(texts))


def test_scores_are_table_sums():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x, y, rounds=30, pair_rounds=30)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    for row in x[:20]:
        total = model.base + sum(t[np.searchsorted(c, v, side="right")] for c, t, v in zip(model.cuts, model.tables, row))
        for a, b, ca, cb, t in model.pairs:
            total += t[np.searchsorted(ca, row[a], side="right"), np.searchsorted(cb, row[b], side="right")]
        assert abs(1 / (1 + np.exp(-total)) - model.score(row[None])[0]) < 1e-12


def test_odd_rows_and_no_labels(spark, docs_of, odd_texts):
    rows = [(n, t) for n, t in enumerate(odd_texts)] + [(None, "no id"), (4, "a")]
    featured = quality.features(docs_of(rows))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.score(featured, quality.learn(featured, empty)).collect()
    assert len(got) == len(rows) and all(r.score == 0.5 for r in got)
    one = spark.createDataFrame([(n, 1, None) for n in range(1, 9)] + [(9, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.99 for r in quality.score(featured, quality.learn(featured, one)).collect())
    none = quality.features(docs_of([]))
    assert quality.score(none, quality.learn(none, one)).collect() == []
