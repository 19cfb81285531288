import zlib

import numpy as np

from leadrank.llm import language
from leadrank.llm.queries import all_queries


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = {r.doc_id: r for r in all_queries()["op10_language"](spark, sf).collect()}
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got.keys() == true.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert np.mean([got[i].lang_pred == true[i] for i in got if got[i].held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def places(text):
    """Places of a text's n-grams, one by one."""
    codes = [ord(c) if c.isalpha() else 32 for c in (text or "").lower()]
    out = set()
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            g = 1
            for k, c in enumerate(codes[i : i + n]):
                g = ((g * 0x01000193 if k else 0) + c + (k == 0)) % 2**32
            out.add(((g * 0x9E3779B1) % 2**32) >> 18)
    return out


def test_presence_and_kernel(odd_texts):
    seen, has_letter = language.presence(odd_texts)
    assert [set(np.flatnonzero(row)) for row in seen] == [places(t) for t in odd_texts]
    assert has_letter.tolist() == [any(c.isalpha() for c in t or "") for t in odd_texts]
    texts = ["the cat", "le chat", "the hat", "la chatte"]
    seen, _ = language.presence(texts)
    model = language.fit(seen, ["en", "fr", "en", "fr"])
    want = [[len(places(a) & places(b)) / np.sqrt(len(places(a)) * len(places(b))) for b in (texts[0], texts[2], texts[1], texts[3])] for a in texts]
    assert np.allclose(model.kernel(seen), want, atol=1e-5)


def test_odd_rows(docs_of, odd_texts):
    train = docs_of([(n, "the cat and the hat") for n in range(1, 30)] + [(None, "the")], lang="en")
    model = language.learn(train)
    rows = [(n, t) for n, t in enumerate(odd_texts)] + [(None, "the"), (4, "a")]
    got = language.predict(docs_of(rows), model).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.lang_pred) for r in got if r.doc_id is not None) == sorted(
        (False, i, "en" if any(c.isalpha() for c in t or "") else "und") for i, t in rows if i is not None
    )
    assert all(r.score == 0 for r in got if r.lang_pred == "und")


def test_nothing_to_learn_from(docs_of):
    for train in (docs_of([]), docs_of([(1, "the")]), docs_of([(1, None)], lang="en")):
        got = language.predict(docs_of([(1, "the"), (2, None)]), language.learn(train)).collect()
        assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert language.predict(docs_of([]), language.learn(docs_of([(1, "the")], lang="en"))).collect() == []
