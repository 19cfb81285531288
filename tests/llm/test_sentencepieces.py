import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from leadrank.llm import sentencepieces
from leadrank.llm.queries import all_queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return sentencepieces.Encoder(MODEL)


def test_ids_of_random_texts(encoder, library):
    rng = random.Random(4)
    parts = ["a", "e", "th", "the", " ", "  ", "\n", "é", "ß", "▁", "▁▁", "\0", "😀", "梦", "x", "ing", ".", "!!", "\t", "ñ"]
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 3, 20, 90]))) for _ in range(800)]
    got = [np.frombuffer(i, np.int32).tolist() for i in encoder.ids(texts)]
    assert got == library.encode(texts)


def test_matrix_and_heap_agree(encoder, library):
    words = ["▁" + "".join(random.Random(n).choices("abcdeéñ梦ing", k=n % 46 + 1)) for n in range(400)]
    assert encoder.pairs.encode(words) == [encoder.pairs.by_heap(w) for w in words]
    long = "ab" * 40_000
    assert encoder.pairs.by_heap("▁" + long) == library.encode(long)


def test_a_difference_is_an_error(encoder, monkeypatch):
    monkeypatch.setattr(encoder.pairs, "encode", lambda chunks: [[5] for _ in chunks])
    with pytest.raises(ValueError, match="library"):
        list(encoder.ids(["neverseenbefore"]))


def test_odd_rows(docs_of, odd_texts, library):
    rows = [(n, t) for n, t in enumerate(odd_texts)] + [(4, "a"), (None, "a")]
    found = sentencepieces.encode_decode(docs_of(rows), MODEL)
    assert set(found.columns) >= {"doc_id", "key", "spans", "ids", "decoded"}
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in found.collect()), key=str)
    assert got == sorted(((i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows), key=str)
    assert sentencepieces.encode_decode(docs_of([]), MODEL).collect() == []


def test_query(spark, sf, library):
    got = {r.doc_id: tuple(r)[1:] for r in all_queries()["op8_sentencepiece"](spark, sf).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text)
        assert got[r.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
