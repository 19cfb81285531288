import hashlib
import random

import numpy as np
import pytest

from leadrank.llm import substrings
from leadrank.llm.fm_index import FMIndex
from leadrank.llm.queries import all_queries


def brute(rows, words_of, window=50):
    first = {}
    split = [(i, words_of(t)) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[s : s + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(3)
    held = [[rng.choice("abcdefgh") for _ in range(rng.randint(5, 40))] for _ in range(12)]
    rows = []
    for _ in range(120):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(held)[rng.randint(0, 4) :] if rng.random() < 0.7 else [rng.choice("abcxyz") for _ in range(rng.randint(1, 9))]
        rows.append((rng.choice([None, *range(60)]), rng.choice([" ", "\n", " \t"]).join(w)))
    return rows


@pytest.mark.parametrize("more", [{}, {"hot": 4, "shard_words": 200}])
def test_passages(docs_of, odd_texts, words_of, passages, more):
    rows = passages + [(200 + n, t) for n, t in enumerate(odd_texts)] + [(300, odd_texts[6]), (200, "a " * 90), (301, "a " * 80)]
    assert got(substrings.remove_repeats(docs_of(rows), window=8, gram=3, **more)) == brute(rows, words_of, 8)


def test_kept_text(docs_of):
    shared = " ".join(f"w{k}" for k in range(60))
    found = {r.doc_id: r for r in substrings.remove_repeats(docs_of([(1, shared), (2, f"before {shared} behind"), (3, "short")])).collect()}
    assert (found[2].kept, found[2].n_removed, found[1].kept, found[3].n_removed) == ("before behind", 60, None, 0)


def test_nothing_goes_but_what_an_index_reports(docs_of, passages, monkeypatch):
    """Without the index's marks all words stay, equal passages and hot anchors included."""
    monkeypatch.setattr(FMIndex, "earlier", lambda self, asked, owners, length: [np.zeros(max(0, int(self.sizes[i]) - length + 1), bool) for i in asked])
    same = " ".join(f"w{k}" for k in range(70))
    rows = passages + [(900 + k, same) for k in range(10)]
    for more in ({}, {"hot": 4}):
        found = substrings.remove_repeats(docs_of(rows), window=8, gram=3, **more)
        assert {r.n_removed for r in found.collect()} == {0}


def test_rows_that_share_an_id_are_judged_for_themselves(docs_of, words_of):
    rng = random.Random(9)
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(5, f"own{k} " * 3 + " ".join(rng.choices("abcdef", k=70))) for k in range(40)]
    rows += [(5, shared), (5, shared), (5, f"x {shared}"), (4, f"{shared} y"), (5, rows[3][1]), (None, shared), (6, rows[3][1])]
    assert got(substrings.remove_repeats(docs_of(rows))) == brute(rows, words_of)


def test_empty_table(docs_of):
    assert substrings.remove_repeats(docs_of([])).collect() == []


def test_index_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        length, count = int(rng.integers(2, 8)), int(rng.integers(1, 30))
        base = rng.integers(0, 5, 40).astype(np.uint64)
        segments = []
        for _ in range(count):
            a = int(rng.integers(0, 15))
            x = base[a : a + int(rng.integers(length, 25))].copy()
            x[rng.integers(len(x))] = rng.integers(0, 5)
            segments.append(x)
        owners = rng.integers(0, 8, count)
        first = {}
        for x, o in zip(segments, owners):
            for i in range(len(x) - length + 1):
                first[tuple(x[i : i + length])] = min(first.get(tuple(x[i : i + length]), 99), o)
        marks = FMIndex(segments, owners).earlier(np.arange(count), owners, length)
        assert [m.tolist() for m in marks] == [
            [first[tuple(x[i : i + length])] < o for i in range(len(x) - length + 1)] for x, o in zip(segments, owners)
        ]


def test_query(spark, sf, words_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(all_queries()["op7_substrings"](spark, sf)) == brute(rows, words_of)
