import hashlib
import math
import random
import re
import zlib

import pytest

from leadrank.llm import importance
from leadrank.llm.queries import all_queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute_force(docs, target, percent=5, min_words=20):
    s, t = [0] * 10000, [0] * 10000
    of = [buckets(text) for _, text in docs]
    for _, found in of:
        for b in found:
            s[b] += 1
    for text in target:
        for b in buckets(text)[1]:
            t[b] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (words, found) in zip(docs, of):
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(docs_of, spark, docs, target, **how):
    made = importance.resample(docs_of(docs), spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string"), **how)
    assert made.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in made.collect()), key=repr)


def texts(rng, n):
    vocabulary = ["the", "Of", "Zebra", "naïve", "x1", "日本", "a", "end-of", "KELVINK", "don't"]
    return [" ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 21, 60]))) for _ in range(n)]


def test_random_texts(spark, docs_of):
    rng = random.Random(1)
    docs = list(enumerate(texts(rng, 200)))
    target = texts(rng, 10)
    assert found(docs_of, spark, docs, target) == brute_force(docs, target)
    assert found(docs_of, spark, docs, target, percent=50, min_words=5) == brute_force(docs, target, 50, 5)


def test_odd_rows(spark, docs_of, odd_texts):
    docs = [(k % 7, t) for k, t in enumerate(odd_texts)] + [(None, "w " * 30), (None, "w " * 30), (3, "w " * 30), (3, "w " * 30)]
    docs += [(50, " ".join(["y" * 64, "z" * 65, "q", "r" * 300, "s" * 63] * 5)), (51, "\x00\x00a\x00B\x7f c{d}`e")]
    for target in ([], [None, "", "w w w"]):
        assert found(docs_of, spark, docs, target, percent=60, min_words=3) == brute_force(docs, target, 60, 3)


def test_very_long_text(spark, docs_of):
    rng = random.Random(2)
    docs = [(1, " ".join(rng.choices(["ab", "cd", "ef", "g"], k=300_000))), (2, "ab cd " * 20), (3, "v" * 1_000_000 + " " + "u" * 100 + " t")]
    assert found(docs_of, spark, docs, ["ab cd"], percent=100) == brute_force(docs, ["ab cd"], 100)


def test_all_rows_tie(spark, docs_of):
    docs = [(9, "one two three " * 10)] * 400 + [(8, "short")]
    got = found(docs_of, spark, docs, ["one two"])
    assert got == brute_force(docs, ["one two"]) and sorted(r[4] for r in got if r[4]) == list(range(1, 21))


def test_empty_table(spark, docs_of):
    assert found(docs_of, spark, [], ["one"]) == []


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_slices_lose_no_run(monkeypatch, size):
    rng = random.Random(size)
    some = texts(rng, 12) + [None, "", "z" * 70 + " a b " + "y" * 90]
    monkeypatch.setattr(importance, "SLICE", size)
    got = [[] for _ in some]
    words = [0] * len(some)
    for word_of, of, numbers in importance.features(some):
        for k in word_of.tolist():
            words[k] += 1
        for k, b in zip(of.tolist(), numbers.tolist()):
            got[k].append(b)
    for text, n, have in zip(some, words, got):
        assert (n, sorted(have)) == (buckets(text)[0], sorted(buckets(text)[1]))


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = all_queries()["op13_resampling"](spark, sf)
    assert dict(got.dtypes) == {c: "bigint" for c in ["doc_id", "n_features", "weight", "score", "rank"]}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(docs, target)
