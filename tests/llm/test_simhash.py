import numpy as np
import pytest
import xxhash

from leadrank.llm import simhash
from leadrank.llm.components import connected_components
from leadrank.llm.queries import all_queries


def print_of(text, words_of, k=3):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words_of(text)]
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=3):
    """Smallest id reachable, for ``[(id, print)]``."""
    p = np.array([x[1] for x in prints], np.uint64)
    label = np.arange(len(p))
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= bits
    while True:
        new = np.where(near, label[None, :], len(p)).min(axis=1)
        new = np.minimum(label, new)
        if (new == label).all():
            break
        label = new
    least = {}
    for (i, _), c in zip(prints, label.tolist()):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [least.get(c) for c in label.tolist()]


def brute(rows, words_of):
    prints = [(i, print_of(t, words_of)) for i, t in rows]
    return sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, components(prints))), key=str)


def test_odd_rows(docs_of, words_of, odd_texts):
    rows = [(n, t) for n, t in enumerate(odd_texts)] + [(3, "other text of one id"), (None, "a"), (None, "lonely words here"), (0, None)]
    found = simhash.near_duplicates(docs_of(rows))
    got = found.select("doc_id", simhash.hexadecimal(found.print), "component").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, words_of)


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == []


@pytest.mark.parametrize("limit", [4096, 30, 6])
def test_links_of_dense_prints(spark, limit):
    rng = np.random.default_rng(5)
    centres = [int(x) for x in rng.integers(0, 2**63, 4)]
    prints = set()
    while len(prints) < 400:
        x = centres[rng.integers(4)]
        for _ in range(rng.integers(0, 11)):
            x ^= 1 << int(rng.integers(64))
        prints.add(x)
    rows = list(enumerate(sorted(prints)))
    df = spark.createDataFrame([(int(np.array(p, np.uint64).view(np.int64)), i) for i, p in rows], "print long, id long")
    found = {r.id: r.component for r in connected_components(simhash.links(df, 3, limit)).collect()}
    assert [found.get(i, i) for i, _ in rows] == components(rows)


def test_pivot_bound():
    rng = np.random.default_rng(1)
    p = rng.integers(0, 2**64, 500, dtype=np.uint64)
    q = p.copy()
    for k in range(3):
        q ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    gap = np.abs(simhash.pivot_table(p) - simhash.pivot_table(q)).max(axis=2).sum(axis=1)
    assert (gap <= np.bitwise_count(p ^ q)).all()


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(200, 320)] + [(7, 7), (201, 100)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in [100, *range(200, 320)]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query(spark, sf, words_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, all_queries()["op4_simhash"](spark, sf).collect()), key=str) == brute(rows, words_of)
