import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadrank.llm import retrieval_packing as packing
from leadrank.llm.chunked_ids import WordLevelEncoder
from leadrank.llm.queries import all_queries

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def check_pieces(rows, docs, library, window):
    """Every id of every document lies in one piece, and sequences are full or a power of two."""
    want = Counter()
    for i, text in docs:
        want[str(i), tuple([*library.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[str(r.doc_id), r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.length))
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window or at < window and at & (at - 1) == 0
    have = Counter()
    for (i, n), parts in pieces.items():
        # Copies of a document are told apart by their starts.
        alike = [ids for (j, ids), count in want.items() if j == i and len(ids) == n for _ in range(count)]
        assert sum(p[2] for p in parts) == n * len(alike)
        if len(alike) == 1:
            parts.sort()
            assert [p[0] for p in parts] == np.cumsum([0, *(p[2] for p in parts[:-1])]).tolist()
            assert tuple(x for p in parts for x in p[1]) == alike[0]
        else:
            cells = Counter((s + k, x) for s, ids, _ in parts for k, x in enumerate(ids))
            assert cells == Counter((k, x) for ids in alike for k, x in enumerate(ids))
        have[i, n] += len(alike)
    assert sum(have.values()) == len(docs)


def test_ids_of_random_texts(library):
    rng = random.Random(2)
    parts = ["a", "The", " ", "  ", "\n", "é", "'s", "\0", "😀", "梦", "12", ".", "!!", "\t", "<|endoftext|>", "<|STARTOFTEXT|>", "\xa0", ",", "J̌", "İ", "ẞ", "K"]
    encoder = WordLevelEncoder(FILE)
    for size in (600_000, 30):
        encoder.cache.size = size
        for _ in range(10):
            texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 3, 20, 90]))) for _ in range(80)]
            got = [np.frombuffer(i, "<u4").tolist() for i in encoder.ids(texts)]
            assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("window,shard_items", [(2048, 4096), (64, 4096), (64, 5), (16, 1), (1, 3)])
def test_odd_rows(spark, docs_of, odd_texts, library, window, shard_items):
    docs = [(k % 9, t) for k, t in enumerate(odd_texts)] + [(None, "no id"), (None, None), (3, "again"), (3, "again")]
    rows = packing.pack(docs_of(docs), FILE, window=window, shard_items=shard_items).collect()
    check_pieces(rows, docs, library, window)


def test_very_long_text_and_small_shards(spark, docs_of, library):
    docs = [(1, "one two three " * 60_000), (2, "four"), (3, "five six " * 1024), (4, ""), (5, "x" * 100_000)]
    for shard_ids in (1, 4_000_000):
        check_pieces(packing.pack(docs_of(docs), FILE, shard_ids=shard_ids).collect(), docs, library, 2048)


def test_empty_table(spark, docs_of):
    assert packing.pack(docs_of([]), FILE).collect() == []


def test_scores_are_bm25():
    rng = random.Random(4)
    items = [np.array([rng.randrange(30) for _ in range(rng.randint(1, 40))], np.uint16) for _ in range(60)]
    df = np.array([sum(t in set(x.tolist()) for x in items) for t in range(31)])
    mean = sum(map(len, items)) / 60
    index = packing.Index(items, packing.Statistics(df, 60, sum(map(len, items))))
    for seed in (0, 17, 59):
        got = index.scores(seed)
        for k, x in enumerate(items):
            tf, score = Counter(x.tolist()), 0.0
            for t in set(items[seed].tolist()):
                idf = math.log(1 + (60 - df[t] + 0.5) / (df[t] + 0.5))
                if tf[t]:
                    score += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (1 - 0.75 + 0.75 * len(x) / mean))
            assert math.isclose(got[k], score, abs_tol=1e-9)
    # Without the used ones, the others score the same.
    unused, before = np.array([k % 3 > 0 for k in range(60)]), index.scores(20)
    index.keep(unused)
    assert np.allclose(index.scores(20), np.where(unused, before, 0))


def test_windows_take_the_best_neighbours():
    """Items of one topic share windows; a whole item goes before a cut one."""
    rng = random.Random(5)
    items = [np.array([100 * (k % 4) + rng.randrange(60) for _ in range(50)]) for k in range(40)]
    df = np.bincount(np.concatenate([np.unique(x) for x in items]), minlength=400)
    windows = packing.fill(items, packing.Statistics(df, 40, 2000), window=200)
    assert len(windows) == 10
    for pieces in windows:
        assert sum(p[2] for p in pieces) == 200
    topics = [{i % 4 for i, _, _ in pieces} for pieces in windows]
    assert sum(len(t) == 1 for t in topics) >= 8


def test_a_cut_item_is_used_again():
    items = [np.zeros(6, int), np.zeros(7, int), np.zeros(9, int)]
    windows = packing.fill(items, packing.Statistics(np.array([3]), 3, 22), window=10)
    assert [sum(p[2] for p in w) for w in windows] == [10, 10, 2]
    cells = sorted((i, k) for w in windows for i, a, n in w for k in range(a, a + n))
    assert cells == [(i, k) for i, x in enumerate(items) for k in range(len(x))]


@pytest.mark.parametrize("total", [1, 2, 3, 7, 8, 100, 2047])
def test_powers(total):
    runs = packing.powers([(0, 5, total // 2), (1, 0, total - total // 2)] if total > 1 else [(0, 5, 1)])
    sizes = [sum(p[2] for p in run) for run in runs]
    assert sum(sizes) == total and all(s & (s - 1) == 0 for s in sizes) and len(set(sizes)) == len(sizes)


def test_query(spark, sf, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs}
    rows = all_queries()["op12_packing"](spark, sf).collect()
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert (r.length, r.doc_tokens, r.ids_crc32) == (len(own), len(ids[r.doc_id]), zlib.crc32(np.array(own, "<u4").tobytes()))
        seen[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, own in ids.items():
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == len(own)
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
        short += at < 2048
    assert short < len(sequences) / 2
