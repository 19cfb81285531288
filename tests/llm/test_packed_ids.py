import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadrank.llm import packed_ids
from leadrank.llm.queries import all_queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.mark.parametrize("bits", range(1, 33))
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003, dtype=np.uint64)
    data = packed_ids.pack(ids, bits)
    assert len(data) == -(-1003 // 8) * bits and (packed_ids.unpack(data, bits, 1003) == ids).all()


def test_bits():
    assert [packed_ids.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_ids_of_random_texts(library):
    rng = random.Random(2)
    parts = ["a", "the", " ", "  ", "\n", "é", "'s", "\0", "😀", "梦", "12", ".", "!!", "\t", "　", "<|endoftext|>", " <|endoftext|> ", "\xa0", ","]
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 3, 20, 90]))) for _ in range(800)]
    got = [np.frombuffer(i, "<u4").tolist() for i in packed_ids.Encoder(FILE).ids(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_small_cache_gives_the_same(library):
    encoder = packed_ids.Encoder(FILE)
    encoder.cache.size = 20
    rng = random.Random(3)
    for _ in range(20):
        texts = [" ".join(rng.choices(["one", "two,", "three.", "four", "\nfive", "six6", "seven!"], k=30)) for _ in range(3)]
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.ids(texts)] == [library.encode(t).ids for t in texts]


def test_round_trip_of_odd_rows(docs_of, odd_texts, library, tmp_path):
    rows = [(7 * n % 13, t) for n, t in enumerate(odd_texts)] + [(3, "again"), (None, "no id")]
    folder = str(tmp_path / "ids")
    manifest = packed_ids.write_packed(docs_of(rows), FILE, folder, file_ids=50)
    assert manifest.count() > 2
    got = sorted(packed_ids.read_packed(manifest, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(i for i, _ in rows if i is not None)]
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    have = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert have == sorted((str(i), [*library.encode(t or "").ids, 0]) for i, t in rows)
    one = manifest.orderBy("partition", "place").first()
    assert packed_ids.read_document(folder, one.file, 0).tolist() == np.frombuffer(got[0].ids, "<u4").tolist()


def test_random_access_across_blocks(tmp_path):
    ids = np.random.default_rng(0).integers(0, 50_257, 30_000).astype(np.uint32)
    ends = [10, 10, 9000, 30_000]
    packed_ids.put(str(tmp_path), "x.bin", packed_ids.file_bytes([1, None, 2, 3], ends, ids, 17))
    file = packed_ids.PackedFile(str(tmp_path), "x.bin")
    assert file.doc_ids == [1, None, 2, 3] and file.starts.tolist() == [0, *ends]
    for a, b in [(0, 10), (10, 10), (8190, 8195), (16_383, 16_385), (0, 30_000), (29_999, 30_000)]:
        assert (file.ids(a, b) == ids[a:b]).all()


def test_empty_table(docs_of, tmp_path):
    manifest = packed_ids.write_packed(docs_of([]), FILE, str(tmp_path))
    assert manifest.count() == 0 and packed_ids.read_packed(manifest, str(tmp_path)).collect() == []


def test_query(spark, sf, library):
    got = {r.doc_id: r for r in all_queries()["op9_packed_ids"](spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*library.encode(r.text, add_special_tokens=False).ids, 0]
        assert tuple(got[r.doc_id])[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
