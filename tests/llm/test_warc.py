import base64
import hashlib
import io

import pytest
import zstandard

from leadrank.llm import warc
from leadrank.llm.queries import all_queries
from leadrank.llm.shared import read_range


def want(rows, least=0):
    """Full payload figures, type and target of every page."""
    last = {}
    for i, _, html in rows:
        body = (html or "").encode("utf-8", "surrogatepass")
        if i is not None and len(body) >= least:
            last[body] = max(last.get(body, i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode("utf-8", "surrogatepass")
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        to = last.get(body)
        out.append((i, len(body), sha, "response" if to in (None, i) else "revisit", None if to in (None, i) else to))
    return sorted(out, key=str)


def pages(spark, rows):
    schema = "page_id long, url string, html string, key string, body string, sha string, size int, n int, last int"
    return spark.createDataFrame([(*r, "x", "x", "x", 1, 1, 1) for r in rows], schema)


def got(read):
    return sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect()), key=str)


ROWS = [
    (1, "http://a.example/", "<p>one</p>"),
    (2, "http://b.example/ x\r\ny", "<p>one</p>"),
    (3, None, None),
    (4, "u", ""),
    (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n é 😀"),
    (6, "u", "long " * 400_000),
    (7, "u", "long " * 400_000),
    (7, "u", "long " * 400_000),
    (8, "u", "alone"),
    (None, "u", "<p>one</p>"),
    (None, "u", "only without id"),
    *[(100 + n, "u", "copy") for n in range(40)],
]


@pytest.mark.parametrize("least", [0, 5, 11])
def test_round_trip(spark, tmp_path, least):
    folder = str(tmp_path / "warc")
    index = warc.write(pages(spark, ROWS), folder, min_bytes=least)
    assert got(warc.read(index, folder)) == want(ROWS, least)


def test_index_and_plain_readers(spark, tmp_path):
    folder = str(tmp_path / "warc")
    index = warc.write(pages(spark, [r for r in ROWS if r[0] is not None]), folder)
    html = {i: h or "" for i, _, h in ROWS}
    for e in index.collect():
        head, payload = warc.read_record(folder, e.bundle, e.frame, e.offset)
        assert head["WARC-Record-ID"] == e.record == warc.record_id(e.key)
        assert payload == (html[e.key].encode() if head["WARC-Type"] == "response" else b"")
    for name in {e.bundle for e in index.collect()}:
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(read_range(folder, name)), read_across_frames=True).read()
        table = warc.seek_table(folder, name)
        assert whole == b"".join(warc.read_frame(folder, name, f) for f in table)
        assert whole.startswith(b"WARC/1.1\r\n") and sum(f[2] for f in table) == len(whole)


def test_frames_are_read_back_by_many_tasks(spark, tmp_path, monkeypatch):
    """Tasks in proportion to frames, and no payload in a shuffle."""
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    folder = str(tmp_path / "warc")
    index = warc.write(pages(spark, [(i, "u", f"{i} " * 800) for i in range(60)]), folder)
    frames = index.select("bundle", "frame").distinct().count()
    read = warc.read(index, folder)
    assert frames >= 60 and read.rdd.getNumPartitions() == min(frames, 2 * spark.sparkContext.defaultParallelism)
    assert sorted(r.key for r in read.collect()) == list(range(60))
    monkeypatch.setattr(warc, "FRAMES_A_TASK", 2)
    assert warc.read(index, folder).rdd.getNumPartitions() == -(-frames // 2)


def test_empty_table(spark, tmp_path):
    index = warc.write(pages(spark, []), str(tmp_path))
    assert index.count() == 0 and warc.read(index, str(tmp_path)).collect() == []


def test_query(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, all_queries()["op2_warc"](spark, sf).collect()), key=str) == want(rows)
