"""Removal of repeated passages, by an FM-index per shard.

A window is 50 consecutive words of one document; a word goes if some window
over it also starts in a document with a smaller id. Steps:

1. Every window has an anchor, the 12 words in it with the smallest hash. Equal
   windows have equal anchors. A pass over the texts gives the distinct anchor
   hashes of each document; those of one document only are out.
2. A second pass cuts, in documents with shared anchors, each run of windows on
   one anchor into a segment (all words of those windows) and keeps its digest.
   Equal segments are one, counted map-side first, so that a passage in very
   many documents becomes one segment with its smallest document.
3. Segments that more than one document holds, and all those of an anchor that
   has several, go to a shard by anchor. Each shard builds an FM-index of its
   segments and streams them through it by backward search on a wavelet matrix;
   windows whose matching statistics reach 50 words in a smaller document are
   reported: once for the smallest document of a segment, and once for all
   documents behind it, for which the segment's own document is a smaller one.
   Nothing is removed but what an index reports.
4. Windows found are brought to their documents and the words they cover go.

Anchors in more than ``hot`` documents are cut window by window, and each window is
an anchor of its own, so no shard ever holds a hot anchor. Windows are judged on
the input.

Rows are known by a 128-bit digest of id and text, so rows that share an id are
judged each for itself, and equal rows alike. Very long texts are worked on whole,
one at a time.

Words are compared by 64-bit hashes; taking two different windows for one needs
such a collision at every place where they differ.

Null and empty texts have no words. Rows with a null id are kept whole and take
no part. Rows that share an id are one document, and each is judged for itself
against smaller ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadrank.llm.fm_index import DEPTH, FMIndex
from leadrank.llm.shared import batch, groups_of, stored

WINDOW, GRAM = 50, 12
#: Documents of an anchor above which its windows are keyed one by one.
HOT = 2_000
#: Words in a shard, on average.
SHARD_WORDS = 250_000
ODD = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def rolled(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` values in a row."""
    m = max(0, len(h) - length + 1)
    out = np.zeros(m, np.uint64)
    for j in range(length):
        out = out * np.uint64(ODD) + h[j : j + m]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Windows:
    """Windows of a group of texts, laid end to end.

    ``valid``: starts of windows within one text; ``anchor``: where the anchor
    of each lies; ``key``: its hash.
    """

    def __init__(self, texts: list[str | None], window: int, gram: int) -> None:
        from xxhash import xxh64_intdigest

        split = [words_of(t) for t in texts]
        self.sizes = np.array([len(w) for w in split], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        n = int(self.sizes.sum())
        self.hashes = np.fromiter((xxh64_intdigest(w) for words in split for w in words), np.uint64, n)
        self.row = np.repeat(np.arange(len(texts)), self.sizes)
        m = max(0, n - window + 1)
        self.valid = np.flatnonzero(self.row[:m] == self.row[window - 1 :]) if m else np.empty(0, np.int64)
        value = rolled(self.hashes, gram)
        at = np.arange(len(value))
        span, width = window - gram + 1, 1
        while m and 2 * width <= span:
            value, at = self._smaller(value, at, width)
            width *= 2
        if m and width < span:
            value, at = self._smaller(value, at, span - width)
        self.anchor, self.key = at[self.valid], value[self.valid].view(np.int64)

    @staticmethod
    def _smaller(value: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        left = value[:-step] <= value[step:]
        return np.where(left, value[:-step], value[step:]), np.where(left, at[:-step], at[step:])


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``(key, id, uid)``: the distinct anchor hashes of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column(1).to_pylist()
            for a, b in groups_of(texts):
                w = Windows(texts[a:b], window, gram)
                if not len(w.key):
                    continue
                row = w.row[w.valid]
                order = np.lexsort((w.key, row))
                key, row = w.key[order], row[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
                at = pa.array(a + row[new])
                yield pa.RecordBatch.from_arrays([pa.array(key[new]), rows.column(0).take(at), rows.column(2).take(at)], names=["key", "id", "uid"])

    return docs.where("id is not null").select("id", "text", "uid").mapInArrow(run, "key bigint, id bigint, uid binary")


PARTS = (
    "id bigint, uid binary, n_words bigint, kept_sha256 string, text string, "
    "segments array<struct<key: bigint, digest: binary, start: int, n: int>>"
)


def _segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows ``(id, text, keys, hot)`` as finished rows, or with their text and segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from xxhash import xxh3_128_digest

        segment = pa.struct([("key", pa.int64()), ("digest", pa.binary()), ("start", pa.int32()), ("n", pa.int32())])
        schema = pa.schema(
            [("id", pa.int64()), ("uid", pa.binary()), ("n_words", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string()), ("segments", pa.list_(segment))]
        )
        for rows in batches:
            ids, texts, uids, keys, hot = (c.to_pylist() for c in rows.columns)
            for a, b in groups_of(texts):
                some = [i for i in range(a, b) if keys[i] or hot[i]]
                w = Windows([texts[i] for i in some], window, gram)
                full = rolled(w.hashes, window).view(np.int64)
                of_row = np.searchsorted(w.row[w.valid], np.arange(len(some) + 1)) if len(some) else np.zeros(1, np.int64)
                found: dict[int, list[dict]] = {}
                for k, i in enumerate(some):
                    key, anchor = w.key[of_row[k] : of_row[k + 1]], w.anchor[of_row[k] : of_row[k + 1]]
                    first = int(w.starts[k])
                    known = np.isin(key, np.array(keys[i] or [], np.int64))
                    alone = np.isin(key, np.array(hot[i] or [], np.int64))
                    cut = np.ones(len(key), bool)
                    cut[1:] = (anchor[1:] != anchor[:-1]) | alone[1:]
                    begins = np.flatnonzero(cut)
                    ends = np.append(begins[1:], len(key))
                    take = known[begins] | alone[begins]
                    out = []
                    for s, e in zip(begins[take].tolist(), ends[take].tolist(), strict=True):
                        piece = w.hashes[first + s : first + e + window - 1]
                        own = int(full[first + s]) if alone[s] else int(key[s])
                        out.append({"key": own, "digest": xxh3_128_digest(piece.tobytes()), "start": s, "n": e - s})
                    found[i] = out
                out_rows: dict[str, list] = {f.name: [] for f in schema}
                for i in range(a, b):
                    words = words_of(texts[i])
                    pending = bool(found.get(i))
                    kept = None if pending else hashlib.sha256(b" ".join(words)).hexdigest()
                    row = (ids[i], uids[i], len(words), kept, texts[i] if pending else None, found.get(i, []))
                    for name, value in zip(out_rows, row, strict=True):
                        out_rows[name].append(value)
                yield batch(out_rows, schema)

    return docs.select("id", "text", "uid", "keys", "hot").mapInArrow(run, PARTS)


def _firsts(pending: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words of the first copies: ``(shard, key, owner, again, digest, words)``."""
    asked = wanted.groupBy("uid").agg(F.collect_list(F.struct("shard", "key", "owner", "again", "digest", "start", "length")).alias("parts"))
    # Rows that are equal share a uid; one of them is enough.
    texts = pending.select("uid", "text").join(asked, "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        schema = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("owner", pa.int64()), ("again", pa.bool_()), ("digest", pa.binary()), ("words", pa.binary())])
        for rows in batches:
            texts = rows.column(0).to_pylist()
            for a, b in groups_of(texts):
                out: dict[str, list] = {f.name: [] for f in schema}
                for text, parts in zip(texts[a:b], rows.column(1).slice(a, b - a).to_pylist(), strict=True):
                    words = words_of(text)
                    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
                    for p in parts:
                        for name in ("shard", "key", "owner", "again", "digest"):
                            out[name].append(p[name])
                        out["words"].append(h[p["start"] : p["start"] + p["length"]].tobytes())
                yield batch(out, schema)

    return texts.select("text", "parts").mapInArrow(run, "shard int, key bigint, owner bigint, again boolean, digest binary, words binary")


def _searched(firsts: DataFrame, shards: int, window: int) -> DataFrame:
    """``(key, digest, marks, later)``: a byte per window of a segment that says whether a smaller id has it.

    ``marks`` holds for the segment's smallest document, ``later`` for those behind it.
    """
    schema = pa.schema([("key", pa.int64()), ("digest", pa.binary()), ("marks", pa.binary()), ("later", pa.binary())])

    def shard(segments: list[tuple[int, int, bool, bytes, np.ndarray]]) -> pa.RecordBatch | None:
        keys, owners, again = (np.array([s[k] for s in segments]) for k in range(3))
        # The smallest owner of an anchor has none before it.
        order = np.lexsort((owners, keys))
        lead = np.ones(len(order), bool)
        lead[1:] = keys[order][1:] != keys[order][:-1]
        least = np.empty(len(order), np.int64)
        least[order] = owners[order][np.flatnonzero(lead)[np.cumsum(lead) - 1]]
        first, later = np.flatnonzero(owners > least), np.flatnonzero(again)
        asked = np.concatenate([first, later])
        if not len(asked):
            return None
        index = FMIndex([s[4] for s in segments], owners)
        # Whoever comes behind the owner has an id of at least one more.
        marks = index.earlier(asked, np.concatenate([owners[first], owners[later] + 1]), window)
        found: dict[int, list[bytes | None]] = {}
        for k, (i, m) in enumerate(zip(asked.tolist(), marks, strict=True)):
            if m.any():
                found.setdefault(i, [None, None])[int(k >= len(first))] = m.astype(np.uint8).tobytes()
        columns = {"key": [segments[i][0] for i in found], "digest": [segments[i][3] for i in found], "marks": [m[0] for m in found.values()], "later": [m[1] for m in found.values()]}
        return batch(columns, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for rows in batches:
            for number, key, owner, again, digest, words in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if number != now:
                    if held and (out := shard(held)) is not None:
                        yield out
                    now, held = number, []
                held.append((key, owner, again, digest, np.frombuffer(words, np.uint64)))
        if held and (out := shard(held)) is not None:
            yield out

    spread = firsts.repartition(shards, "shard").sortWithinPartitions("shard")
    return spread.mapInArrow(run, "key bigint, digest binary, marks binary, later binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256, kept)`` of every row.

    ``kept`` is the text of the words left, joined by spaces, where words went,
    and null where the text stays.
    """
    if 2 * window - gram > DEPTH:
        raise ValueError("windows are longer than the index is deep")
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("uid", F.unhex(F.md5(F.concat_ws(" ", F.col("id").cast("string"), "text").cast("binary"))))
    # A null id gets no anchors, so it joins nothing below.
    pairs = stored(_anchors(rows, window, gram), "repeat-anchors")
    shared = pairs.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("a < b").select("key", (F.col("n") > hot).alias("is_hot"))
    by_row = pairs.join(shared, "key").groupBy("uid").agg(
        F.collect_set(F.when(~F.col("is_hot"), F.col("key"))).alias("keys"),
        F.collect_set(F.when(F.col("is_hot"), F.col("key"))).alias("hot"),
    )
    parts = stored(_segments(rows.join(by_row, "uid", "left"), window, gram), "repeat-parts")
    pending = parts.where("text is not null")
    copies = pending.select("id", "uid", F.explode("segments").alias("s")).select("id", "uid", "s.*")
    firsts = copies.groupBy("key", "digest").agg(F.min(F.struct("id", "uid", "start")).alias("first"), F.max("n").alias("n"), F.max("id").alias("last"))
    firsts = stored(firsts.select("key", "digest", "first.*", "n", "last"), "repeat-firsts")
    several = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("key").alias("_key"))
    wanted = firsts.join(several, F.col("key") == F.col("_key"), "left").where("last > id or _key is not null")
    wanted = wanted.withColumn("length", F.col("n") + F.lit(window - 1))
    total = wanted.agg(F.sum("length")).first()[0] or 0
    shards = max(1, int(total // shard_words) + 1)
    wanted = wanted.select(
        F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", F.col("id").alias("owner"), (F.col("last") > F.col("id")).alias("again"), "digest", "uid", "start", "length"
    )
    # Rows that are equal bring the same segment.
    told = _searched(_firsts(pending, wanted), shards, window).dropDuplicates(["key", "digest"])
    told = told.join(firsts.select("key", "digest", F.col("id").alias("first")), ["key", "digest"])
    gone = copies.join(told, ["key", "digest"]).select("uid", "start", F.when(F.col("id") == F.col("first"), F.col("marks")).otherwise(F.col("later")).alias("marks"))
    gone = gone.where("marks is not null").groupBy("uid").agg(F.collect_set(F.struct("start", "marks")).alias("gone"))
    left = pending.select("id", "uid", "text").join(gone, "uid", "left").select("id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])
        for batch_ in batches:
            texts = batch_.column(1).to_pylist()
            for a, b in groups_of(texts):
                out: dict[str, list] = {f.name: [] for f in schema}
                part = batch_.slice(a, b - a)
                for id_, text_, spans in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = words_of(text_)
                    change = np.zeros(len(words) + window + 1, np.int64)
                    for s in spans or []:
                        at = s["start"] + np.flatnonzero(np.frombuffer(s["marks"], np.uint8))
                        np.add.at(change, at, 1)
                        np.add.at(change, at + window, -1)
                    stay = np.cumsum(change)[: len(words)] == 0
                    kept = b" ".join([w for w, k in zip(words, stay.tolist(), strict=True) if k])
                    removed = len(words) - int(stay.sum())
                    row = (id_, len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if removed else None)
                    for name, value in zip(out, row, strict=True):
                        out[name].append(value)
                yield batch(out, schema)

    done = parts.where("text is null").select("id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept"))
    judged = left.mapInArrow(run, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return done.unionAll(judged).withColumnRenamed("id", key)
