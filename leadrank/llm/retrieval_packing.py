"""Packing of documents into sequences, neighbours found by lexical retrieval.

A document is its token ids and an end id. Whole windows of long documents are
sequences by themselves; what is left of each document is an item. Items are
dealt to shards, and each shard has an inverted index with BM25 weights over
token ids. The first unused item of a shard is the seed of a window; the index
returns its neighbours by score, and those that are unused fill the window
greedily, each whole as long as one fits. The best neighbour left is then cut, so
that the window is full, and its rest stays in the shard as an unused item. Only
the last window of a shard may be short: it is cut into runs whose lengths are
powers of two, which need no padding.

Document frequencies, the mean length and the number of items are those of all
documents; there is one number per id of the vocabulary, so they are bounded.
Shards hold items that lie near each other: a range shuffle orders items by their
two rarest terms, then by a row number, so that neither a very common term nor a
group of copies meets in one task. Rarest means last in the vocabulary, which lists
its pieces as they were merged, commonest first; that is known before any count is.
What is shuffled are ids at two bytes each where the vocabulary allows it. Every
item is a possible neighbour of every other of its shard; a shard is closed at
``SHARD_ITEMS`` items or ``SHARD_IDS`` ids.

A null text is empty and holds the end id alone. Repeated and null document ids
are documents of their own. An empty table gives no pieces. A very long document
is one row of ids. Ties in scores go to the item that comes first in the shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leadrank.llm.chunked_ids import GROUP, WordLevelEncoder, ragged, tokenizer_of
from leadrank.llm.shared import groups_of, once, stored

WINDOW, END_ID = 2048, 1
SHARD_ITEMS, SHARD_IDS = 1024, 4_000_000
#: The usual parameters of BM25.
K1, B = 1.2, 0.75
#: Numbers of items and of their ids, beside the terms' own counts.
ITEMS, LENGTH = -1, -2

ENCODED = "doc_id bigint, ids binary, lead int, second int, terms array<struct<term int, n bigint>>"
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def item_of(ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """What is left of a document behind its whole windows."""
    return ids[len(ids) // window * window :]


def vocabulary_of(tokenizer_file: str, end_id: int) -> int:
    return max(tokenizer_of(tokenizer_file).get_vocab_size(with_added_tokens=True), end_id + 1)


def kind_of(vocabulary: int) -> str:
    """The narrowest numbers that hold all ids."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encode(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Ids of every document, and one row per task with the counts of its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(f"word ids {tokenizer_file}", lambda: WordLevelEncoder(tokenizer_file))
        vocabulary = max(encoder.vocabulary, end_id + 1)
        kind = np.dtype(kind_of(vocabulary))
        counts, items, length = np.zeros(vocabulary, np.int64), 0, 0
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("lead", pa.int32()), ("second", pa.int32()), ("terms", pa.list_(pa.struct([("term", pa.int32()), ("n", pa.int64())])))])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups_of(texts, GROUP):
                ids, sizes = encoder.flat(texts[a:b])
                out, lead, second = [], [], []
                for own in np.split(ids.astype(kind), np.cumsum(sizes)[:-1]):
                    own = np.append(own, kind.type(end_id))
                    out.append(own.tobytes())
                    left = item_of(own, window)
                    terms = np.unique(left)
                    rarest = [-1, -1, *terms[-2:].tolist()]
                    lead.append(rarest[-1])
                    second.append(rarest[-2])
                    if len(left):
                        counts[terms] += 1
                        items, length = items + 1, length + len(left)
                columns = [batch.column(0).slice(a, b - a), pa.array(out, pa.binary()), pa.array(lead, pa.int32()), pa.array(second, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(b - a, schema.field("terms").type)], schema=schema)
        held = np.flatnonzero(counts)
        terms = [{"term": ITEMS, "n": items}, {"term": LENGTH, "n": length}] + [{"term": t, "n": n} for t, n in zip(held.tolist(), counts[held].tolist(), strict=True)]
        yield pa.RecordBatch.from_pylist([{"terms": terms}], schema=schema)

    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")).mapInArrow(run, ENCODED)
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "packing-ids")


class Statistics:
    """Inverse document frequencies and the mean length, from the counts of all items."""

    def __init__(self, df: np.ndarray, items: int, length: int) -> None:
        self.df, items = df, max(1, items)
        self.mean = max(1.0, length / items)
        self.idf = np.log(1 + (items - df + 0.5) / (df + 0.5))

    def weights(self, terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """BM25 weight of a term that occurs ``tf`` times in an item of that length."""
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths / self.mean))


class Index:
    """Inverted index of one shard: items and weights by term."""

    def __init__(self, items: list[np.ndarray], statistics: Statistics) -> None:
        lengths = np.array([len(x) for x in items], np.int64)
        size = len(statistics.idf)
        of = np.repeat(np.arange(len(items)), lengths)
        pairs, tf = np.unique(of * size + np.concatenate(items), return_counts=True)
        self.item_of, terms = pairs // size, pairs % size
        weights = statistics.weights(terms, tf, lengths[self.item_of])
        # Terms of each item, and postings of each term.
        self.heads = np.searchsorted(self.item_of, np.arange(len(items) + 1))
        self.names, self.terms = np.unique(terms, return_inverse=True)
        order = np.argsort(self.terms, kind="stable")
        self.postings, self.weights = self.item_of[order], weights[order]
        self.first = np.searchsorted(self.terms[order], np.arange(len(self.names) + 1))
        self.n = len(items)

    def keep(self, unused: np.ndarray) -> None:
        """Leave out the postings of items that are used; they are no neighbours any more."""
        kept = unused[self.postings]
        before = np.concatenate([[0], np.cumsum(kept)])
        self.first = before[self.first]
        self.postings, self.weights = self.postings[kept], self.weights[kept]

    def scores(self, item: int) -> np.ndarray:
        """BM25 score of every item of the shard for the terms of one."""
        terms = self.terms[self.heads[item] : self.heads[item + 1]]
        sizes = self.first[terms + 1] - self.first[terms]
        at = ragged(self.first[terms], sizes)
        return np.bincount(self.postings[at], self.weights[at], minlength=self.n)


def fill(items: list[np.ndarray], statistics: Statistics, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(item, start, length)`` pieces; all but the last are full."""
    index = Index(items, statistics)
    unused = np.ones(len(items), bool)
    left = np.array([len(x) for x in items], np.int64)
    begin = np.zeros(len(items), np.int64)
    windows, indexed = [], len(items)
    for seed in range(len(items)):
        if not unused[seed]:
            continue
        if 2 * (remaining := int(unused.sum())) < indexed:
            index.keep(unused)
            indexed = remaining
        room = window - int(left[seed])
        pieces = [(seed, int(begin[seed]), int(left[seed]))]
        unused[seed] = False
        near = np.flatnonzero(unused) if room else unused[:0]
        if len(near):
            scores = index.scores(seed)[near]
            near = near[np.argsort(-scores, kind="stable")]
        while room and len(near):
            fits = left[near] <= room
            at = int(fits.argmax())
            item = int(near[at]) if fits[at] else int(near[0])
            size = min(int(left[item]), room)
            pieces.append((item, int(begin[item]), size))
            begin[item] += size
            left[item] -= size
            room -= size
            unused[item] = left[item] > 0
            # Those before the taken one did not fit and will not.
            near = np.concatenate([near[:at][:1], near[at + 1 :]]) if fits[at] else near[1:]
        windows.append(pieces)
    return windows


def powers(pieces: list[tuple[int, int, int]], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """A short window as runs whose lengths are powers of two, the longest first."""
    total = sum(p[2] for p in pieces)
    if total == window:
        return [pieces]
    out, todo = [], list(pieces)
    for bit in range(total.bit_length() - 1, -1, -1):
        size = total & (1 << bit)
        if not size:
            continue
        run = []
        while size:
            item, start, length = todo.pop(0)
            taken = min(length, size)
            run.append((item, start, taken))
            size -= taken
            if taken < length:
                todo.insert(0, (item, start + taken, length - taken))
        out.append(run)
    return out


def pack(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end_id: int = END_ID, shard_items: int = SHARD_ITEMS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Pieces of ``(doc_id, text)`` documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers, ``start``
    counts the document's ids before it, ``offset`` those of its sequence.
    """
    encoded = encode(docs, tokenizer_file, end_id, window)
    # One row per id of the vocabulary at most.
    counts = encoded.where("ids is null").select(F.inline("terms")).groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counts.collect()}
    vocabulary = vocabulary_of(tokenizer_file, end_id)
    kind = kind_of(vocabulary)
    df = np.array([found.get(t, 0) for t in range(vocabulary)], np.int64)
    # Arrays and numbers only: workers need not have the package to read them.
    sent = docs.sparkSession.sparkContext.broadcast((df, found.get(ITEMS, 0), found.get(LENGTH, 0)))

    order = ["lead", "second", "row"]
    held_ids = encoded.where("ids is not null")
    near = held_ids.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics, number = Statistics(*sent.value), TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def shard() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            cut = [len(ids) // window * window for _, ids in held]
            windows = [[(k, start, window)] for k, end in enumerate(cut) for start in range(0, end, window)]
            owners = [k for k, (_, ids) in enumerate(held) if cut[k] < len(ids)]
            if owners:
                filled = fill([held[k][1][cut[k] :] for k in owners], statistics, window)
                filled = filled[:-1] + powers(filled[-1], window)
                windows += [[(owners[i], cut[owners[i]] + start, length) for i, start, length in pieces] for pieces in filled]
            columns: list[list] = [[] for _ in range(7)]
            room = 0
            for pieces in windows:
                offset = 0
                for k, start, length in pieces:
                    doc_id, ids = held[k]
                    row = (doc_id, start, length, ids[start : start + length].astype("<u4").tobytes(), len(ids), number, offset)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                number, room = number + 1, room + offset
                if room >= 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    columns, room = [[] for _ in range(7)], 0
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            held.clear()
            size = 0

        long = pa.int64()
        schema = pa.schema([("doc_id", long), ("start", long), ("length", long), ("ids", pa.binary()), ("doc_tokens", long), ("sequence_id", long), ("offset", long)])
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(data, kind)
                held.append((doc_id, ids))
                size += len(ids)
                if len(held) >= shard_items or size >= shard_ids:
                    yield from shard()
        if held:
            yield from shard()

    return near.mapInArrow(run, PIECES)
