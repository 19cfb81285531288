"""Importance resampling towards a target text distribution.

Words are runs of letters, digits and all characters beyond ASCII; features are
all runs of one to three consecutive words of a text, hashed by CRC-32 into
10,000 buckets. A bucket gains by being commoner in the target than in the corpus,
a text's weight is the sum of its features' gains, and a Gumbel variate per key
turns the largest weights plus variates into a draw without replacement.

Texts are worked on in batches: they are joined with a sentinel that no word
holds, one regular expression finds the words of all of them, a binary search
in the texts' offsets tells which text each word belongs to, and runs whose ends
lie in different texts are masked out before ``bincount``. CRC-32 is linear, so the
code of a run comes from the codes of its words by table look-ups, over whole
columns.

The corpus is read twice: for the counts of its buckets (10,000 numbers, added up
by Spark) and for the weights. Counts cover all rows. Ranks come from a range
shuffle of narrow rows and the sizes of its partitions, so no task orders the
table; a row number made in a stored table spreads even equal rows.

A null text holds no words: no features and weight 0. Null keys hash as an empty
key; of equal scores they come last. Rows that repeat a key are drawn one by one.
Empty tables give no rows, and an empty target gains by the formula with no
counts. Texts of any length are worked through in slices of words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from leadrank.llm.shared import groups_of, once, stored

BUCKETS, LONGEST, SEED = 10_000, 3, 42
#: Lower-cased ASCII letters, digits, and every byte of a character beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTINEL = b"\x00"
#: Words of a slice, and bytes of a word that tables serve; longer words go to zlib.
SLICE, SHORT = 400_000, 64


def _byte_table() -> np.ndarray:
    """The usual table of the reflected polynomial 0xEDB88320."""
    codes = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        codes = np.where(codes & 1, (codes >> 1) ^ np.uint32(0xEDB88320), codes >> 1)
    return codes


class Crc:
    """CRC-32 of many words at once, and of two strings put together.

    ``shift[n, k, b]`` is what byte ``k`` with value ``b`` of a code becomes when
    ``n`` more bytes follow.
    """

    def __init__(self) -> None:
        self.table = _byte_table()
        now = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        steps = [now]
        for _ in range(SHORT):
            now = self.table[now & 255] ^ (now >> 8)
            steps.append(now)
        self.shift = np.stack(steps).reshape(-1)

    def of(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        flat = np.frombuffer(data, np.uint8)
        order = np.argsort(-sizes, kind="stable")
        at, size = starts[order], sizes[order]
        out = np.full(len(order), 0xFFFFFFFF, np.uint32)
        longer = np.searchsorted(-size, -np.arange(SHORT + 1), side="left")
        for j in range(SHORT):
            # The first ``n`` words have a byte at ``j``.
            n = int(longer[j])
            if n == 0:
                break
            part = out[:n]
            out[:n] = self.table[(part ^ flat[at[:n] + j]) & 255] ^ (part >> 8)
        out = ~out
        for k in range(int(longer[SHORT])):
            out[k] = zlib.crc32(data[int(at[k]) : int(at[k] + size[k])])
        made = np.empty_like(out)
        made[order] = out
        return made

    def join(self, left: np.ndarray, right: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        """Codes of left strings followed by right ones of ``sizes`` bytes, up to ``SHORT``."""
        row = np.asarray(sizes) * 1024
        out = right
        for k in range(4):
            out = out ^ self.shift[row + 256 * k + ((left >> np.uint32(8 * k)) & 255)]
        return out


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """In slices: text of each word, and text and bucket of each feature."""
    crc = once("importance crc", Crc)
    lowered = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = SENTINEL.join(lowered)
    offsets = np.cumsum([0, *(len(t) + 1 for t in lowered[:-1])])
    space = np.uint32(zlib.crc32(b" "))
    words = WORD.finditer(data)
    spans: list[tuple[int, int]] = []
    while True:
        old = min(len(spans), LONGEST - 1)
        spans = spans[len(spans) - old :] + [m.span() for m in islice(words, SLICE)]
        if len(spans) == old:
            return
        starts, ends = np.array(spans, np.int64).T
        sizes = ends - starts
        of = np.searchsorted(offsets, starts, side="right") - 1
        codes = crc.of(data, starts, sizes)
        run, texts_of, buckets = codes, [], []
        for n in range(1, LONGEST + 1):
            if n > 1:
                # Runs of n words from those of n - 1, by the last word.
                last = slice(n - 1, None)
                spaced = crc.join(run[: len(starts) - n + 1], space, 1)
                run = crc.join(spaced, codes[last], np.minimum(sizes[last], SHORT))
                for k in np.flatnonzero(sizes[last] > SHORT).tolist():
                    a, b = spans[k + n - 1]
                    run[k] = zlib.crc32(data[a:b], int(spaced[k]))
            # Runs that end in this slice's new words and lie in one text.
            new = slice(max(0, old - n + 1), None)
            first, final = of[: len(of) - n + 1][new], of[n - 1 :][new]
            inside = first == final
            texts_of.append(final[inside])
            buckets.append((run[new] % np.uint32(BUCKETS))[inside].astype(np.int64))
        yield of[old:], np.concatenate(texts_of), np.concatenate(buckets)


def bucket_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """``(bucket, n)``: features of all texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in groups_of(texts):
                for _, _, buckets in features(texts[a:b]):
                    total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return rows.select(F.col(text).cast("string")).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> list[int]:
    """Gain of each bucket from the ``(bucket, n)`` counts of both; 10,000 rows each at most."""

    def held(counts: DataFrame) -> list[int]:
        out = [0] * BUCKETS
        for row in counts.collect():
            out[row["bucket"]] = row["n"]
        return out

    s, t = held(corpus), held(target)
    all_s, all_t = sum(s) + BUCKETS, sum(t) + BUCKETS
    return [math.floor(1000 * math.log(((b + 1) * all_s) / ((a + 1) * all_t))) for a, b in zip(s, t, strict=True)]


def weigh(docs: DataFrame, gain: list[int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_features, weight)`` of every row."""
    schema = docs.select(F.col(key)).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gained = np.array(gain, np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups_of(texts):
                sums = np.zeros((3, b - a), np.int64)
                for words, of, buckets in features(texts[a:b]):
                    sums[0] += np.bincount(words, minlength=b - a)
                    sums[1] += np.bincount(of, minlength=b - a)
                    # Whole numbers far below 2**53 each slice, so doubles add them exactly.
                    sums[2] += np.bincount(of, gained[buckets], minlength=b - a).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, sums)], names=[key, "n_words", "n_features", "weight"])

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def variate(key: str, seed: int = SEED):
    """``floor(1000 g)`` with ``g`` Gumbel, from a digest of seed and key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, key: str = "doc_id", text: str = "text", target_text: str = "text"
) -> DataFrame:
    """``(key, n_features, weight, score, rank)`` of every row; ``rank`` is null for rows that are not drawn.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred are
    drawn, rounded down: those with the highest scores, ties to smaller keys.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    scored = weigh(docs, gain, key, text).withColumn("score", F.col("weight") + variate(key)).withColumn("__lr_row", F.monotonically_increasing_id())
    scored = stored(scored, "importance-scores")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last(key), F.desc("weight"), F.desc("n_features"), F.asc("__lr_row")]
    # The row number tells a row's partition and its place there.
    placed = stored(scored.where(able).orderBy(*order).withColumn("__lr_place", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("__lr_place", 33)
    sizes = placed.groupBy(part.alias("__lr_part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition, so this window and the broadcast are bounded.
    before = F.sum("n").over(Window.orderBy("__lr_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__lr_part", F.coalesce(before, F.lit(0)).alias("__lr_start"))
    at = F.col("__lr_start") + F.col("__lr_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("__lr_part", part).join(F.broadcast(starts), "__lr_part").withColumn("rank", F.when(at <= drawn, at).cast("bigint"))
    names = [key, "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionAll(scored.where(~able).withColumn("rank", F.lit(None).cast("bigint")).select(*names))
