"""SimHash near-duplicates, linked through pivot distance tables.

A fingerprint has 64 bits, one for each bit that is set in over half of the
hashes of a text's shingles. For every fingerprint the table holds its Hamming
distances to 12 reference fingerprints, counted apart in each of four blocks of
16 bits: 48 coordinates. By the triangle inequality, two fingerprints that
differ in ``k`` bits of a block differ by at most ``k`` in each of that block's
coordinates. So for a pair at 3 bits or fewer

* some block has no differing bit, and all its coordinates agree: equal
  coordinates of a block are the join key, and no pair is lost;
* the largest coordinate differences of the four blocks add up to 3 at most:
  all other candidate pairs are discarded.

What is left is verified on the fingerprints. Equal fingerprints are one class
from the start. A bucket (equal key) is compared in one task as sorted numpy
columns, and yields the links of a spanning forest, never all pairs. Buckets
above ``LIMIT`` classes get finer keys (three of the six bytes outside the block
must agree as well); those still above it are compared as pairs of chunks in
tasks of their own. Nothing is capped.

Null texts count as empty; texts without a word have fingerprint zero and link
like any other. Very long texts are worked on whole; their bits are counted in
slices of shingles. Repeated doc_ids stay as rows. Null doc_ids are rows of their
own fingerprint, but never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadrank.llm.components import connected_components
from leadrank.llm.shared import groups_of, stored

BLOCKS, BLOCK_BITS, REFERENCES = 4, 16, 12
#: Classes compared in one bucket.
LIMIT = 4096


def references() -> np.ndarray:
    """Reference fingerprints: the SplitMix64 sequence from state 0."""
    state = np.arange(1, REFERENCES + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        z = state * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Distances to the references within each block: (n, blocks, references)."""
    apart = prints[:, None] ^ references()[None, :]
    out = np.empty((len(prints), BLOCKS, REFERENCES), np.int8)
    for b in range(BLOCKS):
        out[:, b] = np.bitwise_count((apart >> np.uint64(b * BLOCK_BITS)) & np.uint64(2**BLOCK_BITS - 1))
    return out


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def prints_of(texts: list[str | None], shingle: int) -> np.ndarray:
    """Fingerprint of each text."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    sizes = []
    for text in texts:
        words = words_of(text)
        if len(words) > shingle:
            made = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        else:
            made = [b" ".join(words)] if words else []
        before = len(hashes)
        hashes.extend([xxh64_intdigest(s, 42) for s in made])
        sizes.append(len(hashes) - before)
    out = np.zeros(len(texts), np.uint64)
    if not hashes:
        return out
    full = np.array(sizes)
    rows = np.flatnonzero(full)
    starts = np.concatenate([[0], np.cumsum(full[rows])])
    bytes_ = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for at, row in enumerate(rows.tolist()):
        a, b = int(starts[at]), int(starts[at + 1])
        ones = np.zeros(64, np.int64)
        for k in range(a, b, 1 << 20):
            ones += np.unpackbits(bytes_[k : min(b, k + (1 << 20))], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[row] = np.packbits(2 * ones > b - a, bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text", others: list[str] | None = None) -> DataFrame:
    """``(id, print)`` and ``others`` of every row; the 64 bits are held as a signed long."""
    kept = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"), *(others or []))
    schema = kept.select("id").schema.add("print", T.LongType())
    for name in others or []:
        schema = schema.add(kept.schema[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column(1).to_pylist()
            for a, b in groups_of(texts):
                prints = prints_of(texts[a:b], shingle).view(np.int64)
                same = [c.slice(a, b - a) for c in rows.columns]
                yield pa.RecordBatch.from_arrays([same[0], pa.array(prints), *same[2:]], names=["id", "print", *rows.schema.names[2:]])
        # The worker waits for other tasks; what it does not use goes back.
        pa.default_memory_pool().release_unused()

    return kept.mapInArrow(run, schema)


def _keyed(classes: DataFrame) -> DataFrame:
    """A row for each class and block, with a hash of the block's coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(17) ** np.arange(REFERENCES, dtype=np.uint64)
        for rows in batches:
            prints = rows.column(0).to_numpy(zero_copy_only=False)
            table = pivot_table(prints.view(np.uint64))
            for b in range(BLOCKS):
                # Distances are 0 to 16, so this number names them exactly.
                key = (table[:, b].astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)
                block = np.full(len(key), b, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(key), *rows.columns], names=["block", "key", "print", "id"])

    return classes.select("print", "id").mapInArrow(run, "block int, key bigint, print bigint, id bigint")


class _Forest:
    """Union-find over row numbers with labels for whole columns."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def flatten(self) -> np.ndarray:
        while not (np.array_equal(up := self.up[self.up], self.up)):
            self.up = up
        return self.up


def bucket_links(bucket: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a spanning forest of the links within buckets.

    ``bucket`` numbers the rows' buckets. Rows are sorted by the distance to one
    reference, and row ``i`` meets row ``i + d`` for rising ``d`` as long as that
    distance is within reach.
    """
    table = pivot_table(prints)
    lead = table[:, :, 0].sum(axis=1, dtype=np.int16)
    order = np.lexsort((prints, lead, bucket))
    bucket, prints, table, lead = bucket[order], prints[order], table[order], lead[order]
    n, left, right = len(order), [], []
    forest = _Forest(n)
    live, d = np.arange(n - 1), 1
    while len(live):
        live = live[live + d < n]
        j = live + d
        near = (bucket[live] == bucket[j]) & (lead[j] - lead[live] <= bits)
        live, j = live[near], j[near]
        labels = forest.flatten()
        new = labels[live] != labels[j]
        for k in range(0, len(live), 1 << 18):
            part = slice(k, k + (1 << 18))
            a, b = live[part][new[part]], j[part][new[part]]
            widest = np.abs(table[a] - table[b]).max(axis=2).sum(axis=1, dtype=np.int16)
            a, b = a[widest <= bits], b[widest <= bits]
            linked = np.bitwise_count(prints[a] ^ prints[b]) <= bits
            for x, y in zip(a[linked].tolist(), b[linked].tolist(), strict=True):
                p, q = forest.find(x), forest.find(y)
                if p != q:
                    forest.up[max(p, q)] = min(p, q)
                    left.append(order[x])
                    right.append(order[y])
        d += 1
    return np.array(left, np.int64), np.array(right, np.int64)


def _linked(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Links within the buckets that equal ``keys`` name."""
    names = [*keys, "print", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            change = np.zeros(len(columns[0]), np.int64)
            for c in columns[: len(keys)]:
                change[1:] |= c[1:] != c[:-1]
            a, b = bucket_links(np.cumsum(change), columns[-2].view(np.uint64), bits)
            return pa.RecordBatch.from_arrays([pa.array(columns[-1][a]), pa.array(columns[-1][b])], names=["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(new[0]):
                continue
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            # The last bucket may go on in the next batch.
            same = np.ones(len(held[0]), bool)
            for c in held[: len(keys)]:
                same &= c == c[-1]
            done = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if done:
                yield links([c[:done] for c in held])
                held = [c[done:] for c in held]
        if held is not None:
            yield links(held)

    spread = rows.select(*names).repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(run, "a bigint, b bigint")


def links(classes: DataFrame, bits: int = 3, limit: int = LIMIT) -> DataFrame:
    """``(a, b)`` links that join all classes ``(print, id)`` at ``bits`` or fewer differing bits.

    ``bits`` may be up to 3, as some block must have no differing bit.
    """
    if not 0 <= bits < BLOCKS:
        raise ValueError("links need fewer differing bits than blocks")
    keyed = stored(_keyed(classes), "simhash-keyed")
    sizes = keyed.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    sizes = stored(sizes, "simhash-buckets")
    small = keyed.join(sizes.where(F.col("n") <= limit), ["block", "key"], "left_semi")
    found = _linked(small, ["block", "key"], bits)
    hot = sizes.where(F.col("n") > limit)
    if hot.isEmpty():
        return found
    # Six bytes lie outside the block; three differing bits leave three of them equal.
    outside = [F.shiftright("print", 8 * k).bitwiseAND(F.lit(255)) for k in range(8)]
    finer = []
    for b in range(BLOCKS):
        rest = [outside[k] for k in range(8) if k // 2 != b]
        for i in range(6):
            for j in range(i + 1, 6):
                for k in range(j + 1, 6):
                    value = rest[i] * 65536 + rest[j] * 256 + rest[k]
                    finer.append(F.when(F.col("block") == b, F.struct(F.lit(len(finer)).alias("part"), value.alias("value"))))
    fine = keyed.join(hot.select("block", "key"), ["block", "key"], "left_semi").withColumn(
        "_fine", F.explode(F.filter(F.array(*finer), lambda x: x.isNotNull()))
    )
    fine = stored(fine.select("key", "_fine.part", "_fine.value", "print", "id"), "simhash-fine")
    names = ["key", "part", "value"]
    sizes = stored(fine.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "simhash-fine-buckets")
    found = found.unionAll(_linked(fine.join(sizes.where(F.col("n") <= limit), names, "left_semi"), names, bits))
    # Chunks of the largest buckets meet in pairs.
    chunks = F.ceil(F.col("n") * 2 / limit).cast("int")
    large = fine.join(sizes.where(F.col("n") > limit), names).withColumn("chunks", chunks)
    own = F.pmod(F.xxhash64("print"), F.col("chunks"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda c: F.struct(F.least(c, F.col("own")).alias("c1"), F.greatest(c, F.col("own")).alias("c2")),
    )
    large = large.withColumn("own", own.cast("int")).withColumn("_meet", F.explode(meets))
    large = large.select(*names, "_meet.c1", "_meet.c2", "print", "id")
    return found.unionAll(_linked(large, [*names, "c1", "c2"], bits))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 3, key: str = "doc_id", text: str = "text", others: list[str] | None = None
) -> DataFrame:
    """``(key, print, component, root)`` and ``others`` of every row.

    ``component`` is the smallest key that links reach, the row's own included.
    ``root`` names the group itself, which repeated or null keys do not.
    """
    prints = stored(fingerprints(docs, shingle, key, text, others), "simhash-prints")
    # A class is known by its fingerprint, as a repeated key may be in several.
    classes = stored(prints.groupBy("print").agg(F.min("id").alias("least")), "simhash-classes")
    roots = connected_components(links(classes.select("print", F.col("print").alias("id")), bits))
    member = classes.join(roots.withColumnRenamed("id", "print"), "print", "left")
    member = member.select("print", "least", F.coalesce("component", "print").alias("root"))
    named = member.groupBy("root").agg(F.min("least").alias("component"))
    of_class = member.join(named, "root").select("print", "component", "root")
    return prints.join(of_class, "print").select(F.col("id").alias(key), "print", "component", "root", *(others or []))


def hexadecimal(print_: Column) -> Column:
    return F.lpad(F.lower(F.hex(print_)), 16, "0")
