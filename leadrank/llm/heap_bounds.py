"""Exact Lloyd clustering with heap-ordered bounds.

Vectors are whole numbers. They lie in blocks of a few thousand, one row of a
table each, with all that a block needs from round to round: ids, components at
the narrowest integer width that holds them, and for each cluster a heap of its
vectors. A vector's heap entry is the gap between a lower bound on its distance to
every other centroid and an upper bound on that to its own. When centroids move,
the gap shrinks by at most the own centroid's drift plus the largest drift among
the others; this is added up once per cluster instead of being taken from every
entry. An entry carries the sum at the time it was pushed, so it expires when the
cluster's sum reaches it. Expired vectors are popped from the top of the heap,
all others are untouched; popped ones are compared with all centroids exactly and
pushed on the heap of the nearest.

A vector that does not expire has a nearest centroid without a tie: bounds are
held apart by a margin for rounding. Ties among popped vectors go to the smaller
number. Distances are exact whole numbers: in doubles while squares stay below
2**53, in 64-bit integers while they fit, and in Python integers beyond.

A round is one narrow pass from a stored table of blocks to the next, which then
takes its place; a lost executor repeats its blocks. Blocks pass up sums per cluster and component, which
Spark adds up, so the driver gets as many numbers as centroids have components.
Sums travel in limbs of 48 bits and have no limit. No row meets another in a
shuffle, so equal vectors, however many, are no hot spot.

Vectors that are null, have another number of components, or hold null or
non-finite ones are left out. Repeated ids are vectors of their own; null ids
stay and are the last choice as first centroids. Fewer vectors than clusters give
fewer clusters, an empty table no rows. A squared distance or a sum beyond a
long is given as the largest long.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadrank.llm.shared import stored_anew

#: Vectors of a block at most.
BLOCK = 4096
LIMB = 48
LARGEST = (1 << 63) - 1
#: Components up to these sizes are exact in products of doubles and of 64-bit integers.
DOUBLES, LONGS = 1 << 21, 1 << 27
#: What rounding may take from a bound: a fixed part and a share of the distances.
MARGIN, SHARE = 1e-9, 1e-12

SUMS = "array<struct<cluster int, dim int, limb int, total bigint, n bigint>>"
BLOCKS = f"ids array<bigint>, width int, vectors binary, heads array<int>, keys array<double>, places array<int>, distances array<bigint>, sums {SUMS}"


def whole(vector: Column, dims: int) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


def floors(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as integers, exact; Python integers where 64 bits do not hold them."""
    if not len(x) or np.abs(x).max() < 2.0**53 / scale:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[math.floor(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in row] for row in x.tolist()], object)


def to_bytes(x: np.ndarray) -> tuple[int, bytes]:
    """Width in bytes (0: decimal text) and the data of a matrix of integers."""
    if x.dtype != object or all(abs(v) <= LARGEST for v in x.reshape(-1).tolist()):
        x = x.astype(np.int64)
        for width in (1, 2, 4, 8):
            bound = 1 << (8 * width - 1)
            if not x.size or (x.min() >= -bound and x.max() < bound):
                return width, x.astype(f"<i{width}").tobytes()
    return 0, " ".join(map(str, x.reshape(-1).tolist())).encode()


def from_bytes(width: int, data: bytes, dims: int) -> np.ndarray:
    if width:
        return np.frombuffer(data, f"<i{width}").astype(np.int64).reshape(-1, dims)
    return np.array([int(v) for v in data.split()], object).reshape(-1, dims)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    if not len(x) or not len(centroids):
        return np.zeros((len(x), len(centroids)), np.int64)
    top = max(abs(int(v)) for part in (x, centroids) for v in (part.min(), part.max()))
    if top > LONGS:
        x, centroids = x.astype(object), centroids.astype(object)
        return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    kind = np.float64 if top <= DOUBLES else np.int64
    x, centroids = x.astype(kind), centroids.astype(kind)
    out = (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)[None, :]
    return out.astype(np.int64)


def root(square: int) -> float:
    try:
        return math.sqrt(square)
    except OverflowError:
        return math.inf


def limbs(values: list[int]) -> Iterator[tuple[int, int, int]]:
    """(place, limb, value): numbers as sums of value times 2**(48 limb)."""
    for place, value in enumerate(values):
        sign, rest, limb = (-1 if value < 0 else 1), abs(value), 0
        while rest or limb == 0:
            yield place, limb, sign * (rest & ((1 << LIMB) - 1))
            rest, limb = rest >> LIMB, limb + 1


class Block:
    """The heaps of one block."""

    def __init__(self, vectors: np.ndarray, heaps: list[list[tuple[float, int]]], distances: np.ndarray | None = None) -> None:
        self.vectors, self.heaps, self.distances = vectors, heaps, distances

    @classmethod
    def of(cls, vectors: np.ndarray, centroids: np.ndarray, drift: list[float]) -> "Block":
        made = cls(vectors, [[] for _ in centroids])
        made.rescan(np.arange(len(vectors)), centroids, drift)
        return made

    def rescan(self, rows: np.ndarray, centroids: np.ndarray, drift: list[float]) -> None:
        """Compare rows with all centroids and push them where they belong."""
        if not len(rows) or not len(centroids):
            return
        d = squared(self.vectors[rows], centroids)
        # argmin takes the first of equal ones, thus the smaller number.
        own = d.argmin(axis=1)
        near = d[np.arange(len(rows)), own]
        if len(centroids) == 1:
            gaps = [math.inf] * len(rows)
        else:
            far = np.where(np.arange(len(centroids)) == own[:, None], d.max(axis=1, keepdims=True), d).min(axis=1)
            gaps = [
                lower - upper - SHARE * (lower + upper) - MARGIN if lower < math.inf else -math.inf
                for lower, upper in zip(map(root, far.tolist()), map(root, near.tolist()), strict=True)
            ]
        for row, cluster, gap in zip(rows.tolist(), own.tolist(), gaps, strict=True):
            heapq.heappush(self.heaps[cluster], (gap + drift[cluster], row))

    def pop(self, drift: list[float]) -> np.ndarray:
        """Take the rows out whose gap the drift of their cluster has used up."""
        out = []
        for cluster, heap in enumerate(self.heaps):
            bound = drift[cluster] * (1 + SHARE) + MARGIN
            while heap and not heap[0][0] > bound:
                out.append(heapq.heappop(heap)[1])
        return np.array(out, np.int64)

    def clusters(self) -> np.ndarray:
        of = np.zeros(len(self.vectors), np.int64)
        for cluster, heap in enumerate(self.heaps):
            of[[row for _, row in heap]] = cluster
        return of

    def sums(self) -> list[dict]:
        """Sums of components and number of vectors per cluster."""
        out = []
        for cluster, heap in enumerate(self.heaps):
            if heap:
                rows = self.vectors[[row for _, row in heap]]
                if rows.dtype != object and abs(rows).max() > LARGEST // BLOCK:
                    rows = rows.astype(object)
                total = [int(v) for v in rows.sum(axis=0)]
                out += [{"cluster": cluster, "dim": dim, "limb": limb, "total": v, "n": len(heap)} for dim, limb, v in limbs(total)]
        return out

    def inertia(self, centroids: np.ndarray) -> list[dict]:
        """Set the distances to own centroids; their sums per cluster."""
        of = self.clusters()
        own = [0] * len(of)
        for cluster, c in enumerate(centroids):
            rows = np.flatnonzero(of == cluster)
            for row, d in zip(rows.tolist(), squared(self.vectors[rows], c[None, :])[:, 0].tolist(), strict=True):
                own[row] = d
        self.distances = [min(d, LARGEST) for d in own]
        sums: dict[int, int] = {}
        for cluster, d in zip(of.tolist(), own, strict=True):
            sums[cluster] = sums.get(cluster, 0) + d
        return [{"cluster": k, "dim": 0, "limb": limb, "total": v, "n": 0} for k, s in sums.items() for _, limb, v in limbs([s])]

    def row(self, ids: pa.Array, stored_as: tuple[int, bytes], sums: list[dict]) -> dict:
        return {
            "ids": ids, "width": stored_as[0], "vectors": stored_as[1],
            "heads": np.cumsum([0, *map(len, self.heaps)]).tolist(),
            "keys": [k for heap in self.heaps for k, _ in heap], "places": [p for heap in self.heaps for _, p in heap],
            "distances": self.distances, "sums": sums,
        }


ARROW = pa.schema(
    [
        ("ids", pa.list_(pa.int64())), ("width", pa.int32()), ("vectors", pa.binary()), ("heads", pa.list_(pa.int32())),
        ("keys", pa.list_(pa.float64())), ("places", pa.list_(pa.int32())), ("distances", pa.list_(pa.int64())),
        ("sums", pa.list_(pa.struct([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("total", pa.int64()), ("n", pa.int64())]))),
    ]
)


def first_round(rows: DataFrame, centroids: list[list[int]], dims: int, scale: int, last: bool) -> DataFrame:
    """Blocks of ``(id, vec)`` rows, every vector compared with the first centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.array(centroids, object).reshape(-1, dims)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                x = floors(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                block = Block.of(x, start, [0.0] * len(start))
                sums = block.inertia(start) if last else block.sums()
                yield pa.RecordBatch.from_pylist([block.row(part.column(0).to_pylist(), to_bytes(x), sums)], schema=ARROW)

    return rows.mapInArrow(run, BLOCKS)


def next_round(blocks: DataFrame, centroids: list[list[int]], drift: list[float], dims: int, last: bool) -> DataFrame:
    """Blocks with expired vectors put where they belong now."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = np.array(centroids, object).reshape(-1, dims)
        for batch in batches:
            for k in range(batch.num_rows):
                ids, width, data, heads, keys, places = (batch.column(j)[k].as_py() for j in range(6))
                entries = list(zip(keys, places, strict=True))
                block = Block(from_bytes(width, data, dims), [entries[a:b] for a, b in zip(heads, heads[1:])])
                block.rescan(block.pop(drift), now, drift)
                sums = block.inertia(now) if last else block.sums()
                yield pa.RecordBatch.from_pylist([block.row(ids, (width, data), sums)], schema=ARROW)

    return blocks.select("ids", "width", "vectors", "heads", "keys", "places").mapInArrow(run, BLOCKS)


def totals(blocks: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(cluster, component) -> sum and count, of all blocks."""
    parts = blocks.select(F.inline("sums")).groupBy("cluster", "dim", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for r in parts.collect():
        had = out.get((r["cluster"], r["dim"]), (0, 0))
        # A component has limb 0 in every block, which counts its vectors.
        out[r["cluster"], r["dim"]] = had[0] + (int(r["total"]) << (LIMB * r["limb"])), had[1] + (r["n"] if r["limb"] == 0 else 0)
    return out


def starts(rows: DataFrame, clusters: int, seed: int, dims: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest digests of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.select(digest.alias("digest"), "vec").orderBy(F.asc_nulls_last("digest"), "vec").limit(clusters)
    x = [r["vec"] for r in first.orderBy(F.asc_nulls_last("digest"), "vec").collect()]
    return [[int(v) for v in row] for row in floors(np.array(x, np.float64).reshape(-1, dims), scale)]


def cluster(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, seed: int = 1
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid)`` of every vector that takes part.

    ``rounds`` times vectors are assigned and centroids moved to the floor of the
    mean; then vectors are assigned once more. ``centroid`` is the array of its
    components as decimal numbers.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec")).where(whole(F.col("vec"), dims))
    centroids = starts(rows, clusters, seed, dims, scale)
    drift = [0.0] * len(centroids)
    blocks, place = stored_anew(first_round(rows, centroids, dims, scale, rounds == 0), "heap-blocks")
    for number in range(rounds):
        sums = totals(blocks)
        moved = [
            [sums[k, j][0] // sums[k, j][1] for j in range(dims)] if (k, 0) in sums else old
            for k, old in enumerate(centroids)
        ]
        steps = [root(sum((a - b) ** 2 for a, b in zip(old, new, strict=True))) for old, new in zip(centroids, moved, strict=True)]
        centroids = moved
        drift = [d + steps[k] + max([s for j, s in enumerate(steps) if j != k], default=0.0) for k, d in enumerate(drift)]
        blocks, place = stored_anew(next_round(blocks, centroids, drift, dims, number == rounds - 1), "heap-blocks", place)
    return _members(blocks, centroids, key)


def _members(blocks: DataFrame, centroids: list[list[int]], key: str) -> DataFrame:
    """Vectors of the blocks, with what holds for their clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, distances = (batch.column(j).slice(k, 1).flatten() for j in (0, 3))
                heads, places = (batch.column(j).slice(k, 1).flatten().to_numpy() for j in (1, 2))
                owner = np.empty(len(ids), np.int32)
                owner[places] = np.repeat(np.arange(len(heads) - 1, dtype=np.int32), np.diff(heads))
                yield pa.RecordBatch.from_arrays([ids, pa.array(owner), distances], names=[key, "cluster", "distance"])

    members = blocks.select("ids", "heads", "places", "distances").mapInArrow(run, T.StructType().add(key, "long").add("cluster", "integer").add("distance", "long"))
    found = {k: total for (k, _), (total, _) in totals(blocks).items()}
    # As many constants as there are clusters.
    sums = F.array(*[F.lit(min(found.get(k, 0), LARGEST)).cast("bigint") for k in range(len(centroids))])
    texts = F.array(*[F.array(*[F.lit(str(v)) for v in c]) for c in centroids])
    if not centroids:
        sums, texts = F.array().cast("array<bigint>"), F.array().cast("array<array<string>>")
    of = F.col("cluster")
    inertia = F.lit(min(sum(found.values()), LARGEST)).cast("bigint")
    return members.select(key, of, "distance", F.get(sums, of).alias("cluster_inertia"), inertia.alias("inertia"), F.get(texts, of).alias("centroid"))
