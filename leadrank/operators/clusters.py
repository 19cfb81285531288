"""K-means, assignment to centroids, silhouettes.

Everything is deterministic: fits start from a coreset, the vectors with the
smallest digests of their ids, so a run on other partitions or machines gives
the same clusters.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType

from leadrank.functions.vectors import map_vectors, matrix_of
from leadrank.operators.keys import MAX_KEY_BYTES
from leadrank.session import Reuse

#: Centroids that come to the driver at most; their bytes are checked as well.
MAX_CENTROIDS = 1_000_000
#: Vectors of a coreset, and assign-and-average steps of a fit at most.
CORESET_ROWS, STEPS = 4096, 10
#: Rows whose Euclidean silhouette a sweep takes, each against all rows.
SAMPLE_ROWS = 1024
#: Rows that are compared with centroids or with each other at once.
SLICE_ROWS = 512
#: Rows of one tile of the exact silhouette.
BLOCK_ROWS = 8192
#: Sample rows whose sums travel together.
GROUP_ROWS = 16


def _usable(rows: DataFrame, row_id: str, vec: str) -> DataFrame:
    kept = rows.where(F.col(vec).isNotNull())
    return kept.select(F.col(row_id).alias("id"), F.col(vec).cast("array<double>").alias("vec"))


def _digest(seed: int):
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)


def coreset(rows: DataFrame, seed: int, size: int):
    """The vectors with the smallest digests of ``seed`` and id, in that order, as a matrix.

    Each task keeps its smallest, and the smallest of those are the smallest of
    all, whatever the partitions.
    """
    import numpy as np

    first = rows.select(_digest(seed).alias("_d"), "id", "vec").orderBy("_d", "id").limit(size).collect()
    found = sorted(((r["_d"], str(r["id"]), r["vec"]) for r in first), key=lambda r: r[:2])
    return np.array([r[2] for r in found], dtype=np.float64).reshape(len(found), -1 if found else 0)


def _costs(x, centres):
    """Squared distances but for |x|^2, which is the same for all centroids."""
    return (centres * centres).sum(axis=1) - 2.0 * (x @ centres.T)


def _weights(rows: DataFrame, points):
    """For each point the number of rows it is nearest to."""
    import numpy as np

    placed = map_vectors(rows, [], "vec", _nearest(rows, points), "at", IntegerType())
    out = np.zeros(len(points), np.int64)
    for r in placed.groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def _nearest(rows: DataFrame, centres):
    """For ``map_vectors``: index of the nearest centroid, the first in a tie."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def compute(x, _):
        import numpy as np
        import pyarrow as pa

        parts = [_costs(x[a : a + SLICE_ROWS], sent.value).argmin(axis=1) for a in range(0, len(x), SLICE_ROWS)]
        return pa.array(np.concatenate(parts).astype(np.int32))

    return compute


def seeds(points, weights, k: int):
    """Starting centroids: the heaviest point, then each time the one with the largest weight times squared distance."""
    import numpy as np

    at = int(weights.argmax())
    chosen = [at]
    gaps = ((points - points[at]) ** 2).sum(axis=1)
    for _ in range(min(k, len(points)) - 1):
        at = int((weights * gaps).argmax())
        chosen.append(at)
        gaps = np.minimum(gaps, ((points - points[at]) ** 2).sum(axis=1))
    return points[chosen]


def _sums(rows: DataFrame, sets: list) -> list:
    """For each set of centroids: number of rows, vector sum and sum of squared norms by nearest centroid.

    One pass for all sets. A task passes on one row per centroid.
    """
    import numpy as np

    sent = rows.sparkSession.sparkContext.broadcast(sets)
    offsets = np.cumsum([0, *(len(c) for c in sets)])

    def run(batches):
        import pyarrow as pa

        total = int(sum(len(c) for c in sent.value))
        dims = sent.value[0].shape[1]
        every = np.concatenate(sent.value)
        ends = np.cumsum([0, *(len(c) for c in sent.value)])
        counts, sums, squares = np.zeros(total, np.int64), np.zeros((total, dims)), np.zeros(total)
        for batch in batches:
            whole = matrix_of(batch.column(0))
            for a in range(0, len(whole), SLICE_ROWS):
                x = whole[a : a + SLICE_ROWS]
                costs, norms = _costs(x, every), (x * x).sum(axis=1)
                for start, end in zip(ends, ends[1:]):
                    at = start + costs[:, start:end].argmin(axis=1)
                    order = np.argsort(at, kind="stable")
                    names, first = np.unique(at[order], return_index=True)
                    sums[names] += np.add.reduceat(x[order], first, axis=0)
                    squares += np.bincount(at, norms, total)
                    counts += np.bincount(at, minlength=total)
        held = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(held) + 1) * dims, dims, dtype=np.int32)), pa.array(sums[held].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held]), lists, pa.array(squares[held])], names=["slot", "n", "sum", "q"])

    parts = rows.select("vec").mapInArrow(run, "slot int, n bigint, sum array<double>, q double")
    added = parts.groupBy("slot").agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("sum")).alias("sum"), F.sum("q").alias("q"))
    # As many rows as there are centroids.
    found = added.select("slot", "n", vector_to_array("sum").alias("sum"), "q").toArrow()
    total, dims = int(offsets[-1]), sets[0].shape[1]
    counts, sums, squares = np.zeros(total, np.int64), np.zeros((total, dims)), np.zeros(total)
    if found.num_rows:
        slots = found.column("slot").to_numpy()
        counts[slots], squares[slots] = found.column("n").to_numpy(), found.column("q").to_numpy()
        sums[slots] = matrix_of(found.column("sum").combine_chunks())
    return [(counts[a:b], sums[a:b], squares[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]


def fit(rows: DataFrame, ks: list[int], seed: int = 0, steps: int = STEPS, coreset_rows: int = CORESET_ROWS) -> list:
    """Centroids for each number of clusters, from ``(id, vec)`` rows; all fits share each pass.

    ``steps`` assign-and-average steps from the seeds of a weighted coreset, or
    fewer where nothing moves any more. A cluster that loses all its rows keeps its
    centroid.
    """
    import numpy as np

    points = coreset(rows, seed, coreset_rows)
    if not len(points):
        return [points.reshape(0, 0) for _ in ks]
    every = seeds(points, _weights(rows, points), max(ks))
    # Seeds come one after the other, so fewer clusters start from the first of them.
    now = [every[:k] for k in ks]
    live = list(range(len(ks)))
    for _ in range(steps):
        if not live:
            break
        for k, (counts, sums, _) in zip(list(live), _sums(rows, [now[k] for k in live]), strict=True):
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], now[k])
            if np.abs(moved - now[k]).max() <= 1e-12:
                live.remove(k)
            now[k] = moved
    return now


def kmeans(rows: DataFrame, row_id: str, vec: str, k: int, seed: int = 0, reuse: Reuse | None = None):
    """Fit k clusters; returns the centroids and ``(row_id, cluster)``.

    Fewer rows than clusters give fewer clusters, rows without a vector none.
    """
    usable = (reuse or Reuse()).keep(_usable(rows, row_id, vec))
    (centres,) = fit(usable, [k], seed)
    if not len(centres):
        return centres, usable.select(F.col("id").alias(row_id), F.lit(0).alias("cluster")).limit(0)
    placed = map_vectors(usable, ["id"], "vec", _nearest(usable, centres), "cluster", IntegerType())
    return centres, placed.withColumnRenamed("id", row_id)


def centroid_rows(centroids: DataFrame) -> list[tuple[int, list[float]]]:
    """``(cluster, vec)`` rows on the driver in cluster order, up to the size that may be sent to every task."""
    rows = centroids.select("cluster", F.col("vec").cast("array<double>").alias("vec")).limit(MAX_CENTROIDS + 1).toArrow()
    if rows.num_rows > MAX_CENTROIDS or rows.nbytes > MAX_KEY_BYTES:
        raise ValueError(f"{rows.num_rows} centroids of {rows.nbytes} bytes are more than may be sent to every task")
    return sorted(zip(rows.column("cluster").to_pylist(), rows.column("vec").to_pylist(), strict=True))


def _assigned(rows: DataFrame, keep: list[str], vec: str, current: list[tuple[int, list[float]]]) -> DataFrame:
    import numpy as np

    usable = rows.where(F.col(vec).isNotNull())
    nearest = _nearest(rows, np.array([v for _, v in current], dtype=np.float64))
    names = rows.sparkSession.sparkContext.broadcast(np.array([c for c, _ in current], dtype=np.int32))

    def compute(x, batch):
        import pyarrow as pa

        return pa.array(names.value[nearest(x, batch).to_numpy()])

    return map_vectors(usable, keep, vec, compute, "cluster", IntegerType())


def assign(rows: DataFrame, row_id: str, vec: str, centroids: DataFrame) -> DataFrame:
    """``(row_id, cluster)``: nearest given centroid of each row."""
    return _assigned(rows, [row_id], vec, centroid_rows(centroids))


def lloyd_steps(rows: DataFrame, vec: str, centroids: DataFrame, steps: int) -> DataFrame:
    """``(cluster, n, vec)`` after some assign-and-average steps from given centroids.

    Between steps only the centroids travel. A cluster that loses all its rows
    keeps its centroid and drops out of the result of the last step.
    """
    current = centroid_rows(centroids)
    for step in range(steps):
        moved = (
            _assigned(rows, [vec], vec, current)
            .groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>"))).alias("_mean"))
            .select("cluster", "n", vector_to_array("_mean").alias("vec"))
        )
        if step == steps - 1:
            return moved
        latest = dict(current)
        # No more clusters than there are centroids.
        latest.update(centroid_rows(moved))
        current = sorted(latest.items())
    raise ValueError("steps must be at least 1")


def _moments(usable: DataFrame) -> tuple:
    """Names, sizes, vector sums and sums of squared norms of the clusters of ``(label, vec)`` rows."""
    import numpy as np

    norm2 = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    moments = usable.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), Summarizer.sum(array_to_vector("vec")).alias("sum"), F.sum(norm2).alias("q")
    )
    moments = moments.select(F.col("label").alias("cluster"), "n", vector_to_array("sum").alias("vec"), "q")
    first = usable.select(F.size("vec").alias("d")).first()
    if first is None:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    # One row per cluster, fetched up to the size that may be sent to every task.
    most = MAX_KEY_BYTES // (8 * max(1, first["d"]))
    found = moments.limit(most + 1).toArrow()
    if found.num_rows > most:
        raise ValueError(f"more than {most} clusters are more than may be sent to every task")
    order = np.argsort(found.column("cluster").to_numpy(), kind="stable")
    return (
        found.column("cluster").to_numpy()[order].astype(np.int64),
        found.column("n").to_numpy()[order].astype(np.float64),
        matrix_of(found.column("vec").combine_chunks())[order],
        found.column("q").to_numpy()[order],
    )


def _labelled(rows: DataFrame, row_id: str, vec: str, label: str) -> DataFrame:
    return rows.where(F.col(vec).isNotNull()).select(
        F.col(row_id).alias("id"), F.col(label).cast("int").alias("label"), F.col(vec).cast("array<double>").alias("vec")
    )


def silhouette_squared(rows: DataFrame, row_id: str, vec: str, label: str) -> DataFrame:
    """``(row_id, label, s)`` under squared Euclidean distance, without any pairs.

    The mean squared distance of a row to a cluster follows from the cluster's
    size, vector sum and sum of squared norms, which are one row per cluster.
    """
    usable = _labelled(rows, row_id, vec, label)
    sent = rows.sparkSession.sparkContext.broadcast(_moments(usable))

    def width(x, batch):
        import numpy as np
        import pyarrow as pa

        names, sizes, sums, squares = sent.value
        own = np.searchsorted(names, np.asarray(batch.column("label")))
        totals = sizes * (x * x).sum(axis=1, keepdims=True) + squares - 2.0 * (x @ sums.T)
        return pa.array(_widths(totals, sizes, own))

    made = map_vectors(usable, ["id", "label"], "vec", width, "s", DoubleType())
    return made.select(F.col("id").alias(row_id), F.col("label").alias(label), "s")


def _widths(totals, sizes, own):
    """Silhouette widths from summed distances (rows x clusters); 0 for singletons."""
    import numpy as np

    at = np.arange(len(totals))
    a = totals[at, own] / np.maximum(sizes[own] - 1.0, 1.0)
    means = totals / sizes
    means[at, own] = np.inf
    b = means.min(axis=1)
    top = np.maximum(a, b)
    with np.errstate(invalid="ignore", divide="ignore"):
        s = np.where(top > 0, (b - a) / top, 0.0)
    return np.where(sizes[own] > 1, s, 0.0)


def _distances(x, y):
    """Euclidean distances of all rows of x to all rows of y."""
    import numpy as np

    norms = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    squares = norms - 2.0 * (x @ y.T)
    # What rounding leaves of equal vectors is no distance.
    return np.sqrt(np.where(squares > 1e-14 * norms, squares, 0.0))


def silhouette_exact(
    rows: DataFrame, row_id: str, vec: str, label: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(row_id, label, s)`` under plain Euclidean distance, of every row.

    A row needs its mean distance to its own cluster and to the nearest other one.
    The mean distance to a cluster lies between the distance to its centroid and
    the root of that distance's square plus the cluster's variance, so clusters
    whose lower bound is above the least upper bound of all are never compared with
    the row, and nothing is lost. Clusters are dealt to tiles of at most about
    ``block_rows`` rows; a row goes once to each tile of its own cluster and of those
    left, and a tile returns one sum per row, never pairs. Where clusters are apart
    this is far from all pairs; where they overlap it is not, and the work grows
    with the square of the table.
    """
    import numpy as np

    usable = _labelled(rows, row_id, vec, label)
    names, sizes, sums, squares = _moments(usable)
    id_type = usable.schema["id"].dataType.simpleString()
    centres = sums / np.maximum(sizes, 1.0)[:, None]
    shift = sums.sum(axis=0) / max(1.0, sizes.sum()) if len(names) else np.zeros(0)
    variances = np.maximum(squares / np.maximum(sizes, 1.0) - (centres * centres).sum(axis=1), 0.0) if len(names) else np.zeros(0)
    tiles = np.maximum(1, np.ceil(sizes / block_rows)).astype(np.int64)
    first = np.cumsum(tiles) - tiles
    sent = rows.sparkSession.sparkContext.broadcast((names, sizes, centres - shift, variances, tiles, first, shift))
    schema = f"tile bigint, query boolean, id {id_type}, label int, other int, vec array<double>"

    def deal(batches):
        import pyarrow as pa

        names, sizes, centres, variances, tiles, first, shift = sent.value

        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                x = matrix_of(part.column(2)) - shift
                own = np.searchsorted(names, np.asarray(part.column(1)))
                gaps = _distances(x, centres)
                at = np.arange(len(x))
                upper = np.sqrt(gaps * gaps + variances)
                upper[at, own] = np.inf
                wanted = gaps <= upper.min(axis=1, keepdims=True) * (1 + 1e-9) + 1e-9
                wanted[at, own] = True
                # Singletons have no width to find.
                wanted[sizes[own] <= 1] = False
                # A cluster's rows are dealt to its tiles by a hash of their ids.
                home = first[own] + np.asarray(part.column(3)) % tiles[own]
                row, cluster = np.nonzero(wanted)
                times = tiles[cluster]
                row, cluster = np.repeat(row, times), np.repeat(cluster, times)
                to = first[cluster] + np.arange(len(cluster)) - np.repeat(np.cumsum(times) - times, times)
                for tile, of, other, query in ((home, at, own, False), (to, row, cluster, True)):
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(0, (len(of) + 1) * x.shape[1], x.shape[1], dtype=np.int32)), pa.array(x[of].ravel())
                    )
                    taken = pa.array(of)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tile), pa.array(np.full(len(of), query)), part.column(0).take(taken), part.column(1).take(taken), pa.array(names[other].astype(np.int32)), lists],
                        names=["tile", "query", "id", "label", "other", "vec"],
                    )

    def sums_of(batches):
        import pyarrow as pa

        now, data, ready = None, [], None
        for batch in batches:
            tile, query = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((np.diff(tile) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tile)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if tile[a] != now:
                    now, data, ready = tile[a], [], None
                if not query[a]:
                    data.append(matrix_of(part.column(5)))
                    continue
                if ready is None:
                    ready = np.concatenate(data)
                x = matrix_of(part.column(5))
                total = np.concatenate([_distances(x[k : k + SLICE_ROWS], ready).sum(axis=1) for k in range(0, len(x), SLICE_ROWS)])
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(3), part.column(4), pa.array(total)], names=["id", "label", "other", "total"])

    # The rows of a tile come before its queries. A tile without rows has no sums to give.
    hashed = usable.withColumn("hash", F.shiftrightunsigned(F.xxhash64("id"), 1))
    dealt = hashed.mapInArrow(deal, schema).repartition("tile").sortWithinPartitions("tile", "query")
    partial = dealt.mapInArrow(sums_of, f"id {id_type}, label int, other int, total double")
    totals = partial.groupBy("id", "label", "other").agg(F.sum("total").alias("total"))
    size_of = rows.sparkSession.createDataFrame([(int(c), float(n)) for c, n in zip(names, sizes)], "other int, n double")
    weighed = totals.join(F.broadcast(size_of), "other")
    own = F.col("other") == F.col("label")
    per_row = weighed.groupBy("id", "label").agg(
        F.max(F.when(own, F.col("total") / F.greatest(F.col("n") - 1, F.lit(1.0)))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    top = F.greatest("a", "b")
    s = F.coalesce(F.when(F.col("b").isNotNull() & (top > 0), (F.col("b") - F.col("a")) / top), F.lit(0.0))
    alone = usable.join(F.broadcast(size_of.where("n <= 1").withColumnRenamed("other", "label")), "label").select("id", "label", F.lit(0.0).alias("s"))
    return per_row.select("id", "label", s.alias("s")).unionByName(alone).select(F.col("id").alias(row_id), F.col("label").alias(label), "s")


def _scores_squared(usable: DataFrame, sets: list) -> list[tuple[float, float]]:
    """Mean squared-distance silhouette of all rows under each set of centroids."""
    import numpy as np

    sums = _sums(usable, sets)
    sent = usable.sparkSession.sparkContext.broadcast([(c, *s) for c, s in zip(sets, sums, strict=True)])

    def run(batches):
        import pyarrow as pa

        totals, n = np.zeros(len(sent.value)), 0
        for batch in batches:
            whole = matrix_of(batch.column(0))
            for a in range(0, len(whole), SLICE_ROWS):
                x = whole[a : a + SLICE_ROWS]
                norms = (x * x).sum(axis=1, keepdims=True)
                n += len(x)
                for k, (centres, counts, vectors, squares) in enumerate(sent.value):
                    full = counts > 0
                    if full.sum() > 1:
                        own = (np.cumsum(full) - 1)[_costs(x, centres).argmin(axis=1)]
                        sizes = counts[full].astype(np.float64)
                        totals[k] += _widths(sizes * norms + squares[full] - 2.0 * (x @ vectors[full].T), sizes, own).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(totals), dtype=np.int32)), pa.array(totals), pa.array(np.full(len(totals), n))], names=["k", "s", "n"])

    found = usable.select("vec").mapInArrow(run, "k int, s double, n bigint").groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    scores = {r["k"]: r["s"] / r["n"] for r in found.collect() if r["n"]}
    return [(scores.get(k, 0.0), 0.0) for k in range(len(sets))]


def _scores_euclid(usable: DataFrame, sets: list, seed: int, sample_rows: int) -> list[tuple[float, float]]:
    """Mean Euclidean silhouette and its standard error under each set of centroids.

    The rows of a sample (all rows of a small table) are compared with every row,
    so each width is exact and the work grows with the table, not with its
    square. Sums by cluster are taken for all sets at once.
    """
    import numpy as np

    rows = usable.count()
    sample = coreset(usable, seed, sample_rows)
    if not len(sample):
        return [(0.0, 0.0) for _ in sets]
    # Near the origin, rounding takes less from squared distances.
    shift = sample.mean(axis=0)
    counts = [c for c, _, _ in _sums(usable, sets)]
    sent = usable.sparkSession.sparkContext.broadcast((sample, shift, sets))
    groups = math.ceil(len(sample) / GROUP_ROWS)

    def run(batches):
        import pyarrow as pa

        sample, shift, sets = sent.value
        x = sample - shift
        totals = [np.zeros((groups * GROUP_ROWS, len(c))) for c in sets]
        for batch in batches:
            whole = matrix_of(batch.column(0))
            for a in range(0, len(whole), SLICE_ROWS):
                y = whole[a : a + SLICE_ROWS]
                gaps = _distances(y - shift, x)
                for c, total in zip(sets, totals, strict=True):
                    at = _costs(y, c).argmin(axis=1)
                    order = np.argsort(at, kind="stable")
                    names, first = np.unique(at[order], return_index=True)
                    total[: len(x), names] += np.add.reduceat(gaps[order], first, axis=0).T
        for k, total in enumerate(totals):
            flat = total.reshape(groups, -1)
            ends = np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(groups, k, np.int32)), pa.array(np.arange(groups, dtype=np.int32)), lists], names=["k", "g", "sums"])

    parts = usable.select("vec").mapInArrow(run, "k int, g int, sums array<double>")
    added = parts.groupBy("k", "g").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).select("k", "g", vector_to_array("sums").alias("sums"))
    own = [_costs(sample, c).argmin(axis=1) for c in sets]
    told = usable.sparkSession.sparkContext.broadcast((counts, own))

    def widths(batches):
        import pyarrow as pa

        counts, own = told.value
        for batch in batches:
            out = []
            for k, g, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                mine = own[k][g * GROUP_ROWS : (g + 1) * GROUP_ROWS]
                full = counts[k] > 0
                s = np.zeros(len(mine))
                if full.sum() > 1:
                    total = np.asarray(sums.values).reshape(GROUP_ROWS, -1)[: len(mine), full]
                    s = _widths(total, counts[k][full].astype(np.float64), (np.cumsum(full) - 1)[mine])
                out.append((k, float(s.sum()), float((s * s).sum())))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.float64())], names=["k", "s", "q"])

    found = added.mapInArrow(widths, "k int, s double, q double").groupBy("k").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    m, out = len(sample), [(0.0, 0.0)] * len(sets)
    for r in found.collect():
        mean = r["s"] / m
        spread = max(0.0, r["q"] / m - mean * mean) * m / max(1, m - 1)
        out[r["k"]] = (mean, math.sqrt(spread / m * (1 - m / rows)))
    return out


def k_sweep(
    rows: DataFrame, row_id: str, vec: str, ks=range(2, 100), seed: int = 0, exact: bool = False, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``(k, silhouette, error)`` for each number of clusters.

    All fits share their passes. With ``exact`` the silhouette is the plain Euclidean
    one: of all rows up to ``sample_rows`` (``error`` is 0), beyond that of as many
    rows, each against all rows, with the standard error of their mean. Otherwise
    it is the squared-distance one of all rows, which needs no pairs.
    """
    spark = rows.sparkSession
    ks = [int(k) for k in ks]
    with Reuse() as reuse:
        usable = reuse.keep(_usable(rows, row_id, vec))
        sets = fit(usable, ks, seed)
        if not sets or not len(sets[0]):
            scores = [(0.0, 0.0) for _ in ks]
        else:
            scores = _scores_euclid(usable, sets, seed, sample_rows) if exact else _scores_squared(usable, sets)
    return spark.createDataFrame([(k, float(s), float(e)) for k, (s, e) in zip(ks, scores, strict=True)], "k int, silhouette double, error double")


def best_k(sweep: DataFrame) -> DataFrame:
    return sweep.orderBy(F.desc("silhouette"), "k").limit(1)
