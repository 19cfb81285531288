"""Near-duplicate vectors by product quantisation.

Vectors are scaled to unit length, so that cosine ``c`` is distance
``sqrt(2 - 2c)``. Coarse centroids split them into inverted lists; the residual
to the centroid is cut into subspaces and each part replaced by the nearest of
256 code words. A query builds a table over all code words, and its distance to a
coded vector of a list it probes is a sum of look-ups (asymmetric: the query is
not coded).

What may be lost on the way is bounded:

* probes suffice. A vector ``y`` within ``r`` of query ``x`` lies in the cell of
  centroid ``c`` only if ``(y-x).(c-c0)`` makes up half of ``|x-c|^2 - |x-c0|^2``,
  where ``c0`` is the query's own centroid. That product is at most ``r |c-c0|``,
  and ``|x-c|`` is at most ``r`` beyond the farthest vector of the list. Every
  list within both bounds is probed and no link can be missed. ``deviations``
  narrows the first bound to that many standard deviations of the product over
  directions of ``y-x``, and then links are missed; no query uses it.
* the coded distance may be off by the vector's coding error ``e``, which is
  stored with the code. Candidates with coded distance above ``r + e`` are out;
  the rest are compared by exact cosine in double precision.

With ``y = c + w`` for a list's centroid and a code's words, and ``|x| = 1``, the squared
distance is ``1 + |y|^2 - 2 x.c - 2 x.w``. So a query's table holds its products with
every code word, one row per subspace, and serves all lists: a look-up per subspace
and one for the centroid add up to the distance, and ``|y|^2`` is stored with the code.
No code is decoded.

Centroids and code words are fitted on a bounded sample of the vectors; every
vector is in the index. Equal vectors are one class with a count. Neighbouring
lists share a group of at most ``block`` vectors, and longer lists are dealt over
several groups. A query goes once to each group that holds a list it probes and is
compared with those lists alone; of two groups only one sends its queries to the
other, so that each pair meets once. A task returns link counts per class and the
edges of a spanning forest, not pairs.

Vectors of different lengths have no cosine and never link. Each of the commonest
lengths has an index of its own; those of few vectors, and any beyond ``INDEXES``
lengths, are compared exactly, chunk by chunk.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing. Repeated ids stay as rows. Null ids are rows that link and count,
but never name a component. Very long vectors are one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leadrank.llm.components import connected_components
from leadrank.llm.shared import share, stored

SAMPLE_ROWS = 16_384
SUBSPACES, WORDS = 16, 256
#: Vectors of a group at most.
BLOCK = 2048
#: Queries of a record batch at most, and queries that are looked up at once.
QUERIES, STEP = 8192, 256
#: Vectors of a length below which no index is fitted.
FEW = 256
#: Lengths that have an index at most.
INDEXES = 32
#: What rounding may take from a bound; tables are single precision.
SLACK, TABLE_SLACK = 1e-6, 1e-5


def valid(vector: Column) -> Column:
    """Whether a vector can link: present, finite throughout and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Quantiser:
    """Coarse centroids (lists by dims) and code words (subspaces by words by width)."""

    centroids: np.ndarray
    codebook: np.ndarray
    dimension: float = 1.0

    @property
    def dims(self) -> int:
        return self.centroids.shape[1]

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Vectors padded and cut into subspaces."""
        n, width = len(self.codebook), self.codebook.shape[2]
        full = np.zeros((len(x), n * width))
        full[:, : x.shape[1]] = x
        return full.reshape(len(x), n, width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, code, coding error and squared norm of the coded vector, for each vector."""
        lists = distances(x, self.centroids).argmin(axis=1)
        centre = self.parts(self.centroids[lists])
        cut = self.parts(x) - centre
        codes = np.empty(cut.shape[:2], np.uint8)
        error, norm = np.zeros(len(x)), np.zeros(len(x))
        for j, words in enumerate(self.codebook):
            d = distances(cut[:, j], words)
            codes[:, j] = d.argmin(axis=1)
            word = words[codes[:, j]]
            error += ((cut[:, j] - word) ** 2).sum(axis=1)
            norm += ((centre[:, j] + word) ** 2).sum(axis=1)
        return lists, codes, np.sqrt(error), norm

    def tables(self, x: np.ndarray) -> np.ndarray:
        """Products of each query with every code word: subspaces by words by queries, in single precision."""
        cut = self.parts(x)
        return np.stack([words @ cut[:, j].T for j, words in enumerate(self.codebook)]).astype(np.float32)

    @staticmethod
    def looked_up(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Products of queries with the words that codes stand for: one look-up per subspace, added up.

        A look-up takes a word's row, the products of all queries with it.
        """
        total = tables[0].take(codes[:, 0], axis=0)
        row = np.empty_like(total)
        for j in range(1, codes.shape[1]):
            total += tables[j].take(codes[:, j], axis=0, out=row, mode="clip")
        return total.T

    def probes(
        self, x: np.ndarray, radius: float, deviations: float | None = None, reach: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list that may hold a vector within the radius.

        ``reach`` is the distance of each list's farthest vector to its centroid.
        """
        return np.nonzero(self.wanted(x, np.arange(len(self.centroids)), radius, deviations, reach))

    def wanted(
        self, x: np.ndarray, lists: np.ndarray, radius: float, deviations: float | None = None, reach: np.ndarray | None = None, own: np.ndarray | None = None
    ) -> np.ndarray:
        """Whether each query probes each of these lists; ``own`` are the queries' own lists, if known."""
        if own is None:
            own = distances(x, self.centroids).argmin(axis=1)
        d = distances(x, self.centroids[lists])
        nearest = ((x - self.centroids[own]) ** 2).sum(axis=1)
        apart = np.sqrt(distances(self.centroids[own], self.centroids[lists]))
        part = 1.0 if deviations is None else min(1.0, deviations / np.sqrt(self.dimension))
        may = d - nearest[:, None] <= 2 * part * (radius + SLACK) * apart + SLACK
        if reach is not None:
            may &= np.sqrt(d) <= radius + reach[lists][None, :] + SLACK
        return may

    def coded(self, x: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Distances from each query to each coded vector of a list."""
        c = self.centroids[number]
        words = np.stack([w[codes[:, j]] for j, w in enumerate(self.codebook)], axis=1)
        norm = ((self.parts(c[None, :]) + words) ** 2).sum(axis=(1, 2))
        products = (x @ c)[:, None] + self.looked_up(self.tables(x), codes)
        return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + norm[None, :] - 2 * products, 0))


@dataclass
class Layout:
    """Where the vectors of each list lie: ``count`` groups from ``first`` on."""

    first: np.ndarray
    count: np.ndarray
    reach: np.ndarray

    @property
    def groups(self) -> int:
        return int((self.first + self.count).max())

    def homes(self, ids: np.ndarray, lists: np.ndarray) -> np.ndarray:
        return self.first[lists] + ids * 2654435761 % (1 << 31) % self.count[lists]

    def visits(self, home: np.ndarray, row: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, group) once for each group that a row's probes lead to and that is not to come to the row's own."""
        times = self.count[where]
        row, group = np.repeat(row, times), np.repeat(self.first[where], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        row, group = np.divmod(np.unique(row.astype(np.int64) * self.groups + group), self.groups)
        mine = home[row]
        go = (mine == group) | ((mine < group) == ((mine + group) % 2 == 1))
        return row[go], group[go]


def lay_out(model: Quantiser, sizes: dict[int, tuple[int, float]], block: int) -> Layout:
    """Groups of at most ``block`` vectors, as far as equal shares go, from size and reach of each list."""
    n = len(model.centroids)
    first, count, reach = np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, -np.inf)
    # Lists that are near each other share groups.
    region = distances(model.centroids, k_means(model.centroids, max(1, int(np.sqrt(n))))).argmin(axis=1)
    group, held = -1, block
    for number in np.argsort(region, kind="stable").tolist():
        size, reach[number] = sizes.get(number, (0, -np.inf))
        if held + size > block:
            group, held = group + 1, 0
        first[number], count[number] = group, max(1, -(-size // block))
        group, held = group + int(count[number]) - 1, held + size if count[number] == 1 else block
    return Layout(first, count, reach)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)[None, :], 0)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        of = distances(x, centres).argmin(axis=1)
        counts = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def fit(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, words: int = WORDS) -> Quantiser:
    centroids = k_means(sample, max(1, lists))
    width = -(-sample.shape[1] // subspaces)
    made = Quantiser(centroids, np.zeros((subspaces, 1, width)))
    cut = made.parts(sample - centroids[distances(sample, centroids).argmin(axis=1)])
    books = [k_means(cut[:, j], words) for j in range(subspaces)]
    size = max(len(b) for b in books)
    spread = np.linalg.eigvalsh(np.cov(sample.T)) if len(sample) > 1 and sample.shape[1] > 1 else np.ones(1)
    made.dimension = float(max(1.0, spread.sum() ** 2 / max((spread**2).sum(), 1e-300)))
    made.codebook = np.stack([np.concatenate([b, np.repeat(b[:1], size - len(b), axis=0)]) for b in books])
    return made


def rows_of(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, against overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


RESULT = pa.schema([("id", pa.int64()), ("n_links", pa.int64()), ("other", pa.int64())])
RESULT_DDL = "id bigint, n_links bigint, other bigint"


def told(q_ids: np.ndarray, q_counts: np.ndarray, ids: np.ndarray, counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch | None:
    """Link counts and forest edges of the links between queries ``i`` and data ``j``."""
    if not len(i):
        return None
    # Equal ids are one node.
    nodes, place = np.unique(np.concatenate([q_ids, ids]), return_inverse=True)
    up = np.arange(len(nodes))

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return int(k)

    ends = []
    for p, q in zip(place[i].tolist(), place[len(q_ids) + j].tolist(), strict=True):
        u, v = find(p), find(q)
        if u != v:
            up[max(u, v)] = min(u, v)
            ends.append((nodes[p], nodes[q]))
    of_query = np.bincount(i, weights=counts[j], minlength=len(q_ids)).astype(np.int64)
    of_data = np.bincount(j, weights=q_counts[i], minlength=len(ids)).astype(np.int64)
    out_ids = np.concatenate([q_ids[of_query > 0], ids[of_data > 0], np.array([e[0] for e in ends], np.int64)])
    sums = np.concatenate([of_query[of_query > 0], of_data[of_data > 0], np.zeros(len(ends), np.int64)])
    other = pa.array([None] * (len(sums) - len(ends)) + [int(e[1]) for e in ends], pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(out_ids), pa.array(sums), other], schema=RESULT)


def links(classes: DataFrame, model: Quantiser, least: float, layout: Layout, deviations: float | None = None) -> DataFrame:
    """From ``(id, vec, n)`` classes of one length: ``(id, n_links, other)`` rows.

    ``n_links`` adds up to the number of vectors in linked classes; ``other``, where
    present, is the end of a forest edge.
    """
    radius = float(np.sqrt(2 - 2 * least))
    # Arrays and numbers only, so that workers need not have this package.
    sent = classes.sparkSession.sparkContext.broadcast(((model.centroids, model.codebook, model.dimension), (layout.first, layout.count, layout.reach)))
    entry = "group int, is_query boolean, home int, list int, id bigint, n bigint, vec array<double>, code binary, error double, norm double"
    schema = pa.schema(
        [("group", pa.int32()), ("is_query", pa.bool_()), ("home", pa.int32()), ("list", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("vec", pa.list_(pa.float64())), ("code", pa.binary()), ("error", pa.float64()), ("norm", pa.float64())]
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, layout = Quantiser(*sent.value[0]), Layout(*sent.value[1])
        for rows in batches:
            for a in range(0, rows.num_rows, 1024):
                part = rows.slice(a, 1024)
                ids, counts = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                x = unit(rows_of(part.column(2), model.dims))
                lists, codes, error, norm = model.encode(x)
                home = layout.homes(ids, lists)

                def out(row: np.ndarray, group: np.ndarray, query: bool) -> pa.RecordBatch:
                    m = len(row)
                    ends = pa.array(np.arange(0, (m + 1) * model.dims, model.dims, dtype=np.int32))
                    return pa.RecordBatch.from_arrays(
                        [
                            pa.array(group.astype(np.int32)), pa.array(np.full(m, query)), pa.array(home[row].astype(np.int32)), pa.array(lists[row].astype(np.int32)),
                            pa.array(ids[row]), pa.array(counts[row]), pa.ListArray.from_arrays(ends, pa.array(x[row].reshape(-1))),
                            pa.array([None] * m if query else [codes[r].tobytes() for r in row.tolist()], pa.binary()),
                            pa.array(np.zeros(m) if query else error[row]), pa.array(np.zeros(m) if query else norm[row]),
                        ],
                        schema=schema,
                    )

                yield out(np.arange(len(x)), home, False)
                row, group = layout.visits(home, *model.probes(x, radius, deviations, layout.reach))
                for b in range(0, len(row), QUERIES):
                    yield out(row[b : b + QUERIES], group[b : b + QUERIES], True)

    made = classes.select("id", "n", "vec").mapInArrow(index, entry)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, layout = Quantiser(*sent.value[0]), Layout(*sent.value[1])

        def held(data: list[pa.RecordBatch]) -> tuple:
            """Of a group: vectors, ids, counts, codes, the least product with a query that may be linked, and the lists' numbers."""
            table = pa.Table.from_batches(data).combine_chunks()
            lists, ids, counts, error, norm = (table.column(k).to_numpy() for k in (3, 4, 5, 8, 9))
            codes = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint8).reshape(len(ids), -1)
            # |x-y|^2 = 1 + |y|^2 - 2xy for queries of length one.
            product = (1 + norm - (radius + error + SLACK) ** 2) / 2 - TABLE_SLACK
            names, number = np.unique(lists, return_inverse=True)
            return rows_of(table.column(6).combine_chunks(), model.dims), ids, counts, codes, product.astype(np.float32), names, number

        def step(group: int, data: tuple, asked: pa.RecordBatch) -> pa.RecordBatch | None:
            """Queries of one batch against the group's data."""
            y, ids, counts, codes, product, names, number = data
            home, own, q_ids, q_counts = (asked.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            x = rows_of(asked.column(6), model.dims)
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for a in range(0, len(x), STEP):
                part = x[a : a + STEP]
                tables = model.tables(part)
                centre = (part @ model.centroids[names].T).astype(np.float32)
                probed = model.wanted(part, names, radius, deviations, layout.reach, own[a : a + STEP])
                # What a list that is not probed holds is out of reach.
                centre[~probed] = -np.inf
                centre = np.ascontiguousarray(centre.T)
                some = probed.any(axis=0)
                for start in range(0, len(y), STEP):
                    of = number[start : start + STEP]
                    if not some[of].any():
                        continue
                    products = model.looked_up(tables, codes[start : start + STEP])
                    j, i = np.nonzero(products.T + centre[of] >= product[start : start + STEP, None])
                    i, j = a + i, start + j
                    # Within the group each pair comes up twice.
                    once = (home[i] != group) | (q_ids[i] < ids[j])
                    i, j = i[once], j[once]
                    linked = np.einsum("ij,ij->i", x[i], y[j]) >= least
                    left.append(i[linked])
                    right.append(j[linked])
            return told(q_ids, q_counts, ids, counts, np.concatenate(left), np.concatenate(right))

        now, data, ready = None, [], None
        for rows in batches:
            groups, query = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)], strict=True):
                if a == b:
                    continue
                if groups[a] != now:
                    now, data, ready = groups[a], [], None
                if not query[a]:
                    data.append(rows.slice(a, b - a))
                elif data:
                    ready = ready or held(data)
                    if (out := step(int(now), ready, rows.slice(a, b - a))) is not None:
                        yield out

    # The data of a group come before its queries, list by list.
    spread = made.repartition("group").sortWithinPartitions("group", "is_query", "list")
    return spread.mapInArrow(search, RESULT_DDL)


def exact_links(classes: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """``links`` of ``(id, n, vec)`` classes of any lengths, by exact cosine within each length, chunk by chunk."""
    sizes = classes.groupBy(F.size("vec").alias("d")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("chunks"))
    dealt = classes.withColumn("d", F.size("vec")).join(sizes, "d").withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, F.col("own")).alias("c1"), F.greatest(c, F.col("own")).alias("c2"))
    )
    pairs = dealt.withColumn("m", F.explode(meets)).select("d", "m.c1", "m.c2", "own", "id", "n", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            table = pa.Table.from_batches(parts).combine_chunks()
            d, c1, c2 = (table.column(k)[0].as_py() for k in range(3))
            own, ids, counts = (table.column(k).to_numpy() for k in (3, 4, 5))
            x = unit(rows_of(table.column(6).combine_chunks(), d))
            left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for a in range(0, len(x), STEP):
                i, j = np.nonzero(x[a : a + STEP] @ x.T >= least - SLACK)
                i = a + i
                # Pairs within one chunk where it meets itself, and pairs of two chunks where these meet.
                keep = (i < j) & ((own[i] != own[j]) if c1 != c2 else True)
                i, j = i[keep], j[keep]
                linked = np.einsum("ij,ij->i", x[i], x[j]) >= least
                left.append(i[linked])
                right.append(j[linked])
            return told(ids, counts, ids, counts, np.concatenate(left), np.concatenate(right))

        held: list[pa.RecordBatch] = []
        now = None
        for rows in batches:
            keys = np.stack([rows.column(k).to_numpy(zero_copy_only=False) for k in range(3)], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if a == b:
                    continue
                if tuple(keys[a]) != now:
                    if held and (out := compared(held)) is not None:
                        yield out
                    now, held = tuple(keys[a]), []
                held.append(rows.slice(a, b - a))
        if held and (out := compared(held)) is not None:
            yield out

    spread = pairs.repartition("d", "c1", "c2").sortWithinPartitions("d", "c1", "c2")
    return spread.mapInArrow(run, RESULT_DDL)


def _indexed(classes: DataFrame, dims: int, total: int, least: float, lists: int | None, block: int, sample_rows: int, deviations: float | None) -> DataFrame:
    """``links`` of classes of one length, through an index fitted on a sample of them."""
    spark = classes.sparkSession
    sample = classes.where(share(F.col("vec"), "vectors") < F.lit(sample_rows / total)).orderBy("id").limit(2 * sample_rows)
    taken = sample.select("vec").toArrow().column("vec").combine_chunks()
    if not len(taken):
        taken = classes.limit(sample_rows).select("vec").toArrow().column("vec").combine_chunks()
    model = fit(unit(rows_of(taken, dims)), lists or min(4096, max(1, int(4 * np.sqrt(total)))))
    sent = spark.sparkContext.broadcast(model.centroids)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for a in range(0, part.num_rows, 1024):
                d = distances(unit(rows_of(part.column(0).slice(a, 1024), dims)), sent.value)
                yield pa.RecordBatch.from_arrays([pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(np.sqrt(d.min(axis=1)))], names=["list", "far"])

    # One row per list, 4,096 at most.
    sizes = classes.select("vec").mapInArrow(listed, "list int, far double").groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"))
    layout = lay_out(model, {r["list"]: (r["n"], r["far"]) for r in sizes.collect()}, block)
    return links(classes, model, least, layout, deviations)


def near_duplicates(
    vectors: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding", lists: int | None = None, block: int = BLOCK, sample_rows: int = SAMPLE_ROWS,
    deviations: float | None = None, indexes: int = INDEXES,
) -> DataFrame:
    """``(key, n_links, component_id)`` of every row.

    ``n_links`` counts the other vectors at cosine ``least`` or more;
    ``component_id`` is the smallest key that links reach, the row's own included.
    ``lists`` defaults to four times the square root of the number of classes, up to 4,096.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    # Zero has one form, so that equal vectors are equal arrays.
    clean = F.transform("vec", lambda x: x + F.lit(0.0))
    good = rows.where(valid(F.col("vec"))).select("id", clean.alias("vec"))
    classes = good.groupBy("vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    # Numbered in the stored table, as a repeated key may be in several classes.
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    lengths = classes.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min(block, FEW))
    large = {r["d"]: r["n"] for r in lengths.orderBy(F.desc("n"), "d").limit(indexes).collect()}
    parts = [_indexed(classes.where(F.size("vec") == d), d, n, least, lists, block, sample_rows, deviations) for d, n in large.items()]
    others = classes.where(~F.size("vec").isin(list(large))) if large else classes
    found = reduce(DataFrame.unionAll, [*parts, exact_links(others, least, block)])
    found = stored(found, "vector-links")
    counts = found.groupBy("id").agg(F.sum("n_links").alias("linked"))
    roots = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    member = classes.join(roots, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = member.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = member.join(named, "component").join(counts, "id", "left")
    of_class = of_class.select("vec", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = good.join(of_class, "vec").select("id", "n_links", "component_id")
    alone = rows.where(~valid(F.col("vec"))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).withColumnRenamed("id", key)
