import numpy as np
import pytest

from leadrank.llm import quantised
from leadrank.llm.queries import all_queries


def brute(rows, least=0.95):
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {k: (0, i) for k, (i, _) in enumerate(rows)}
    every = good
    for size in {len(rows[k][1]) for k in every}:
        good = [k for k in every if len(rows[k][1]) == size]
        u = np.array([rows[k][1] for k in good])
        u /= np.linalg.norm(u, axis=1)[:, None]
        near = u @ u.T >= least
        np.fill_diagonal(near, True)
        label = np.array([rows[k][0] for k in good])
        while True:
            new = np.where(near, label[None, :], 10**9).min(axis=1)
            if (new == label).all():
                break
            label = new
        out |= {k: (int(near[a].sum()) - 1, int(label[a])) for a, k in enumerate(good)}
    return sorted((rows[k][0], *out[k]) for k in range(len(rows)))


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], "vec_id long, embedding array<float>, id string, n int, vec int")
    return sorted(map(tuple, quantised.near_duplicates(df, **more).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 24))
    out = []
    for i in range(600):
        v = centres[rng.integers(30)] + rng.normal(size=24) * rng.choice([0, 0.1, 0.25, 0.4])
        out.append((i, (v * rng.choice([1, 3])).tolist()))
    odd = [None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [1.0, 2.0], [float("inf")] + [0.0] * 23]
    out += [(1000 + k, v) for k, v in enumerate(odd)]
    return [*out, (2000, out[0][1]), (2000, out[0][1]), (5, out[77][1])]


@pytest.mark.parametrize("more", [{}, {"block": 16, "lists": 5}, {"lists": 300}])
def test_links_and_components(spark, rows, more):
    assert got(spark, rows, deviations=None, **more) == brute(rows)


def test_recall_of_the_default_probes(spark, rows):
    have, want = ({r[0]: r[1] for r in x} for x in (got(spark, rows), brute(rows)))
    assert all(have[i] <= n for i, n in want.items())
    assert sum(have.values()) >= 0.98 * sum(want.values())


def test_nothing_to_link(spark, rows):
    for part in (rows[600:607], [], rows[:1]):
        assert got(spark, part, deviations=None) == brute(part)


def test_probes_and_coded_distances_suffice(rows):
    x = quantised.unit(np.array([v for _, v in rows[:600]]))
    model = quantised.fit(x[:200], 20)
    lists, codes, error, norm = model.encode(x)
    radius = np.sqrt(0.1)
    i, j = np.nonzero(x @ x.T >= 0.95)
    probed = set(zip(*(a.tolist() for a in model.probes(x, radius))))
    assert all((a, lists[b]) in probed for a, b in zip(i.tolist(), j.tolist()))
    for number in range(20):
        of = np.flatnonzero(lists == number)
        coded = model.coded(x, number, codes[of])
        true = np.sqrt(quantised.distances(x, x[of]))
        # Tables are single precision, so squares may be off by what a bound leaves for that.
        slack, e = quantised.TABLE_SLACK, error[of][None, :]
        assert (coded**2 <= (true + e) ** 2 + slack).all() and (coded**2 >= np.maximum(true - e, 0) ** 2 - slack).all()


def test_tables_hold_the_products_of_codes(rows):
    x = quantised.unit(np.array([v for _, v in rows[:300]]))
    model = quantised.fit(x[:200], 9)
    lists, codes, error, norm = model.encode(x)
    words = np.stack([w[codes[:, j]] for j, w in enumerate(model.codebook)], axis=1).reshape(len(x), -1)[:, :24]
    coded = model.centroids[lists] + words
    assert np.allclose(norm, (coded**2).sum(axis=1)) and np.allclose(error, np.linalg.norm(x - coded, axis=1))
    assert np.allclose(model.looked_up(model.tables(x[:7]), codes), x[:7] @ words.T, atol=1e-6)


@pytest.mark.parametrize("more", [{}, {"indexes": 1}, {"indexes": 0}, {"indexes": 0, "block": 40}, {"block": 40, "lists": 6}])
def test_mixed_lengths(spark, more):
    rng = np.random.default_rng(8)
    out = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0, 2.0, 0.0]), (4, [1.0]), (5, [3.0]), (6, [-1.0])]
    for d, n in ((3, 330), (24, 300), (5, 90)):
        centres = rng.normal(size=(12, d))
        out += [(100 * d + k, (centres[rng.integers(12)] + 0.1 * rng.normal(size=d)).tolist()) for k in range(n)]
    have = got(spark, out, **more)
    assert have == brute(out)
    assert have[:3] == [(1, 1, 1), (2, 1, 1), (3, have[2][1], have[2][2])]


def test_visits_are_those_of_all_probes():
    layout = quantised.Layout(np.array([0, 0, 1, 4]), np.array([1, 1, 3, 2]), np.zeros(4))
    row, group = layout.visits(np.array([0, 2, 5]), np.array([0, 0, 1, 1, 2]), np.array([0, 2, 1, 3, 2]))
    want = set()
    for r, probes in enumerate(([0, 2], [1, 3], [2])):
        mine = [0, 2, 5][r]
        for g in {g for p in probes for g in range(layout.first[p], layout.first[p] + layout.count[p])}:
            if mine == g or (mine < g) == ((mine + g) % 2 == 1):
                want.add((r, g))
    assert set(zip(row.tolist(), group.tolist())) == want and len(row) == len(want)


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = all_queries()["op1_quantised"](spark, sf).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_default_probes_lose_no_link_of_groups_in_few_directions(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(8):
        centre, plane = rng.normal(size=64), np.linalg.qr(rng.normal(size=(64, 4)))[0]
        centre /= np.linalg.norm(centre)
        for k in range(150):
            rows.append((150 * g + k, (centre + 0.12 * plane @ rng.normal(size=4)).tolist()))
    rows += [(2000 + k, rng.normal(size=64).tolist()) for k in range(400)]
    want = brute(rows)
    assert sum(n for _, n, _ in want) > 10_000
    assert got(spark, rows) == want
