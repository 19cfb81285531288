import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadrank import fixtures as X
from leadrank.functions import vectors as V
from leadrank.functions.vectors import hash_vector
from leadrank.operators import clusters, embedding, keys as key_tables, similarity
from leadrank.operators.similarity import Dense, HashedText
from leadrank.plans import clustering, relevance
from leadrank.sources import vector_cache
from leadrank.sources.keywords import keyword_table

DENSE = Dense("vec")


def vecs(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, vec array<double>")


def keys(spark, rows):
    return spark.createDataFrame(
        [(f"k{i}", float(i + 1), [float(x) for x in v]) for i, v in enumerate(rows)],
        "name string, weight double, vec array<double>",
    )


@pytest.mark.parametrize(
    "mode, equal, orthogonal",
    [("cosine", 1, 0), ("euclid", 0, 2**0.5), ("mult", 0, 2**0.5 / 2), ("legacy_mult", 0, 0), ("add", 1, 0.25 + 0.5 / (1 + 2**0.5))],
)
def test_similarity_modes(spark, mode, equal, orthogonal):
    rows = similarity.similarity_rows(vecs(spark, [[3, 0], [0, 2]]), "id", keys(spark, [[1, 0]]), DENSE, mode)
    got = {r.id: r.sim for r in rows.collect()}
    assert got == {0: pytest.approx(equal), 1: pytest.approx(orthogonal)}
    column = spark.range(1).select(V.similarity(F.lit(1.0), mode).alias("e"), V.similarity(F.lit(0.0), mode).alias("o")).first()
    assert tuple(column) == (pytest.approx(equal), pytest.approx(orthogonal))


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown similarity mode"):
        V.similarity(F.lit(1.0), "other")


def brute_scores(x, k, w):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    k = k / np.linalg.norm(k, axis=1, keepdims=True)
    dist = np.sqrt(((x[:, None, :] - k[None, :, :]) ** 2).sum(axis=2))
    sim = dist * (1 + x @ k.T) / 2
    return (sim * np.log(len(x) / sim.sum(axis=0)) * w).sum(axis=1)


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    return rng.normal(size=(200, 8)), rng.normal(size=(7, 8))


@pytest.mark.parametrize("blocked", [False, True])
def test_soft_scores(spark, cloud, monkeypatch, blocked):
    x, k = cloud
    if blocked:
        monkeypatch.setattr(key_tables, "MAX_KEY_BYTES", 300)
    groups = {"a": keys(spark, k[:4]), "b": keys(spark, k[4:])}
    got = similarity.soft_scores(vecs(spark, x), "id", groups, DENSE, carry={"twice": F.col("id") * 2}).orderBy("id").collect()
    assert [r.twice for r in got] == [2 * i for i in range(200)]
    assert [r.a for r in got] == pytest.approx(brute_scores(x, k[:4], np.arange(1, 5)))
    assert [r.b for r in got] == pytest.approx(brute_scores(x, k[4:], np.arange(1, 4)))


def test_scores_do_not_depend_on_partitions(spark, cloud):
    x, k = cloud
    run = lambda df: [r.score for r in similarity.soft_scores(df, "id", {"score": keys(spark, k)}, DENSE).orderBy("id").collect()]
    assert run(vecs(spark, x).repartition(1)) == pytest.approx(run(vecs(spark, x).repartition(13)))


@pytest.mark.parametrize("blocked", [False, True])
def test_best_key(spark, cloud, monkeypatch, blocked):
    x, k = cloud
    if blocked:
        monkeypatch.setattr(key_tables, "MAX_KEY_BYTES", 300)
    got = similarity.best_key(vecs(spark, x), "id", keys(spark, k), DENSE, "cosine").orderBy("id").collect()
    cos = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (k / np.linalg.norm(k, axis=1, keepdims=True)).T
    assert [r.name for r in got] == [f"k{i}" for i in cos.argmax(axis=1)]
    assert [r.sim for r in got] == pytest.approx(cos.max(axis=1))


@pytest.mark.parametrize("limit", [150, 400, 1 << 20])
def test_key_tables_in_tiles_give_the_same(spark, cloud, monkeypatch, limit):
    x, k = cloud
    table = keys(spark, np.concatenate([k, k, -k]))
    sims = lambda: sorted(map(tuple, similarity.similarity_rows(vecs(spark, x), "id", table, DENSE, "cosine").collect()))
    best = lambda: sorted(map(tuple, similarity.best_key(vecs(spark, x), "id", table, DENSE, "cosine").collect()))
    want = sims(), best()
    monkeypatch.setattr(key_tables, "MAX_KEY_BYTES", limit)
    assert (len(key_tables.key_tables(table)) > 1) == (limit < 1 << 20)
    got = sims(), best()
    for a, b in zip(want, got):
        assert [r[:2] for r in a] == [r[:2] for r in b]
        assert [r[2] for r in a] == pytest.approx([r[2] for r in b])


def test_no_keys(spark, cloud):
    none = keys(spark, cloud[1]).limit(0)
    assert similarity.similarity_rows(vecs(spark, cloud[0]), "id", none, DENSE).collect() == []
    assert {(r.name, r.sim) for r in similarity.best_key(vecs(spark, cloud[0]), "id", none, DENSE).collect()} == {(None, None)}


def test_best_key_tie_goes_to_the_first(spark):
    got = similarity.best_key(vecs(spark, [[1, 0]]), "id", keys(spark, [[2, 0], [1, 0]]), DENSE, "cosine").first()
    assert got.name == "k0"


def test_no_positive_sum_gives_no_idf(spark):
    rows = similarity.soft_idf_table(vecs(spark, [[1, 0], [1, 0]]), "id", keys(spark, [[1, 0], [0, 1]]), DENSE)
    got = {r.name: r.idf for r in rows.collect()}
    assert got["k0"] is None and got["k1"] is not None


def test_zero_and_null_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, [1.0, 1.0])], "id long, vec array<double>")
    got = {r.id: r.sim for r in similarity.similarity_rows(df, "id", keys(spark, [[1, 0]]), DENSE, "cosine").collect()}
    assert got == {1: None, 2: None, 3: pytest.approx(2**-0.5)}


def test_unequal_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0])], "id long, vec array<double>")
    with pytest.raises(Exception, match="unequal length"):
        similarity.similarity_rows(df.coalesce(1), "id", keys(spark, [[1, 0]]), DENSE, "cosine").collect()


@pytest.mark.parametrize("blocked", [False, True])
def test_rows_without_a_vector_stay_and_count(spark, monkeypatch, blocked):
    if blocked:
        monkeypatch.setattr(key_tables, "MAX_KEY_BYTES", 100)
    df = spark.createDataFrame([(1, "a b"), (2, " .!"), (3, None), (4, "b c")], "id long, t string")
    phrases = embedding.phrase_vectors(spark.createDataFrame([("b", 2.0)], "name string, weight double"), 64)
    shape = HashedText("t", 64)
    got = {r.id: r.s for r in similarity.soft_scores(df, "id", {"s": phrases}, shape, "cosine").collect()}
    both = 2**-0.5
    # The idf counts all four rows.
    assert got == {1: pytest.approx(2 * both * np.log(4 / (2 * both))), 2: None, 3: None, 4: got[1]}
    ranked = relevance.text_rank(df, "id", "t", spark.createDataFrame([("b", 2.0)], "name string, weight double"), dims=64)
    assert sorted((r.rank, r.score is None) for r in ranked.collect()) == [(1, False), (2, False), (3, True), (4, True)]


def test_many_long_keys_are_planned_quickly(spark):
    import time

    docs = spark.range(200).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.concat(F.lit("w"), (F.col("id") * 7 + i) % 300))).alias("t"))
    phrases = spark.range(200).select(
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(49)), lambda i: F.concat(F.lit("w"), (F.col("id") * 3 + i) % 400))).alias("name"), F.lit(1.0).alias("weight")
    )
    terms = embedding.phrase_vectors(phrases, 2**16)
    terms.count()
    start = time.perf_counter()
    similarity.soft_scores(docs, "id", {"s": terms}, HashedText("t", 2**16), weighting="none")._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 10
    best = similarity.best_key(docs, "id", terms, HashedText("t", 2**16), "cosine")
    assert best.where("name is not null").count() == 200


def test_position_decides_ties(spark):
    table = keys(spark, [[1, 0], [2, 0]]).withColumn("pos", F.when(F.col("name") == "k0", 1).otherwise(0))
    assert similarity.best_key(vecs(spark, [[1, 0]]), "id", table, DENSE, "cosine").first().name == "k1"


@pytest.mark.parametrize("blocked", [False, True])
def test_hashed_text_equals_dense_vectors(spark, sf, monkeypatch, blocked):
    docs = X.companies(spark, sf)
    phrases = embedding.phrase_vectors(X.phrases(spark), 64)
    got = similarity.soft_scores(docs, "company_id", {"s": phrases}, HashedText("Description", 64))

    def dense(df):
        at = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.get(F.filter("terms", lambda t: t.dim == i), F.lit(0)).v, F.lit(0.0)))
        return df.withColumn("vec", at)

    wide = dense(embedding.hashed_terms(docs, "company_id", "Description", 64))
    want = similarity.soft_scores(wide, "company_id", {"s": dense(phrases).drop("terms")}, DENSE)
    want = {r.company_id: r.s for r in want.collect()}
    if blocked:
        monkeypatch.setattr(key_tables, "MAX_KEY_BYTES", 300)
        got = similarity.soft_scores(docs, "company_id", {"s": phrases}, HashedText("Description", 64))
    got = {r.company_id: r.s for r in got.collect()}
    assert got == pytest.approx(want)


def test_texts_without_words_have_no_vector(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, " .!"), (3, None)], "id long, t string")
    assert [r.id for r in embedding.hashed_terms(df, "id", "t").collect()] == [1]
    counts = {r.v for r in embedding.hashed_terms_long(df, "id", "t", normalize=False).collect()}
    assert counts == {1.0, 2.0}


def test_sector_phrases_and_text_rank(spark, sf):
    sectors = relevance.sector_phrases(X.sector_text(spark), "sector")
    assert sorted(r.name for r in sectors.collect()) == ["Thatin of the.", "Worthless ononst?", "and the tion."]
    none = relevance.text_rank(X.companies(spark, sf), "company_id", "Description", X.phrases(spark)).collect()
    assert all(r.sector_score is None for r in none)
    assert min(r.score for r in none) == 0.0 and max(r.score for r in none) == 1.0
    assert sorted(r.rank for r in none) == list(range(1, len(none) + 1))


def test_mean_pool(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0], 1), (1, [3.0, 6.0], 1), (1, [9.0, 9.0], 0), (2, [5.0, 5.0], 0)], "id long, vec array<double>, m int"
    )
    assert {r.id: list(r.vec) for r in embedding.mean_pool(df, "id", "vec", "m").collect()} == {1: [2.0, 4.0], 2: [0.0, 0.0]}


def test_user_model(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(1, 6)], "id long, t string")

    def make_model():
        return lambda texts: [[float(len(t)), 0.0] for t in texts]

    got = embedding.embed_with(df, "id", "t", make_model, batch_rows=2).collect()
    assert sorted((r.id, list(r.vec)) for r in got) == [(i, [1.0, 0.0]) for i in range(1, 6)]


def test_vector_cache(spark, tmp_path):
    path = str(tmp_path / "vectors")
    seen = []

    def embed(todo):
        seen.append(todo.count())
        return todo.select("key", F.length("text").alias("n"))

    texts = lambda *t: spark.createDataFrame([(x,) for x in t], "t string")
    assert vector_cache.cached_vectors(spark, path, texts("a", "bb", "a", None), "t", embed).count() == 2
    assert vector_cache.cached_vectors(spark, path, texts("a", "ccc"), "t", embed).count() == 3
    assert vector_cache.cached_vectors(spark, path, texts("a", "ccc"), "t", embed).count() == 3
    assert seen == [2, 1, 0]


def test_two_runs_add_a_key_once(spark, tmp_path):
    """A run that commits while another embeds; the first commit of a key counts."""
    path = str(tmp_path / "vectors")
    texts = lambda *t: spark.createDataFrame([(x,) for x in t], "t string")

    def embed(mark):
        return lambda todo: todo.select("key", F.lit(mark).alias("by"))

    def embed_meanwhile(todo):
        vector_cache.cached_vectors(spark, path, texts("a", "b", "c"), "t", embed("other"))
        return embed("late")(todo)

    vector_cache.cached_vectors(spark, path, texts("a"), "t", embed("first"))
    found = vector_cache.cached_vectors(spark, path, texts("a", "b", "d"), "t", embed_meanwhile)
    by = {r.key: r.by for r in found.collect()}
    key = lambda t: spark.range(1).select(vector_cache.text_key(F.lit(t))).first()[0]
    assert by == {key("a"): "first", key("b"): "other", key("c"): "other", key("d"): "late"} and found.count() == 4
    assert [n for n, _, _ in vector_cache.manifests(spark, path)] == [0, 1, 2]


def test_a_run_that_stops_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "vectors")
    texts = spark.createDataFrame([("a",), ("b",)], "t string")

    def broken(todo):
        todo.select("key").write.parquet(f"{path}/commits/commit=half")
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        vector_cache.cached_vectors(spark, path, texts, "t", broken)
    assert vector_cache.read_cache(spark, path) is None
    # A claimed number without a manifest is passed over.
    (tmp_path / "vectors" / "manifests").mkdir(parents=True)
    (tmp_path / "vectors" / "manifests" / "000000000000.json").write_text("")
    made = vector_cache.cached_vectors(spark, path, texts, "t", lambda todo: todo.select("key", F.length("text").alias("n")))
    assert made.count() == 2 and [m[0] for m in vector_cache.manifests(spark, path)] == [1]


def test_rows_get_the_vector_of_their_text(spark, tmp_path):
    path = str(tmp_path / "vectors")
    rows = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a"), (4, None)], "id long, t string")
    embed = lambda todo: todo.select("key", F.array(F.length("text").cast("double")).alias("vec"))
    for _ in range(2):
        got = {r.id: r.vec for r in vector_cache.vectors_of(spark, path, rows, "t", embed).collect()}
        assert got == {1: [1.0], 2: [2.0], 3: [1.0], 4: None}
    assert len(vector_cache.manifests(spark, path)) == 1
    key = spark.range(1).select(vector_cache.text_key(F.lit("a")).alias("k")).first().k
    assert [r.key for r in vector_cache.read_cache(spark, path, [key[:2]]).collect()] == [key]
    assert vector_cache.read_cache(spark, path, ["zz"]).count() == 0


def test_dense_vectors_hash_a_text_once(spark):
    """The vectors of the expression, whose plan hashed a text again for each of its numbers."""
    texts = ["", None, " .!", "one", "One two ONE, one-two", "Ünï ünï 東京 x²", "\u0130stanbul e\u0301a \U0001d7d8\U0001f600z", "a " * 40_000, " lead\ttrail\n"]
    texts += [" ".join(f"w{i * j % 997}" for j in range(i)) for i in range(300)]
    df = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "key string, text string").repartition(3)
    made = clustering.hashed_dense(df, 16)
    assert made.schema.simpleString() == "struct<key:string,vec:array<double>>"
    assert "md5(" not in made._jdf.queryExecution().optimizedPlan().toString()
    want = {r.key: {d: v for d, v in r.x or []} for r in df.select("key", hash_vector(F.col("text"), 16).alias("x")).collect()}
    got = {r.key: r.vec for r in made.collect()}
    assert len(got) == len(texts)
    assert got == {k: [x.get(d, 0.0) for d in range(16)] for k, x in want.items()}


def test_words_are_hashed_once(monkeypatch):
    """Across steps and batches, with empty rows and nulls; words beyond those remembered are hashed again."""
    column = pa.array([b"b a b", None, b"", b" a c ", b"b"], pa.binary())
    hashed = []
    plain = hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda word, **how: (hashed.append(bytes(word)), plain(word, **how))[1])
    monkeypatch.setattr(V, "STEP_BYTES", 6)
    slot = {w: int(plain(w).hexdigest()[:8], 16) % 7 for w in (b"a", b"b", b"c")}
    want = [(0, b"b"), (0, b"a"), (0, b"b"), (3, b"a"), (3, b"c"), (4, b"b")]
    known = {}
    for _ in range(2):
        steps = list(V.word_slots(column, 7, known))
        assert len(steps) > 1 and sum(n for _, n, _, _ in steps) == 5
        got = [(start + r, s) for start, _, row, at in steps for r, s in zip(row.tolist(), at.tolist())]
        assert got == [(r, slot[w]) for r, w in want]
    assert sorted(hashed) == [b"a", b"b", b"c"]
    monkeypatch.setattr(V, "KNOWN_WORDS", 1)
    assert sum(len(s) for _, _, _, s in V.word_slots(column, 7, {})) == 6


def brute_silhouette(x, labels, power):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)) ** power
    out = []
    for i, own in enumerate(labels):
        mates = labels == own
        if mates.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mates].sum() / (mates.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) if other != own)
        out.append((b - a) / max(a, b))
    return out


def test_silhouettes(spark, cloud):
    x, _ = cloud
    labels = np.array([i % 4 for i in range(199)] + [9])
    df = spark.createDataFrame([(i, list(map(float, v)), int(c)) for i, (v, c) in enumerate(zip(x, labels))], "id long, vec array<double>, c int")
    squared = [r.s for r in clusters.silhouette_squared(df, "id", "vec", "c").orderBy("id").collect()]
    assert squared == pytest.approx(brute_silhouette(x, labels, 2))
    exact = [r.s for r in clusters.silhouette_exact(df, "id", "vec", "c", block_rows=30).orderBy("id").collect()]
    assert exact == pytest.approx(brute_silhouette(x, labels, 1))


def test_k_sweep_finds_the_number_of_groups(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, size=(30, 2)) for c in ([0, 0], [5, 0], [0, 5])])
    df = vecs(spark, x)
    sweep = clusters.k_sweep(df, "id", "vec", range(2, 5), exact=True)
    assert clusters.best_k(sweep).first().k == 3


def test_lloyd_steps(spark):
    df = vecs(spark, [[0, 0], [0, 2], [10, 0], [10, 2]])
    start = spark.createDataFrame([(0, [1.0, 1.0]), (1, [9.0, 9.0]), (2, [99.0, 99.0])], "cluster int, vec array<double>")
    got = clusters.lloyd_steps(df, "vec", start, 3).collect()
    assert sorted((r.cluster, r.n, list(r.vec)) for r in got) == [(0, 2, [0.0, 1.0]), (1, 2, [10.0, 1.0])]
    assert keyword_table(spark, {"a": 1}).first().weight == 1.0


def test_exact_sweep_equals_the_exact_silhouette_of_each_k(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(700)], "id long, vec array<double>")
    for r in clusters.k_sweep(df, "id", "vec", [2, 9], exact=True).collect():
        _, placed = clusters.kmeans(df, "id", "vec", r.k)
        s = clusters.silhouette_exact(df.join(placed, "id"), "id", "vec", "cluster").agg({"s": "avg"}).first()[0]
        assert abs(s - r.silhouette) < 1e-9


def test_the_query_sweeps_all_counts(spark, monkeypatch):
    import inspect

    from leadrank import queries

    asked = []
    plain = inspect.signature(clusters.k_sweep)
    monkeypatch.setattr(queries.clusters, "k_sweep", lambda *a, **k: asked.append(plain.bind(*a, **k)))
    monkeypatch.setattr(queries.X, "vectors", lambda *_: None)
    monkeypatch.setattr(queries, "round_columns", lambda df, *names: df)
    queries.all_queries()["g4_k_sweep"](spark, "")
    asked[0].apply_defaults()
    assert list(asked[0].arguments["ks"]) == list(range(2, 100)) and asked[0].arguments["exact"]


def lloyd(x, centres, steps=10):
    for _ in range(steps):
        at = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([x[at == k].mean(axis=0) if (at == k).any() else c for k, c in enumerate(centres)])
    return ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)


def by_digest(x, seed=0):
    import hashlib

    return np.array(sorted(range(len(x)), key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()))


def test_kmeans_is_the_same_on_other_partitions(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, size=(40, 3)) for c in ([0, 0, 0], [4, 0, 0], [0, 4, 0], [0, 0, 4])])
    order = by_digest(x)
    start = clusters.seeds(x[order], np.ones(len(x), int), 4)
    want = lloyd(x, start)
    for parts in (1, 7):
        _, placed = clusters.kmeans(vecs(spark, x).repartition(parts), "id", "vec", 4)
        assert [r.cluster for r in placed.orderBy("id").collect()] == want.tolist()
    assert len({tuple(sorted(np.flatnonzero(want == k))) for k in range(4)}) == 4


def test_a_coreset_smaller_than_the_table(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.2, size=(100, 2)) for c in ([0, 0], [6, 0], [0, 6])])
    df = vecs(spark, x).repartition(5).withColumn("vec", F.col("vec").cast("array<double>"))
    order = by_digest(x)[:20]
    points = clusters.coreset(df, 0, 20)
    assert np.allclose(points, x[order])
    weights = clusters._weights(df, points)
    near = ((x[:, None, :] - points[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert weights.tolist() == np.bincount(near, minlength=20).tolist()
    fits = clusters.fit(df, [2, 3], coreset_rows=20)
    assert [len(c) for c in fits] == [2, 3]
    assert np.allclose(sorted(map(tuple, np.round(fits[1]).tolist())), [(0, 0), (0, 6), (6, 0)])


def test_few_rows_and_no_rows(spark):
    df = vecs(spark, [[0.0, 1.0], [2.0, 3.0]])
    assert sorted(r.cluster for r in clusters.kmeans(df, "id", "vec", 5)[1].collect()) == [0, 1]
    empty = df.limit(0)
    assert clusters.kmeans(empty, "id", "vec", 3)[1].collect() == []
    assert [tuple(r) for r in clusters.k_sweep(empty, "id", "vec", [2, 3], exact=True).collect()] == [(2, 0.0, 0.0), (3, 0.0, 0.0)]
    assert [r.silhouette for r in clusters.k_sweep(df, "id", "vec", [2], exact=True).collect()] == [0.0]
    nulls = spark.createDataFrame([(1, None)], "id long, vec array<double>")
    assert clusters.kmeans(nulls, "id", "vec", 3)[1].collect() == []


@pytest.mark.parametrize("apart", [0.1, 1.0, 50.0])
@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_pruned_silhouettes(spark, apart, block_rows):
    rng = np.random.default_rng(5)
    labels = np.array([0] * 60 + [1] * 3 + [2] * 40 + [5] * 30 + [9])
    x = rng.normal(size=(len(labels), 4)) + apart * rng.normal(size=(10, 4))[labels]
    x[10:20] = x[10]
    df = spark.createDataFrame([(i, list(map(float, v)), int(c)) for i, (v, c) in enumerate(zip(x, labels))], "id long, vec array<double>, c int").repartition(3)
    got = [r.s for r in clusters.silhouette_exact(df, "id", "vec", "c", block_rows=block_rows).orderBy("id").collect()]
    assert got == pytest.approx(brute_silhouette(x, labels, 1), abs=1e-6)


def test_one_cluster_has_no_widths(spark):
    df = spark.createDataFrame([(i, [float(i)], 3) for i in range(5)], "id long, vec array<double>, c int")
    assert [r.s for r in clusters.silhouette_exact(df, "id", "vec", "c").collect()] == [0.0] * 5
    assert clusters.silhouette_exact(df.limit(0), "id", "vec", "c").collect() == []


def test_sweeps_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 3))
    df = vecs(spark, x).repartition(4)
    order = by_digest(x)
    for exact, power in ((True, 1), (False, 2)):
        got = {r.k: (r.silhouette, r.error) for r in clusters.k_sweep(df, "id", "vec", [2, 3, 8], exact=exact).collect()}
        for k in (2, 3, 8):
            labels = lloyd(x, clusters.seeds(x[order], np.ones(150, int), k))
            assert got[k][0] == pytest.approx(np.mean(brute_silhouette(x, labels, power)), abs=1e-6) and got[k][1] == 0
    sampled = clusters.k_sweep(df, "id", "vec", [3], exact=True, sample_rows=40).first()
    labels = lloyd(x, clusters.seeds(x[order], np.ones(150, int), 3))
    widths = np.array(brute_silhouette(x, labels, 1))[order[:40]]
    assert sampled.silhouette == pytest.approx(widths.mean(), abs=1e-6)
    assert sampled.error == pytest.approx(widths.std(ddof=1) / np.sqrt(40) * np.sqrt(1 - 40 / 150), abs=1e-6)


def test_more_than_four_thousand_centroids(spark):
    df = vecs(spark, [[0.2], [4998.7]])
    centroids = spark.createDataFrame([(i, [float(i)]) for i in range(5000)], "cluster int, vec array<double>")
    assert sorted(r.cluster for r in clusters.assign(df, "id", "vec", centroids).collect()) == [0, 4999]
