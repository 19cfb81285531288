import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadrank import fixtures as X
from leadrank.functions.text import spaced_words
from leadrank.functions.vectors import term_counts
from leadrank.operators import latent
from leadrank.plans import relevance


def dense_matrix(df, text, slots):
    """The term matrix by the book, and the row ids."""
    rows = df.select("id", term_counts(F.col(text), slots).alias("x")).orderBy("id").collect()
    counts = np.zeros((len(rows), slots))
    for i, r in enumerate(rows):
        for d, n in r.x or []:
            counts[i, d] = n
    worded = (counts > 0).any(axis=1)
    idf = np.log((1 + worded.sum()) / (1 + (counts > 0).sum(axis=0))) + 1
    a = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    norm = np.linalg.norm(a, axis=1, keepdims=True)
    return a / np.where(norm > 0, norm, 1), idf


@pytest.fixture(scope="module")
def topics(spark):
    """Texts of four topics, with a few words of their own each."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"t{i % 4}w{w}" for w in rng.integers(0, 12, 30)) + f" common only{i}") for i in range(120)]
    return spark.createDataFrame(rows + [(500, None), (501, " .!"), (502, "")], "id long, t string").repartition(5)


def test_against_a_dense_decomposition(spark, topics):
    a, idf = dense_matrix(topics, "t", 256)
    _, values, right = np.linalg.svd(a, full_matrices=False)
    model = latent.fit_latent(topics, "t", k=4, slots=256, rounds=8)
    assert np.allclose(model.idf, idf)
    assert model.values == pytest.approx(values[:4], rel=1e-6)
    # The same space: projections agree.
    assert np.allclose(model.basis @ model.basis.T, right[:4].T @ right[:4], atol=1e-4)
    got = {r.id: r.vec for r in latent.with_latent(topics, ["id"], "t", model).collect()}
    want = a @ model.basis
    for i in range(120):
        assert got[i] == pytest.approx(want[i] / np.linalg.norm(want[i]), abs=1e-9)
    assert got[500] is None and got[501] is None and got[502] is None


def test_vectors_are_stable(spark, topics):
    one = latent.fit_latent(topics, "t", k=4, slots=256)
    two = latent.fit_latent(topics.repartition(2), "t", k=4, slots=256)
    assert np.allclose(one.basis, two.basis, atol=1e-9) and np.allclose(one.values, two.values)
    # Another start, the same space.
    other = latent.fit_latent(topics, "t", k=4, slots=256, rounds=8, seed=9)
    assert np.allclose(one.basis @ one.basis.T, other.basis @ other.basis.T, atol=1e-3)


def test_texts_of_a_topic_are_close(spark, topics):
    model = latent.fit_latent(topics, "t", k=4, slots=256)
    got = {r.id: np.array(r.vec) for r in latent.with_latent(topics.where("id < 120"), ["id"], "t", model).collect()}
    same = [got[i] @ got[i + 4] for i in range(0, 100)]
    other = [got[i] @ got[i + 1] for i in range(0, 100)]
    assert min(same) > 0.8 and max(other) < 0.6


def test_few_texts_and_none(spark, topics):
    one = spark.createDataFrame([(1, "a b c")], "id long, t string")
    model = latent.fit_latent(one, "t", k=3, slots=64)
    assert model.values[0] == pytest.approx(1.0) and (model.values[1:] == 0).all() and (model.basis[:, 1:] == 0).all()
    assert np.abs(latent.with_latent(one, ["id"], "t", model).first().vec) == pytest.approx([1, 0, 0])
    none = latent.fit_latent(topics.limit(0), "t", k=3, slots=64)
    assert (none.values == 0).all() and latent.with_latent(one, ["id"], "t", none).first().vec is None


def test_ranking_and_sectors(spark, topics):
    phrases = spark.createDataFrame([("t1w3 t1w4", 2.0), ("nothing known", 1.0)], "name string, weight double")
    rank = relevance.latent_rank(topics, "id", "t", phrases, mode="add").collect()
    scores = {r.id: r.score for r in rank if r.score is not None}
    assert np.mean([scores[i] for i in range(1, 120, 4)]) > np.mean([scores[i] for i in range(2, 120, 4)]) + 0.3
    sectors = spark.createDataFrame([(f"t{k}w1 t{k}w2 t{k}w5", 1.0) for k in range(4)], "name string, weight double")
    found = {r.id: r.predicted_sector for r in relevance.latent_sector(topics, "id", "t", sectors, mode="add").collect()}
    assert all(found[i] == f"t{i % 4}w1 t{i % 4}w2 t{i % 4}w5" for i in range(120)) and found[500] is None


def test_products_of_frequent_and_rare_slots(monkeypatch):
    """Over steps of few rows and terms; frequent slots as dense columns, all or none of them."""
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.15, (300, 50)) * (rng.random(50) < 0.9)
    counts[[0, 17, 18, 299]] = 0
    counts[:, 7] = 1
    idf, block = rng.random(50) + 0.5, rng.normal(size=(50, 6))
    a = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    row, slot = np.nonzero(counts)
    sizes = np.bincount(row, minlength=300)
    monkeypatch.setattr(latent, "STEP_TERMS", 11)
    for share, rows in ((0.005, 4096), (0.16, 64), (2.0, 33), (-1.0, 1)):
        monkeypatch.setattr(latent, "DENSE_SHARE", share)
        monkeypatch.setattr(latent, "STEP_ROWS", rows)
        made, back = np.zeros((300, 6)), np.zeros((50, 6))
        for start, n, parted in latent._steps(sizes, slot, counts[row, slot], idf):
            made[start : start + n] = latent._times(parted, block)
            latent._add_back(back, parted, made[start : start + n])
            assert share != 0.16 or 0 < len(parted[0]) < 50 and (parted[2][1] != 7).all()
        assert np.allclose(made, a @ block, atol=1e-12) and np.allclose(back, a.T @ a @ block, atol=1e-12)


def test_counts_are_packed_once(spark, topics, monkeypatch):
    """A fit takes its texts apart once and keeps eight bytes a term; parts of an Arrow column keep their rows."""
    texts = topics.select("id", spaced_words(F.col("t")).alias("w"))
    kept = latent._packed(texts.select("w"), 256)
    assert kept.schema.simpleString() == "struct<_x:binary>" and "md5(" not in kept._jdf.queryExecution().optimizedPlan().toString()
    column = kept.toArrow().column("_x").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    want = sorted([(x.dim, x.n) for x in r.x or []] for r in topics.select(term_counts(F.col("t"), 256).alias("x")).collect())
    got = []
    for a in range(0, len(column), 7):
        sizes, slot, count = latent._unpacked(column.slice(a, 7))
        ends = np.cumsum(sizes)
        got += [list(zip(slot[e - n : e].tolist(), count[e - n : e].tolist())) for e, n in zip(ends, sizes)]
    assert sorted(got) == want
    made = []
    packed = latent._packed
    monkeypatch.setattr(latent, "_packed", lambda *a: made.append(packed(*a)) or made[-1])
    latent.fit_latent(topics, "t", k=4, slots=256)
    assert len(made) == 1


def test_corpus_rank(spark, sf):
    rank = relevance.latent_rank(X.companies(spark, sf), "company_id", "Description", X.phrases(spark), mode="add")
    rows = rank.collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1)) and max(r.score for r in rows) == 1.0
