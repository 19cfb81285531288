import itertools
import re

import pytest

from leadrank.llm import decontaminate


def brute(docs, items, least=0.8):
    """Best whole overlay of every item on every text; only those above ``least``."""
    cut = lambda t: re.split(r"[^\w]+|_+", (t or "").lower())
    out = []
    for d, text in docs:
        words = cut(text)
        for i, item in items:
            item = [x for x in cut(item) if x]
            if text is None or len(item) < decontaminate.SPAN:
                continue
            best = max(sum(0 <= o + j < len(words) and words[o + j] == w for j, w in enumerate(item)) for o in range(-len(item), len(words) + 1))
            if best >= least * len(item):
                out.append((d, i, best, len(item)))
    return sorted(set(out))


def found(spark, docs, items, docs_of, **more):
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminated(docs_of(docs), table, **more).select("doc_id", "item_id", "n_matched", "n_words").collect()
    return sorted(map(tuple, rows))


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


@pytest.mark.parametrize("most", [10**6, 0])
def test_substitutions_case_and_marks(spark, docs_of, odd_texts, most):
    words = ITEM.split()
    docs = [(100 + n, t) for n, t in enumerate(odd_texts)]
    for n, gone in enumerate([(), (7,), (4, 9), (2, 7, 12), (0, 5, 10), (1, 4, 7, 10), tuple(range(8))]):
        docs.append((n, "before it " + " ".join("other" if k in gone else w for k, w in enumerate(words)) + " behind it"))
    docs += [(50, ITEM.upper().replace(" ", ", ")), (51, ITEM), (51, ITEM), (52, " ".join(words[2:])), (53, " ".join(words[8:]))]
    items = [(1, ITEM), (2, None), (3, ""), (4, "too short an item"), (5, " ".join(reversed(words)))]
    got = found(spark, docs, items, docs_of, max_broadcast=most)
    assert got == brute(docs, items)
    assert {d for d, *_ in got} == {0, 1, 2, 3, 4, 50, 51, 52}


def test_masks_find_a_fifth_replaced():
    masks = [[k for k, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    for size in range(13, 17):
        for gone in itertools.combinations(range(size), size // 5):
            left = set(range(size)) - set(gone)
            assert any(all(at + k in left for k in m) for m in masks for at in range(size - decontaminate.SPAN + 1))


def test_empty_tables(spark, docs_of):
    assert found(spark, [], [(1, ITEM)], docs_of) == []
    assert found(spark, [(1, ITEM)], [], docs_of) == []


def test_plan_has_no_python(spark, docs_of):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = decontaminate.contaminated(docs_of([(1, ITEM)]), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("most", [10**6, 0])
def test_short_items_of_every_length(spark, docs_of, most, monkeypatch):
    monkeypatch.setattr(decontaminate, "SPAN", 1)  # brute() skips items under it
    items, docs = [], []
    for size in range(1, 15):
        words = [f"n{size}w{k}" for k in range(size)]
        items.append((size, " ".join(words)))
        for gone in itertools.chain.from_iterable(itertools.combinations(range(size), m) for m in range(size // 5 + 1)):
            docs.append((len(docs), "before " + " ".join("other" if k in gone else w for k, w in enumerate(words)) + " behind"))
    want = brute(docs, items)
    monkeypatch.undo()
    assert len(want) == len(docs)
    assert found(spark, docs, items, docs_of, max_broadcast=most) == want


def test_null_ids_with_hits_in_both_branches(spark, docs_of):
    docs = [(None, ITEM), (None, "other words " + ITEM), (1, ITEM), (None, "nothing of it")]
    broadcast, shuffled = (decontaminate.contaminated(docs_of(docs), spark.createDataFrame([(1, ITEM)], "item_id long, text string"), max_broadcast=n) for n in (10**6, 0))
    assert {r.doc_id for r in shuffled.collect()} == {None, 1}
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, broadcast.collect()))


@pytest.mark.parametrize("most", [10**6, 0])
def test_many_hits_in_a_long_text(spark, docs_of, most):
    # Rows of hits that hold the text would be 20,000 copies of 115,000 tokens.
    text = " ".join(f"{ITEM} " + " ".join(f"x{k}y{j}" for j in range(100)) for k in range(1000))
    assert found(spark, [(1, text), (2, "nothing of it")], [(1, ITEM)], docs_of, max_broadcast=most) == [(1, 1, 15, 15)]


@pytest.mark.parametrize("most", [10**6, 0])
def test_repeated_rows_and_offsets_count_once(spark, docs_of, most):
    words = ITEM.split()
    changed = " ".join("other" if k in (2, 7, 12) else w for k, w in enumerate(words))
    docs = [(1, changed), (1, changed), (1, "a " + changed), (2, f"{changed} and {ITEM}"), (None, ITEM), (None, ITEM), (None, "a " + changed)]
    items = [(1, ITEM), (1, ITEM), (2, " ".join(words[1:])), (3, "alpha beta gamma"), (3, "alpha beta gamma"), (None, ITEM)]
    best = {}
    for d, i, n, size in brute([(-1 if d is None else d, t) for d, t in docs], [(i, t) for i, t in items if i is not None]):
        best[d, i] = max(best.get((d, i), (0, 0)), (n, size))
    want = sorted((*pair, *of) for pair, of in best.items())
    got = [tuple(r) for r in decontaminate.contaminated(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"), max_broadcast=most).drop("overlap").collect()]
    got = sorted((-1 if d is None else d, *rest) for d, *rest in got)
    assert [r for r in got if r[1] != 3] == want
    assert [r for r in got if r[1] == 3] == [(-1, 3, 3, 3), (2, 3, 3, 3)]


def test_sieve_keeps_all_that_are_held_and_few_others(spark):
    from pyspark.sql import functions as F

    hashes = spark.range(200_000).select("id", F.xxhash64("id").alias("h"))
    held = hashes.where("id < 2000").select("h")
    passed = [r.id for r in decontaminate.sifted(hashes, "h", held, 2000).collect()]
    assert len(passed) == len(set(passed)) and set(range(2000)) <= set(passed)
    assert len(passed) < 2000 + 0.02 * 198_000
