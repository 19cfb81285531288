"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Tokens are lower-case runs of letters and digits. A seed is six tokens in a row
seen through a mask that leaves one of them out; its hash stands for the five
that count. Every position of every text and every position of every item gives
one seed for each mask. Where two are equal, the item is laid along the text at
that offset, and the pair counts if at least 0.8 of the item's tokens are the
same, place by place. The two masks together find every item of 13 or more
tokens with up to a fifth of them replaced (all placements were tried up to 16
tokens, random and evenly spaced ones up to 40). Items of fewer tokens hold
instead seeds of one to three tokens in a row, end to end: with ``m`` tokens
that may differ, one of ``m + 1`` pieces is the same in the text, so none is
missed. Texts give only the kinds of seeds that some item holds.

The scan, the seeds, the join with the item seeds and the verification are one
narrow stage: the seeds of the items are broadcast, up to a checked number, and
a text never moves. Beyond that number a sieve of the item seeds is broadcast, a
blocked Bloom filter of some bits a seed; what passes it meets the item seeds in a
shuffled join on the hash. A second sieve holds the texts with hits, so that only
these are moved for the verification, and once each. The rows are the same.

Null and empty texts and items match nothing. Very long texts are one row each and
are searched whole; work and memory grow with their length. Repeated rows of documents
give the same pairs once. Empty tables give no pairs.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from leadrank.llm.shared import stored

#: Fixed masks: 1 counts, 0 is ignored.
MASKS = ("111011", "101111")
#: Seeds of items under ``LONG`` tokens.
SHORT_MASKS = ("1", "11", "111")
LONG = 13
KINDS = MASKS + SHORT_MASKS
SPAN = len(MASKS[0])
BREAK = r"[^\p{L}\p{N}]+"
#: Item seeds that are broadcast at most; a seed is a row of about 40 bytes.
MAX_BROADCAST_SEEDS = 1_000_000
#: A block of a sieve has so many words of 64 bits, and a hash sets one bit in each.
SIEVE_WORDS = 4
#: Hashes a block; about one in 300 others passes. More come to a block only beyond ``MAX_SIEVE_BLOCKS``.
SIEVE_FILL = 16
#: A block is a row of about 60 bytes.
MAX_SIEVE_BLOCKS = 1 << 20


def tokens(text: Column) -> Column:
    """Tokens in order; text before the first or after the last token gives an empty one."""
    return F.split(F.lower(text), BREAK)


def _windows(words: Column) -> Column:
    """For each position, the tokens from there on as fields w0 to w5."""
    return F.arrays_zip(words.alias("w0"), *[F.slice(words, k + 1, F.greatest(F.size(words), F.lit(1))).alias(f"w{k}") for k in range(1, SPAN)])


def seeds(table: DataFrame, keep: list[str], words: str, kinds: list[int]) -> DataFrame:
    """``keep``, ``pos`` (0-based), ``kind`` and ``seed`` for each position and mask in ``kinds``."""
    # The outer form: an inner one filters on the array's size and computes it twice.
    shortest = min(len(KINDS[k]) for k in kinds)
    at = table.select(*keep, F.posexplode_outer(_windows(F.col(words))).alias("pos", "t")).where(f"t.`w{shortest - 1}` is not null")
    of = F.array(*[F.struct(F.lit(k).alias("kind"), _seed(k, shortest).alias("seed")) for k in kinds])
    made = at.select(*keep, "pos", F.explode(of).alias("s")).select(*keep, "pos", "s.kind", "s.seed")
    return made if all(len(KINDS[k]) == shortest for k in kinds) else made.where("seed is not null")


def _seed(kind: int, sure: int) -> Column:
    """Null where fewer tokens follow than the mask spans; ``sure`` of them do."""
    mask = KINDS[kind]
    made = F.xxhash64(F.lit(kind), *[F.col(f"t.w{k}") for k, c in enumerate(mask) if c == "1"])
    return made if len(mask) <= sure else F.when(F.col(f"t.w{len(mask) - 1}").isNotNull(), made)


def _item_seeds(bench: DataFrame, least: float) -> DataFrame:
    """``item_id``, ``item_pos``, ``kind`` and ``seed``: long items under both masks, short ones in pieces end to end."""
    n = F.size("item")
    pieces = n - F.ceil(F.lit(least) * n) + 1
    short = F.greatest(F.lit(1), F.least(F.lit(len(SHORT_MASKS)), F.floor(n / pieces))).cast("int")
    made = seeds(bench.withColumn("span", F.when(n < LONG, short)), ["item_id", "span"], "item", list(range(len(KINDS))))
    fits = F.col("span").isNull() & (F.col("kind") < len(MASKS))
    fits |= (F.col("kind") == F.col("span") + (len(MASKS) - 1)) & (F.col("pos") % F.col("span") == 0)
    return made.where(fits).select("item_id", F.col("pos").alias("item_pos"), "kind", "seed").distinct()


def _fresh() -> Column:
    """False where the window one place before is the same in text and item.

    Then that one is a hit at the same offset under either mask, so the run's first
    hit stands for all. Short items have seeds only at some places; theirs all count.
    """
    before = [F.get("words", F.col("pos") + k) == F.get("item", F.col("item_pos") + k) for k in range(-1, SPAN - 1)]
    inside = (F.size("item") >= LONG) & (F.col("pos") > 0) & (F.col("item_pos") > 0)
    return ~F.coalesce(reduce(and_, before, inside), F.lit(False))


def _block(hashed: str, blocks: int) -> Column:
    return F.shiftrightunsigned(hashed, 6 * SIEVE_WORDS).bitwiseAND(F.lit(blocks - 1))


def _bit(hashed: str, k: int) -> Column:
    return F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63)).cast("int")


def sifted(table: DataFrame, hashed: str, held: DataFrame, n: int) -> DataFrame:
    """The rows of ``table`` whose ``hashed`` may be among the ``n`` of ``held``: all that are, and few others.

    ``hashed`` is a 64-bit hash in both tables. What is broadcast is some bits for each of ``held``, and bounded.
    """
    blocks = min(1 << (max(n, 1) // SIEVE_FILL).bit_length(), MAX_SIEVE_BLOCKS)
    one = "shiftleft(1L, `b{}`)"
    bits = held.select(_block(hashed, blocks).alias("block"), *[_bit(hashed, k).alias(f"b{k}") for k in range(SIEVE_WORDS)])
    sieve = bits.groupBy("block").agg(*[F.bit_or(F.expr(one.format(k))).alias(f"b{k}") for k in range(SIEVE_WORDS)])
    sieve = sieve.select(F.struct(*sieve.columns).alias("__sieve"))
    passes = [F.bit_get(f"__sieve.b{k}", _bit(hashed, k)) == 1 for k in range(SIEVE_WORDS)]
    return table.join(F.broadcast(sieve), (_block(hashed, blocks) == F.col("__sieve.block")) & reduce(and_, passes)).drop("__sieve")


def _shuffled_hits(texts: DataFrame, bench: DataFrame, wanted: DataFrame, n: int, kinds: list[int]) -> DataFrame:
    """Hits with ``words`` and ``item``, each offset once; sizes of the tables do not matter."""
    # Rows of one id, or of none, are told apart by their texts.
    near = sifted(seeds(texts, ["id", "hash"], "words", kinds).select("id", "hash", "pos", "seed"), "seed", wanted, n)
    # Sizes on disk say little of repeated rows, so no join here is left to the planner.
    found = near.join(wanted.hint("merge"), "seed").select("id", "hash", "item_id", (F.col("pos") - F.col("item_pos")).alias("offset"))
    found = stored(found.distinct(), "item-hits")
    hit = found.select("hash").distinct()
    again = sifted(texts, "hash", hit, hit.count()).select(F.col("id").alias("its_id"), F.col("hash").alias("its_hash"), "words")
    whole = found.join(bench.hint("merge"), "item_id")
    return whole.join(again.hint("merge"), F.col("id").eqNullSafe(F.col("its_id")) & (F.col("hash") == F.col("its_hash")))


def _matched(hits: DataFrame) -> DataFrame:
    """``id``, ``item_id``, ``n_words`` and ``n_matched`` of each text, item and offset.

    The item's places are generated and summed, so that this stays in one piece with
    the hits: a row that left it would copy the whole text, once for each hit, and all
    of a text's rows would wait in memory together.
    """
    place = ["id", "hash", "item_id", "item_hash", "offset"]
    at = hits.select(*place, F.size("item").alias("n_words"), "words", F.posexplode_outer("item").alias("j", "word"))
    same = F.coalesce((F.get("words", F.col("offset") + F.col("j")) == F.col("word")).cast("int"), F.lit(0))
    sums = at.groupBy(*place).agg(F.sum(same).alias("same"), F.count_if(F.col("j") == 0).alias("times"), F.max("n_words").alias("n_words"))
    # Several hits at an offset, and equal rows of documents or items, count the same places again.
    return sums.select("id", "item_id", "n_words", F.expr("same div times").cast("int").alias("n_matched"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    least: float = 0.8,
    key: str = "doc_id",
    max_broadcast: int = MAX_BROADCAST_SEEDS,
) -> DataFrame:
    """Pairs ``(key, item_id, n_matched, n_words, overlap)`` that overlap in ``least`` of the item or more.

    Of several places the best one counts.
    """
    texts = docs.select(F.col(key).alias("id"), tokens(F.col("text")).alias("words")).withColumn("hash", F.xxhash64("words"))
    bench = items.select("item_id", F.array_remove(tokens(F.col("text")), "").alias("item")).where(F.size("item") > 0)
    bench = bench.withColumn("item_hash", F.xxhash64("item"))
    wanted = _item_seeds(bench, least)
    # One row per mask.
    held = {r["kind"]: r["count"] for r in wanted.groupBy("kind").count().collect()}
    kinds = sorted(held) or list(range(len(MASKS)))
    wanted = wanted.drop("kind")
    n = sum(held.values())
    if n <= max_broadcast:
        # Items hold no more rows than their seeds, so both sides are bounded.
        hits = (
            seeds(texts, ["id", "hash", "words"], "words", kinds)
            .join(F.broadcast(wanted), "seed")
            .join(F.broadcast(bench), "item_id")
            .where(_fresh())
            .withColumn("offset", F.col("pos") - F.col("item_pos"))
        )
    else:
        hits = _shuffled_hits(texts, bench, wanted, n, kinds)
    best = _matched(hits).groupBy("id", "item_id").agg(F.max("n_matched").alias("n_matched"), F.max("n_words").alias("n_words"))
    return best.where(F.col("n_matched") >= F.lit(least) * F.col("n_words")).select(
        F.col("id").alias(key), "item_id", "n_matched", "n_words", F.round(F.col("n_matched") / F.col("n_words"), 6).alias("overlap")
    )
