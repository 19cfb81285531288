"""Scaling, ordering, top-N cuts and row numbers that survive hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadrank.session import Reuse

#: Cuts of more rows than this are ranked through the range shuffle.
ONE_TASK_ROWS = 100_000
#: One part in so many is how far a sketch's rank may be off.
SKETCH_ACCURACY = 20_000


def scaled(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); 0 when all values are equal."""
    return F.when(high > low, (value - low) / (high - low)).when(value.isNotNull(), F.lit(0.0))


def minmax(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add min-max scaled columns, ``{source: target}``.

    The bounds are one row, found by a scalar subquery.
    """
    bounds = df.agg(
        F.struct(
            *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
            *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)],
        ).alias("b")
    )
    out = df.withColumn("_b", bounds.scalar())
    for i, (source, target) in enumerate(columns.items()):
        out = out.withColumn(target, scaled(F.col(source), F.col(f"_b.lo{i}"), F.col(f"_b.hi{i}")))
    return out.drop("_b")


def combined(df: DataFrame, keyword: str, sector: str | None, combine: str = "sum") -> DataFrame:
    """Add ``score`` in [0, 1] from a keyword and an optional sector score.

    ``sum`` adds the raw scores and scales once; ``product`` scales each part
    in place, multiplies, and scales again.
    """
    if combine == "sum":
        raw = F.col(keyword) if sector is None else F.col(keyword) + F.col(sector)
        return minmax(df.withColumn("_raw", raw), {"_raw": "score"}).drop("_raw")
    if combine != "product":
        raise ValueError(f"unknown combine {combine!r}")
    parts = [keyword] if sector is None else [keyword, sector]
    df = minmax(df, {c: c for c in parts})
    raw = F.col(keyword) if sector is None else F.col(keyword) * F.col(sector)
    return minmax(df.withColumn("_raw", raw), {"_raw": "score"}).drop("_raw")


class Order(list):
    """Order columns, best first, and the value that leads them.

    ``leading`` is a number of which larger values come first and nulls last.
    """

    def __init__(self, columns: list[Column], leading: Column) -> None:
        super().__init__(columns)
        self.leading = leading


def best_first(score: str, row_id: str) -> Order:
    """Order by score, best first, nulls last; the id breaks ties.

    Scores that agree to nine digits are ties: below that, sums taken in
    another order differ, and copies of a text would swap places between runs.
    """
    value = F.round(score, 9)
    return Order([F.desc_nulls_last(value), F.asc(row_id)], value)


def _positions(df: DataFrame, order: list[Column], reuse: Reuse) -> DataFrame:
    """Add ``_at``: the 0-based place of each row in the given total order.

    A range shuffle on all order columns splits even a group of equal leading
    values. Places inside a partition come from the sorted partition itself;
    the start of each partition is a running sum over one row per partition.
    The ranged table is kept, so both reads see the same partitions.
    """
    ranged = reuse.keep(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition, so this window and the broadcast are bounded.
    starts = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
    )
    inside = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("_at", F.col("_start") + inside)
        .drop("_mid", "_part", "_start")
    )


def ranked(df: DataFrame, order: list[Column], out: str = "rank", reuse: Reuse | None = None) -> DataFrame:
    """Add a 1-based rank over the whole table without a one-task window."""
    placed = _positions(df, order, reuse or Reuse())
    return placed.withColumn(out, (F.col("_at") + 1).cast("bigint")).drop("_at")


def survivors(df: DataFrame, leading: Column, n: int, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Rows that may be among the ``n`` with the largest ``leading`` values; all of those are among them.

    A mergeable quantile sketch gives a threshold a little below the cut, from one
    number per row; a count proves that enough rows reach it. Rows that tie with
    the threshold stay. Where no threshold is proven, the table comes back whole.
    """
    value = leading.cast("double")
    kept = F.isnotnull(value) & ~F.isnan(value)
    total = df.where(kept).count()
    if n >= total:
        return df
    # The sketch's rank may be off by one part in ``accuracy`` on either side.
    share = n / total + 2.0 / accuracy
    while share < 1.0:
        bound = df.where(kept).agg(F.percentile_approx(value, F.lit(1.0 - share), F.lit(accuracy)).alias("b")).first()["b"]
        reached = F.isnan(value) | (value >= F.lit(bound))
        if df.where(kept & (value >= F.lit(bound))).count() >= n:
            return df.where(F.coalesce(reached, F.lit(False)))
        share *= 2
    return df


def top_n(
    df: DataFrame, order: list[Column], n: int, out: str | None = "rank", reuse: Reuse | None = None
) -> DataFrame:
    """First ``n`` rows, with a rank that is numbered after the cut.

    A large ``n`` goes through the range shuffle, so that the cut never meets in
    one task. Where the order says what leads it, rows that cannot make the cut are
    left out before, and little more than ``n`` rows are shuffled.
    """
    if n > ONE_TASK_ROWS:
        reuse = reuse or Reuse()
        if isinstance(order, Order):
            df = survivors(reuse.keep(df), order.leading, n)
        # Those left out come after all others, so ranks are the same.
        large = ranked(df, order, out or "_rank", reuse)
        large = large.where(F.col(out or "_rank") <= n)
        return large if out else large.drop("_rank")
    cut = df.orderBy(*order).limit(n)
    if out is None:
        return cut
    return cut.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def running_total(
    df: DataFrame, group: list[str], order: list[str], amount: Column, out: str, reuse: Reuse | None = None
) -> DataFrame:
    """Sum of ``amount`` over the rows of the group before each row; ``order`` must be total.

    Rows are range-shuffled on group and order, which spreads a large group over
    many tasks. Then amounts are added up per partition and group, and a row's
    total is that before it there plus the group's in earlier partitions. The
    sums join back on partition and group, a key that no group makes hot. Pass
    ids only and join payloads afterwards.
    """
    total = [F.asc(c) for c in group + order]
    ranged = df.withColumn("_amount", amount.cast("bigint")).orderBy(*total).withColumn("_mid", F.monotonically_increasing_id())
    ranged = (reuse or Reuse()).keep(ranged).withColumn("_part", F.shiftright("_mid", 33))
    before = (Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_part", *group).agg(F.sum("_amount").alias("_sum"))
    # A group has one row per partition here.
    earlier = F.sum("_sum").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(*before))
    sums = sums.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in group], F.coalesce(earlier, F.lit(0)).alias("_earlier")
    )
    same = F.col("_part") == F.col("_p")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    here = F.sum("_amount").over(Window.partitionBy("_part", *group).orderBy("_mid").rowsBetween(*before))
    within = ranged.withColumn("_here", F.coalesce(here, F.lit(0)))
    return within.join(sums, same).withColumn(out, F.col("_here") + F.col("_earlier")).select(*df.columns, out)


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, reuse: Reuse | None = None) -> DataFrame:
    """1-based number of each row within its group; ``order`` must be total. See ``running_total``."""
    return running_total(df, group, order, F.lit(1), out, reuse).withColumn(out, F.col(out) + 1)


def choose_top(
    scored: DataFrame,
    order: list[Column],
    words: Column,
    min_words: int = 20,
    n: int = -1,
    auto_share: float = 0.10,
    auto_max: int = 100,
) -> DataFrame:
    """Best ``n`` rows among those with at least ``min_words`` words.

    A negative ``n`` means a tenth of all rows, at most 100, counted before the
    length filter.
    """
    long_enough = scored.where(words >= min_words)
    if n >= 0:
        return top_n(long_enough, order, n)
    limit = scored.agg(F.floor(F.count(F.lit(1)) * F.lit(auto_share)).cast("bigint").alias("m"))
    cut = top_n(long_enough, order, auto_max)
    return cut.where(F.col("rank") <= limit.scalar())


def label_sample(df: DataFrame, label: str, values: list, row_id: str, n: int = 100) -> DataFrame:
    """First ``n`` rows by id for each of the given label values."""
    out = None
    for value in values:
        part = df.where(F.col(label) == F.lit(value)).orderBy(row_id).limit(n)
        out = part if out is None else out.unionByName(part)
    return out


def label_stats(df: DataFrame, label: str, score: str, prior: str) -> DataFrame:
    """Count, mean and sample deviation of a score, and mean prior, per label."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.stddev_samp(score).alias("sd_score"),
        F.avg(prior).alias("mean_prior"),
    )
