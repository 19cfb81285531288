"""Company table clean-up and contact checks. Every step is narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadrank.functions.contacts import (
    COLUMN_PREFIX,
    FIELDS,
    SLOTS,
    email_plausible,
    slot_column,
    title_rank,
)
from leadrank.functions.text import clean_field, strip


def drop_merge_leftovers(df: DataFrame) -> DataFrame:
    """Drop ``*_y`` columns and strip ``_x`` from the others."""
    kept = [(c, c[:-2] if c.endswith("_x") else c) for c in df.columns if not c.endswith("_y")]
    names = [new for _, new in kept]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"columns would repeat after clean-up: {repeated}")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in kept])


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[column])


def people_array(prefix: str = COLUMN_PREFIX) -> Column:
    """The contact slots of a row as ``array<struct<slot, title, ...>>``, cleaned."""
    return F.array(
        *[
            F.struct(
                F.lit(slot).alias("slot"),
                *[clean_field(F.col(f"`{slot_column(f, slot, prefix)}`")).alias(f) for f in FIELDS],
            )
            for slot in SLOTS
        ]
    )


def unpack_contacts(df: DataFrame, row_id: str, prefix: str = COLUMN_PREFIX) -> DataFrame:
    """One row per contact slot."""
    return df.select(row_id, F.inline(people_array(prefix)))


def named_with_email(p: Column) -> Column:
    return ((p.first_name != "") | (p.last_name != "")) & (p.email != "")


def plausible(p: Column) -> Column:
    return named_with_email(p) & email_plausible(p.first_name, p.last_name, p.email)


def compact_contacts(df: DataFrame, prefix: str = COLUMN_PREFIX) -> DataFrame:
    """Keep plausible people, most senior first, in slots 1..k; blank the rest."""
    kept = F.filter(people_array(prefix), plausible)
    by_rank = F.array_sort(
        F.transform(
            kept,
            lambda p: F.struct(
                title_rank(p.title).alias("rank"), p.slot.alias("slot"), *[p[f].alias(f) for f in FIELDS]
            ),
        )
    )
    staged = df.withColumn("_people", by_rank)
    replaced = {
        slot_column(f, slot, prefix): F.coalesce(F.get("_people", F.lit(slot - 1))[f], F.lit(""))
        for slot in SLOTS
        for f in FIELDS
    }
    return staged.select(*[replaced[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in df.columns])


def reachable(df: DataFrame, prefix: str = COLUMN_PREFIX) -> DataFrame:
    """Rows whose first contact has an e-mail; run after ``compact_contacts``."""
    return df.where(F.col(f"`{slot_column('email', 1, prefix)}`") != "")


def has_plausible_contact(prefix: str = COLUMN_PREFIX) -> Column:
    """True for the rows that ``reachable`` keeps, without rewriting the slots."""
    return F.exists(people_array(prefix), plausible)


def contact_list(df: DataFrame, column: str) -> DataFrame:
    """Trimmed, non-blank, distinct addresses."""
    return df.select(strip(F.col(column)).alias(column)).where(F.col(column) != "").distinct()
