"""Expressions over one person: title, first name, last name, e-mail."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadrank.functions.text import WHITESPACE_CHARS

# The four fields of a contact slot and the column-name pattern.
FIELDS = ("title", "first_name", "last_name", "email")
SLOTS = (1, 2, 3)
COLUMN_PREFIX = "Apollo contact data_"

# Title words per rank, in test order; all other titles rank 4.
TITLE_RANKS = (
    (0, ("owner", "ceo", "chief executive officer")),
    (1, ("founder",)),
    (3, ("vp", "vice president", "vice-president")),
    (2, ("president", "executive")),
)
OTHER_RANK = 4


def slot_column(field: str, slot: int, prefix: str = COLUMN_PREFIX) -> str:
    return f"{prefix}{field}_{slot}"


def email_plausible(first: Column, last: Column, email: Column) -> Column:
    """Does the address look like it belongs to the person?

    One ``@``, a dotted domain, and a name inside the local part; for local
    parts of up to three characters both initials suffice. A blank name is
    part of anything.
    """
    parts = F.split(email, "@")
    local = F.btrim(F.lower(F.get(parts, F.lit(0))), F.lit(WHITESPACE_CHARS))
    shaped = (F.size(parts) == 2) & F.contains(F.get(parts, F.lit(1)), F.lit("."))
    named = F.contains(local, first) | F.contains(local, last)
    initials = (
        (F.length(local) <= 3)
        & F.contains(local, F.substring(first, 1, 1))
        & F.contains(local, F.substring(last, 1, 1))
    )
    return shaped & (named | initials)


def title_rank(title: Column) -> Column:
    """Seniority of a lower-case title: 0 is most senior."""
    chain = None
    for rank, words in TITLE_RANKS:
        found = F.lit(False)
        for word in words:
            found = found | F.contains(title, F.lit(word))
        chain = F.when(found, F.lit(rank)) if chain is None else chain.when(found, F.lit(rank))
    return chain.otherwise(F.lit(OTHER_RANK))
