"""Mail per contact: matching, numbering, long and wide tables, message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadrank.functions.text import clean_field
from leadrank.operators.ranking import numbered
from leadrank.session import Reuse

# The directions, in output order.
DIRECTIONS = ("from", "to")
#: Message columns of the wide table at most.
MAX_WIDE = 1000


def matched_ids(contacts: DataFrame, messages: DataFrame) -> DataFrame:
    """``(email, direction, message_id, sent)`` for matching mail, without bodies.

    Addresses are distinct on the contact side, so a busy address is a hot value
    on one side only, which adaptive execution can split. An address that is no
    contact, such as the mailbox's own, matches nothing and is dropped by the join.
    """
    own = F.array(F.struct(F.lit("from").alias("direction"), clean_field(F.col("from_addr")).alias("addr")))
    others = F.transform(
        F.array_distinct(F.transform("to_addrs", clean_field)),
        lambda a: F.struct(F.lit("to").alias("direction"), a.alias("addr")),
    )
    both = F.concat(own, F.coalesce(others, F.array().cast("array<struct<direction:string,addr:string>>")))
    addressed = messages.select("message_id", "sent", F.explode(both).alias("a"))
    people = contacts.select("email", clean_field(F.col("email")).alias("_addr")).where(F.col("_addr") != "").distinct()
    joined = addressed.join(people, F.col("a.addr") == F.col("_addr"))
    return joined.select("email", F.col("a.direction").alias("direction"), "message_id", "sent")


def contact_messages(contacts: DataFrame, messages: DataFrame) -> DataFrame:
    """``(email, direction, message_id, sent, content)`` for matching mail.

    ``contacts`` has ``email``; ``messages`` has ``message_id`` (unique), ``sent``,
    ``from_addr``, ``to_addrs`` (array) and ``content``. Bodies join last, by id.
    """
    return matched_ids(contacts, messages).join(messages.select("message_id", "content"), "message_id").select(
        "email", "direction", "message_id", "sent", "content"
    )


def message_index(matched: DataFrame, reuse: Reuse | None = None) -> DataFrame:
    """Add ``message_index``, 1-based within (email, direction), oldest first."""
    return numbered(matched, ["email", "direction"], ["sent", "message_id"], "message_index", reuse)


def long_table(contacts: DataFrame, messages: DataFrame, reuse: Reuse | None = None) -> DataFrame:
    """``(email, direction, message_index, message_content)``; contacts without mail drop out."""
    indexed = message_index(matched_ids(contacts, messages), reuse)
    bodies = messages.select("message_id", F.col("content").alias("message_content"))
    return indexed.join(bodies, "message_id").select("email", "direction", "message_index", "message_content")


def _wide(contacts: DataFrame, numbered_ids: DataFrame, with_content, max_columns: int) -> DataFrame:
    """One row per contact and group of slots; widths come from ``numbered_ids``, content from ``with_content``."""
    found = {r["direction"]: r["m"] for r in numbered_ids.groupBy("direction").agg(F.max("message_index").alias("m")).collect()}
    most = max(1, max_columns // len(DIRECTIONS))
    slots = [f"{d}_{i}" for d in DIRECTIONS for i in range(1, min(most, int(found.get(d) or 0)) + 1)]
    people = contacts.select("email").distinct()
    if not slots:
        return people.withColumn("row", F.lit(0).cast("bigint"))
    at = F.col("message_index") - 1
    slotted = with_content(numbered_ids).select(
        "email",
        F.floor(at / most).cast("bigint").alias("row"),
        F.concat_ws("_", "direction", (at % most + 1).cast("string")).alias("_slot"),
        "message_content",
    )
    pivoted = slotted.groupBy("email", "row").pivot("_slot", slots).agg(F.first("message_content"))
    return people.join(pivoted, "email", "left").withColumn("row", F.coalesce("row", F.lit(0).cast("bigint"))).select("email", "row", *slots)


def wide_table(contacts: DataFrame, long: DataFrame, max_columns: int = MAX_WIDE, reuse: Reuse | None = None) -> DataFrame:
    """``email``, ``row``, ``from_1..n``, ``to_1..m`` from a long table; contacts without mail kept.

    The width is the largest index found. A contact has one row, number 0, as long
    as no direction needs more than half of ``max_columns``; beyond that its mail
    goes on in rows 1, 2, ... The columns are the same either way.
    """
    return _wide(contacts, (reuse or Reuse()).keep(long), lambda ids: ids, max_columns)


def wide_mail(contacts: DataFrame, messages: DataFrame, max_columns: int = MAX_WIDE, reuse: Reuse | None = None) -> DataFrame:
    """``wide_table`` straight from messages: widths come from ids alone, and bodies join once, into their slots."""
    reuse = reuse or Reuse()
    ids = reuse.keep(message_index(matched_ids(contacts, messages), reuse).select("email", "direction", "message_index", "message_id"))
    bodies = messages.select("message_id", F.col("content").alias("message_content"))
    return _wide(contacts, ids, lambda found: found.join(bodies, "message_id"), max_columns)


def header_value(headers: Column, name: str) -> Column:
    """First header of that name, or ""."""
    return F.coalesce(F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0)).value, F.lit(""))


def decode_body(data: Column) -> Column:
    """Text of a base64url body."""
    return F.decode(F.unbase64(F.translate(data, "-_", "+/")), "utf-8")


def payload_of(json: Column) -> Column:
    """A message's payload, nested to any depth, from its JSON."""
    return F.parse_json(json)


def plain_text(parts: Column, steps: Column) -> Column:
    """First plain-text body, depth first; "" where there is none.

    ``parts`` is an array of variants. The search goes into the first multipart
    child only and does not come back when that holds no plain text, so it is a
    walk down: each step takes the first part that is plain text or has parts of
    its own. ``steps`` bounds their number and may be larger than the depth.
    """

    def body(p: Column) -> Column:
        return F.when(F.variant_get(p, "$.mimeType", "string") == "text/plain", F.variant_get(p, "$.body.data", "string"))

    def inner(p: Column) -> Column:
        return F.variant_get(p, "$.parts", "array<variant>")

    def step(state: Column, _: Column) -> Column:
        first = F.get(F.filter(state.parts, lambda p: body(p).isNotNull() | inner(p).isNotNull()), F.lit(0))
        down = F.struct(F.when(body(first).isNull(), inner(first)).alias("parts"), body(first).alias("data"))
        return F.when(state.parts.isNull(), state).otherwise(down)

    start = F.struct(parts.alias("parts"), F.lit(None).cast("string").alias("data"))
    found = F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, step, lambda state: state.data)
    return F.coalesce(decode_body(found), F.lit(""))


def message_text(payload: Column) -> Column:
    """``Subject: ...``, a blank line, and the plain text, of a payload as a variant."""
    headers = F.variant_get(payload, "$.headers", "array<struct<name:string,value:string>>")
    # A nested level has at least one key of that name.
    levels = F.regexp_count(F.to_json(payload), F.lit('"parts"'))
    parts = F.variant_get(payload, "$.parts", "array<variant>")
    return F.concat(F.lit("Subject: "), header_value(headers, "Subject"), F.lit("\n\n"), plain_text(parts, levels.cast("int") + 1))
