"""Prompt tables for batch inference, and parsing of the replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadrank.functions.text import strip
from leadrank.operators.ranking import top_n
from leadrank.operators.rows import exploded

# Chat roles.
SYSTEM, USER, ASSISTANT = "system", "user", "assistant"


def plain_number(value: Column) -> Column:
    """A double as the shortest decimal, with an exponent only outside 1e-4..1e16."""
    text = value.cast("string")
    parts = F.split(text, "E")
    exponent = F.get(parts, F.lit(1)).try_cast("int")
    mantissa = F.get(parts, F.lit(0))
    sign = F.when(F.startswith(mantissa, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    # Digits without sign, point and a trailing ".0".
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"^-|\.0$", ""), r"\.", "")
    whole = F.rpad(F.substr(digits, F.lit(1), exponent + 1), exponent + 1, F.lit("0"))
    tail = F.substr(digits, exponent + 2)
    large = F.concat(sign, whole, F.lit("."), F.when(tail == "", F.lit("0")).otherwise(tail))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    scientific = F.concat(
        sign,
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit("")),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    written = (
        F.when(exponent.isNull(), text)
        .when((exponent >= 0) & (exponent < 16), large)
        .when((exponent < 0) & (exponent >= -4), small)
        .otherwise(scientific)
    )
    return written


def row_prompt(df: DataFrame, columns: list[str] | None = None) -> Column:
    """``name: value`` for each non-null column, joined by ", "."""
    parts = []
    for name in columns or df.columns:
        col, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(kind, T.BooleanType):
            col = F.initcap(col.cast("string"))
        elif isinstance(kind, T.DoubleType):
            col = plain_number(col)
        parts.append(F.concat(F.lit(f"{name}: "), col.cast("string")))
    return F.concat_ws(", ", *parts)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def request_table(
    prompts: DataFrame, prompt: str, instructions: str, examples: DataFrame | None = None
) -> DataFrame:
    """Add ``messages``: system text, example pairs in order, then the row's prompt.

    ``examples`` is a short table ``(idx, input, output)``. All of it is part of every
    prompt, so a prompt's size bounds it; it comes in as one row.
    """
    last = F.array(message(USER, F.col(prompt)))
    first = F.array(message(SYSTEM, F.lit(instructions)))
    if examples is None:
        return prompts.withColumn("messages", F.concat(first, last))
    pairs = F.array_sort(F.collect_list(F.struct("idx", "input", "output")))
    shots = F.flatten(F.transform(pairs, lambda e: F.array(message(USER, e.input), message(ASSISTANT, e.output))))
    shown = examples.agg(shots.alias("shots"))
    with_shots = prompts.withColumn("_shots", shown.scalar())
    return with_shots.withColumn("messages", F.concat(first, "_shots", last)).drop("_shots")


def limited_result(df: DataFrame, row_id: str, n: int, column: str, result: Column) -> DataFrame:
    """All rows; ``column`` holds ``result`` for the first ``n`` by id, else null.

    The id of the n-th row is compared with, so only ids are ordered: in a cut that
    combines in each task for a small ``n``, through a range shuffle for a large one.
    """
    first = top_n(df.select(row_id), [F.asc(row_id)], n, out=None).agg(F.max(row_id).alias("last"))
    return df.withColumn(column, F.when(F.col(row_id) <= first.scalar(), result))


def founders(replies: DataFrame, reply_id: str, text: str) -> DataFrame:
    """``(reply_id, line, name, role)`` from reply lines ``Founder n: Name, Role``.

    Lines without ``: `` or without a role are dropped.
    """
    lines = exploded(replies, [reply_id], F.split(text, "\n"), "_raw", "line")
    people = lines.select(reply_id, "line", strip(F.col("_raw")).alias("_raw")).where(
        F.startswith("_raw", F.lit("Founder"))
    )
    named = people.withColumn("_who", F.get(F.split("_raw", ": "), F.lit(1))).where(F.col("_who").isNotNull())
    parts = named.withColumn("_parts", F.split("_who", ", ")).where(F.size("_parts") > 1)
    return parts.select(
        reply_id,
        "line",
        F.get("_parts", F.lit(0)).alias("name"),
        F.array_join(F.slice("_parts", F.lit(2), F.size("_parts")), ", ").alias("role"),
    )
