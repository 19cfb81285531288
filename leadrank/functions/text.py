"""Text expressions. All are built-in functions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The whitespace class used everywhere, and its characters.
WHITESPACE = r"[ \t\n\r\f\x0B]+"
WHITESPACE_CHARS = " \t\n\r\f\x0b"
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it as often as needed in ``body``.

    A plain column reference would be inlined by the optimizer into the lambdas
    of ``body`` and be evaluated again for each array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def clean_field(text: Column) -> Column:
    """Null to "", stripped, lower case."""
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    body = strip(text)
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, WHITESPACE)))


def word_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), BETWEEN_WORDS), lambda t: t != "")


def spaced_words(text: Column) -> Column:
    """The words of ``word_tokens`` in one run of bytes, a space between any two, perhaps one at either end."""
    return F.regexp_replace(F.lower(text), BETWEEN_WORDS, " ").cast("binary")


def has_words(text: Column) -> Column:
    """Does the text hold any letter or digit, so that it has tokens?

    Filter on this rather than on the tokens: a filter on a computed column is
    pushed to the scan and would compute it twice.
    """
    return text.rlike(r"[\p{L}\p{N}]")


def sentences(text: Column) -> Column:
    """Split at whitespace after ``.?!`` when an ASCII letter follows."""
    return F.split(text, r"(?<=[.?!])[ \t\n\r\f\x0B]+(?=[A-Za-z])")


def phrase_pattern(phrase: Column, escape: bool = True) -> Column:
    """Whole-word, case-blind pattern for a phrase."""
    body = phrase
    if escape:
        quoted = F.replace(phrase, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        body = F.concat(F.lit("\\Q"), quoted, F.lit("\\E"))
    return F.concat(F.lit("(?iU)\\b"), body, F.lit("\\b"))


def phrase_count(text: Column, phrase: Column, escape: bool = True) -> Column:
    """Non-overlapping whole-word occurrences of ``phrase``."""
    return F.regexp_count(F.lower(text), phrase_pattern(phrase, escape))


def substring_count(text: Column, term: Column) -> Column:
    """Non-overlapping occurrences of ``term`` as a plain substring."""
    removed = F.length(text) - F.length(F.replace(text, term, F.lit("")))
    return (removed / F.nullif(F.length(term), F.lit(0))).cast("bigint")


def spaced_tokens(text: Column) -> Column:
    """Words and punctuation marks separated by single spaces, lower case.

    Stands in for a linguistic tokenizer: every punctuation mark becomes its
    own token. It does not know abbreviations or contractions.
    """
    spaced = F.regexp_replace(F.lower(text), r"([^\p{L}\p{M}\p{N}_ \t\n\r\f\x0B])", " $1 ")
    return strip(F.regexp_replace(spaced, WHITESPACE, " "))


def reply_tail(text: Column) -> Column:
    """From the first ``of `` to the end of that line, or null."""
    return F.nullif(F.regexp_extract(text, r"(of [^\n]*)", 1), F.lit(""))
