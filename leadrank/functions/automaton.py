"""Occurrences of many phrases in a text, found in one pass.

An Aho-Corasick automaton holds all phrases of a key table. It is built once,
sent to the workers once, and every text runs through it once, however many
phrases there are. Occurrences of one phrase do not overlap: the leftmost counts
first, as a regular expression would count them.

With whole words, case is ignored one character at a time and an occurrence needs
a word boundary on both sides, as the pattern ``(?iU)\\b...\\b`` does. Word
characters are letters, marks, decimal digits, connecting punctuation and the two
joiners.
"""

from __future__ import annotations

import functools

import numpy as np


@functools.cache
def folding() -> dict[int, str]:
    """Characters that stand for another one where case is ignored."""

    def one(c: str, change) -> str:
        made = change(c)
        return made if len(made) == 1 else c

    out = {}
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            c = chr(code)
            f = one(one(c, str.upper), str.lower)
            if f != c:
                out[code] = f
    return out


@functools.cache
def word_flags() -> bytes:
    """For each code point, 1 if it belongs to a word."""
    import regex

    flags = bytearray(0x110000)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for m in regex.finditer("[\\p{Alphabetic}\\p{M}\\p{Nd}\\p{Pc}\u200c\u200d]+", every):
        for c in m.group():
            flags[ord(c)] = 1
    return bytes(flags)


def build(names: list[str], whole_words: bool) -> tuple:
    """What workers need: automaton or None, phrases by entry, their lengths, empty phrases, folding and flags.

    Plain values and library objects only, so that workers need not have this
    package.
    """
    import ahocorasick

    fold = folding() if whole_words else None
    entries: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        entries.setdefault(name.translate(fold) if fold else name, []).append(k)
    empty = entries.pop("", [])
    made = None
    if entries:
        made = ahocorasick.Automaton()
        for at, phrase in enumerate(entries):
            made.add_word(phrase, at)
        made.make_automaton()
    return made, list(entries.values()), [len(p) for p in entries], empty, fold, word_flags() if whole_words else None


def occurrences(text: str, finder: tuple) -> dict[int, int]:
    """Number of occurrences of each phrase that occurs, by its place in the key table.

    An empty phrase occurs at every word boundary, and without whole words not at
    all.
    """
    automaton, keys, lengths, empty, fold, flags = finder
    if fold is not None:
        text = text.translate(fold)
    counts: dict[int, int] = {}
    ends: dict[int, int] = {}
    size = len(text)
    if automaton is not None:
        for last, at in automaton.iter(text):
            start, end = last + 1 - lengths[at], last + 1
            if start < ends.get(at, 0):
                continue
            if flags is not None:
                before = flags[ord(text[start - 1])] if start else 0
                behind = flags[ord(text[end])] if end < size else 0
                if before == flags[ord(text[start])] or behind == flags[ord(text[last])]:
                    continue
            ends[at] = end
            counts[at] = counts.get(at, 0) + 1
    out = {k: n for at, n in counts.items() for k in keys[at]}
    if empty and flags is not None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.frombuffer(flags, np.uint8)[codes]
        n = int((np.diff(np.concatenate([[0], inside, [0]]).astype(np.int8)) != 0).sum())
        out |= {k: n for k in empty if n}
    return out
