"""Token ids of whole texts by the tokenizers library, with distinct chunks encoded once.

Texts are cut at single spaces and line breaks. Arrow turns the chunks of a
group of texts into one integer per distinct chunk, the library encodes only
chunks that are new, and the ids of all texts are one numpy gather. New chunks go
to the library many at a time, joined by a special token of the vocabulary, whose
id then parts the results; the library treats what lies between special tokens
as texts of their own.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Marks that may end a word of letters: those of ASCII, without digits.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Letters of scripts whose letters and lower case all tools agree on, one character for one: Latin, Greek, Cyrillic,
#: kana, Han and Hangul. Texts of these alone are composed already.
LETTERS = (
    "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0391-\u03a1\u03a4-\u03ce\u03d8-\u03ef\u0400-\u0481\u048a-\u052f"
    "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)
#: How byte-level vocabularies write a space.
SPACE = "\u0120"
#: Marks behind a word at most, and runs of marks that are kept.
TAIL, MAX_TAILS = 8, 100_000
#: Before chunks that are no word of letters, in the table of known ones.
OTHER = "\0"
#: Forms that are kept at most, and forms in one call of the library.
KEPT, JOINED = 400_000, 2_000
#: Characters of texts that are encoded together; more of them share more chunks.
GROUP = 4_000_000


def tokenizer_of(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_characters() -> str:
    """The character that stands for each byte: itself where it is a visible one, else one from 256 on; spaces stay."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    of = {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return "".join(" " if b == 32 else of[b] for b in range(256))


BYTE_CHARACTERS = _byte_characters()


def _word_model(library):
    """The library's model behind a split at white space, without its normalizer."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    made = Tokenizer(library.model)
    made.pre_tokenizer = WhitespaceSplit()
    return made


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``starts[i], starts[i] + 1, ...`` of all runs, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class ChunkTable:
    """Ids of known chunks: ``ids[starts[k] : starts[k] + sizes[k]]`` for slot ``k``; size -1 where a chunk has none.

    When more than ``size`` chunks would be known, those of the present group that
    came before stay and all others go.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], size: int = KEPT) -> None:
        self.make, self.size = make, size
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        real = np.maximum(sizes, 0)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(real) - real])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def slots(self, chunks: list[str]) -> np.ndarray:
        """Slot of each of these distinct chunks."""
        got = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        unknown = np.flatnonzero(got < 0)
        if not len(unknown):
            return got
        new = [chunks[k] for k in unknown.tolist()]
        if len(self.known) + len(new) > self.size:
            held = np.flatnonzero(got >= 0)
            old = got[held]
            starts, sizes, ids = self.starts[old], self.sizes[old], self.ids
            self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)
            self._append(ids[ragged(starts, np.maximum(sizes, 0))], sizes)
            self.known = dict(zip([chunks[k] for k in held.tolist()], range(len(held)), strict=True))
            got[held] = np.arange(len(held))
        first = len(self.sizes)
        self._append(*self.make(new))
        self.known.update(zip(new, range(first, first + len(new)), strict=True))
        got[unknown] = first + np.arange(len(new))
        return got


class ChunkedEncoder:
    """Base: the library, the bulk encoding of chunks, and the gather.

    Most chunks are a word of plain letters, perhaps with marks behind it. The
    library's split parts the two; the marks are few and encoded once, and words go
    to the vocabulary's model without normalizer and split, many at a time, for
    which nothing is left to do there.
    """

    def __init__(self, path: str) -> None:
        self.library = tokenizer_of(path)
        added = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        #: Whether no special token lies within letters and marks.
        self.plain = all(re.search(f"[{re.escape(MARKS)}][^{re.escape(MARKS)}]", s) for s in self.special)
        # A token that takes white space beside it would not part chunks cleanly.
        clean = [(i, t.content) for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.normalized)]
        self.mark_id, self.mark = clean[0] if clean else (None, "")
        self.cache = ChunkTable(self._new)
        self.tails: dict[str, np.ndarray] = {"": np.empty(0, np.uint32)}
        self.words = _word_model(self.library)
        names = self.library.get_vocab(with_added_tokens=False)
        self.edge = np.zeros(max(names.values(), default=0) + 1, bool)
        for name, i in names.items():
            self.edge[i] = self.at_edge(name)

    def at_edge(self, token: str) -> bool:
        """Whether every word has just one such token, at the end that ``EDGE_LAST`` tells."""
        raise NotImplementedError

    #: Whether the token that parts words is the last one of a word.
    EDGE_LAST = True

    @property
    def vocabulary(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids straight from the library."""
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _bulk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of texts that hold no special token."""
        parts, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for a in range(0, len(texts), JOINED):
            some = texts[a : a + JOINED]
            if self.mark_id is None:
                each = self.whole(some)
                parts += each
                sizes.append(np.array([len(x) for x in each], np.int64))
                continue
            ids = self.whole([self.mark.join(some)])[0]
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) != len(some) - 1:
                raise ValueError("a special token does not part chunks")
            sizes.append(np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            parts.append(np.delete(ids, cuts))
        return np.concatenate(parts), np.concatenate(sizes)

    def mapped(self, words: list[str]) -> str:
        """Words in the characters that byte-level vocabularies write bytes in, with spaces between them."""
        return codecs.charmap_decode(" ".join(words).encode(), "strict", BYTE_CHARACTERS)[0]

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and number of ids of words of plain letters."""
        parts, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for a in range(0, len(words), JOINED):
            some = words[a : a + JOINED]
            ids = np.array(self.words.encode_batch_fast([self.mapped(some)], add_special_tokens=False)[0].ids, np.uint32)
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(some):
                raise ValueError("words do not part")
            sizes.append(np.diff(np.append(-1, edges)) if self.EDGE_LAST else np.diff(np.append(edges, len(ids))))
            parts.append(ids)
        return np.concatenate(parts), np.concatenate(sizes)

    def _new(self, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of new forms; size -1 for chunks whose text must go to the library whole."""
        other = np.array([f.startswith(OTHER) for f in forms], bool)
        texts = [self.form(f[len(OTHER) :]) for f in forms if f.startswith(OTHER)]
        ids, sizes = self._word_ids([f for f in forms if not f.startswith(OTHER)])
        more, more_sizes = self._bulk([t for t in texts if t is not None])
        place = np.empty(len(forms), np.int64)
        place[~other] = np.arange(len(sizes))
        good = np.array([t is not None for t in texts], bool)
        at = np.full(len(texts), -1, np.int64)
        at[good] = len(sizes) + np.arange(int(good.sum()))
        place[other] = at
        ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, more_sizes])
        starts = np.cumsum(sizes) - sizes
        own = np.where(place >= 0, np.append(sizes, 0)[place], 0)
        return ids[ragged(np.append(starts, 0)[place], own)], np.where(place >= 0, own, -1)

    def word(self, words: pa.Array) -> pa.Array:
        """Words as the vocabulary's model takes them."""
        return words

    def form(self, chunk: str) -> str | None:
        """The text to encode for a chunk that is no word; None if it cannot stand alone."""
        raise NotImplementedError

    def parted(self, chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Form of each distinct chunk, and the marks behind those that are words."""
        words = pc.utf8_rtrim(chunks, characters=MARKS)
        behind = pc.subtract(pc.binary_length(chunks), pc.binary_length(words)).to_numpy()
        plain = pc.match_substring_regex(words, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False) & (behind <= TAIL) & self.plain
        tails = np.full(len(chunks), "", object)
        for n in range(1, TAIL + 1):
            at = np.flatnonzero(plain & (behind == n))
            if len(at):
                tails[at] = pc.utf8_slice_codeunits(chunks.take(pa.array(at)), start=-n).to_pylist()
        mask = pa.array(plain)
        forms = pc.if_else(mask, self.word(words), pc.binary_join_element_wise(pa.scalar(OTHER), chunks, ""))
        return forms, pa.array(tails, pa.string())

    def joined(self, forms: pa.Array, tails: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after the other, and their sizes; -1 where a chunk has none."""
        coded, ends = forms.dictionary_encode(), tails.dictionary_encode()
        slots = self.cache.slots(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        names = ends.dictionary.to_pylist()
        new = [t for t in names if t not in self.tails]
        self.tails.update(zip(new, self.whole(new), strict=True))
        held = [self.tails[t] for t in names]
        if len(self.tails) > MAX_TAILS:
            self.tails = {"": self.tails[""]}
        end_sizes = np.array([len(e) for e in held], np.int64)
        end = ends.indices.to_numpy()
        sizes = self.cache.sizes[slots]
        own = np.maximum(sizes, 0)
        behind = np.where(sizes < 0, 0, end_sizes[end])
        full = own + behind
        to = np.cumsum(full) - full
        out = np.empty(int(full.sum()), np.uint32)
        out[ragged(to, own)] = self.cache.ids[ragged(self.cache.starts[slots], own)]
        out[ragged(to + own, behind)] = np.concatenate(held)[ragged((np.cumsum(end_sizes) - end_sizes)[end], behind)]
        return out, np.where(sizes < 0, -1, full)

    def chunks(self, texts: pa.Array) -> pa.ListArray:
        raise NotImplementedError

    def first(self, chunks: list[str]) -> list[str] | None:
        """What the first chunks of texts are known by, where it is not themselves."""
        return None

    def flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        column = pa.array([t or "" for t in texts], pa.string())
        split = self.chunks(column)
        offsets = split.offsets.to_numpy().astype(np.int64)
        every = split.flatten()
        coded = every.dictionary_encode()
        slots = coded.indices.to_numpy().astype(np.int64)
        forms, tails = self.parted(coded.dictionary)
        heads = self.first(every.take(pa.array(offsets[:-1])).to_pylist())
        if heads:
            # First chunks have forms of their own, behind the others.
            place = {c: len(forms) + k for k, c in enumerate(dict.fromkeys(heads))}
            slots[offsets[:-1]] = [place[c] for c in heads]
            forms = pa.concat_arrays([forms, pa.array([OTHER + c for c in place], pa.string())])
            tails = pa.concat_arrays([tails, pa.array([""] * len(place), pa.string())])
        known, own = self.joined(forms, tails)
        starts = np.cumsum(np.maximum(own, 0)) - np.maximum(own, 0)
        sizes = own[slots]
        odd = np.zeros(len(slots) + 1, np.int64)
        np.cumsum(sizes < 0, out=odd[1:])
        whole = np.flatnonzero(odd[offsets[1:]] > odd[offsets[:-1]])
        sizes = np.maximum(sizes, 0)
        ids = known[ragged(starts[slots], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        lengths = np.diff(ends)
        if len(whole):
            parts = np.split(ids, ends[1:-1])
            for k, own_ids in zip(whole.tolist(), self.whole([column[k].as_py() for k in whole.tolist()]), strict=True):
                parts[k], lengths[k] = own_ids, len(own_ids)
            ids = np.concatenate(parts)
        return ids, lengths

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        ids, lengths = self.flat(texts)
        data = ids.astype("<u4").tobytes()
        places = [0, *(4 * np.cumsum(lengths)).tolist()]
        return [data[a:b] for a, b in zip(places, places[1:])]


class ByteLevelEncoder(ChunkedEncoder):
    """For byte-level vocabularies, where white space counts.

    A chunk stands for itself and a space before it, one that starts with a line
    break for itself alone. A text with other runs of white space, or with a
    special token, goes to the library whole.
    """

    #: Before the first chunk of a text. No chunk holds a line break but at its start.
    FIRST = "\n\n"
    EDGE_LAST = False

    def at_edge(self, token: str) -> bool:
        return token.startswith(SPACE)

    def mapped(self, words: list[str]) -> str:
        return SPACE + super().mapped(words).replace(" ", f" {SPACE}")

    def form(self, chunk: str) -> str | None:
        lead = self.FIRST if chunk.startswith(self.FIRST) else "\n" if chunk.startswith("\n") else ""
        body = chunk[len(lead) :]
        if body.strip() != body or body == "" or any(s in body for s in self.special):
            return None
        return {"": " ", "\n": "\n", self.FIRST: ""}[lead] + body

    def chunks(self, texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")

    def first(self, chunks: list[str]) -> list[str]:
        # A text that starts with white space is odd; an empty one is odd too, and has no ids.
        return [self.FIRST + c for c in chunks]


class WordLevelEncoder(ChunkedEncoder):
    """For vocabularies of word pieces with word ends, which drop white space.

    What stands between white space is split and encoded by itself. A text with a
    special token goes to the library whole.
    """

    def at_edge(self, token: str) -> bool:
        return token.endswith("</w>")

    def word(self, words: pa.Array) -> pa.Array:
        # The vocabulary has lower case only.
        return pc.utf8_lower(words)

    def form(self, chunk: str) -> str | None:
        if any(s in chunk.lower() for s in self.special):
            return None
        return chunk

    def chunks(self, texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
