"""SentencePiece encoding with a score-ordered agenda of adjacent symbol pairs.

A text is cut at spaces and line breaks. No piece of a merge-type vocabulary
reaches over such a cut (this is checked when the vocabulary is loaded), so
each distinct chunk is encoded once per task and looked up afterwards. The
agenda of a chunk holds the rank of every adjacent pair of symbols; the best
pair is taken, leftmost first, joined, and the pairs at both sides get new
ranks. Agendas of many chunks are rows of one numpy matrix and advance
together; long chunks use a heap. Symbols outside the vocabulary become bytes.

Every new chunk is checked against the sentencepiece library, as is one whole
text per group of texts; a difference is an error.

Null and empty texts have no ids and decode to the empty string. Very long texts are
encoded whole; their chunks are checked like all others, but not the text at once. Repeated rows
stay. Other columns pass through untouched.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from leadrank.llm.shared import ChunkCache, groups_of, once, pieces_of

SPACE = "▁"
NEVER = np.int32(2**31 - 1)
#: Chunks of more symbols than this use the heap.
WIDE = 48


class Pairs:
    """Merge table of a vocabulary: (left symbol, right symbol) -> rank, joined symbol."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = self.library.get_piece_size()
        lib = self.library
        plain = [i for i in range(n) if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.text = {lib.id_to_piece(i): i for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for piece in self.text:
            if (SPACE in piece.strip(SPACE)) or (SPACE in piece[1:] and piece.strip(SPACE)) or "\n" in piece:
                raise ValueError(f"a piece reaches over a space: {piece!r}")
        # Characters that are no piece by themselves but occur in one get symbols from n up.
        self.symbol = {c: i for c, i in self.text.items() if len(c) == 1}
        self.outside: list[str] = []
        for piece in self.text:
            for c in piece:
                if c not in self.symbol:
                    self.symbol[c] = n + len(self.outside)
                    self.outside.append(c)
        self.n = n
        self.base = n + len(self.outside)
        scores = sorted({lib.get_score(i) for i in plain}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        known = dict(self.text) | {c: s for c, s in self.symbol.items()}
        keys, ranks, joined = [], [], []
        for piece, i in self.text.items():
            for cut in range(1, len(piece)):
                left, right = known.get(piece[:cut]), known.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.base + right)
                    ranks.append(rank[lib.get_score(i)])
                    joined.append(i)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.joined = np.array(joined, np.int32)[order]
        # Open addressing over twice as many slots: one or two reads a pair.
        bits = int(len(keys) * 4).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        at = self._slot(self.keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.slots[at[todo]] < 0
            first = todo[free]
            self.slots[at[first]] = first
            lost = todo[self.slots[at[todo]] != todo]
            at[lost] = (at[lost] + 1) & (len(self.slots) - 1)
            todo = lost
        self.table = {k: (r, j) for k, r, j in zip(self.keys.tolist(), self.ranks.tolist(), self.joined.tolist(), strict=True)}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in the table, -1 if it is none."""
        keys = left.astype(np.int64) * self.base + right
        keys[(left < 0) | (right < 0)] = -1
        found = np.full(len(keys), -1, np.int64)
        todo = np.flatnonzero(keys >= 0)
        at = self._slot(keys[todo])
        while len(todo):
            entry = self.slots[at]
            hit = (entry >= 0) & (self.keys[entry] == keys[todo])
            found[todo[hit]] = entry[hit]
            on = (entry >= 0) & ~hit
            todo, at = todo[on], (at[on] + 1) & (len(self.slots) - 1)
        return found

    def finish(self, symbols: list[int], chars: str) -> list[int]:
        """Ids of final symbols: characters outside the vocabulary become bytes.

        ``chars`` are the characters of the chunk; ``symbols`` holds -1 - position
        for those that are in no piece.
        """
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < self.n:
                ids.append(s)
            else:
                c = self.outside[s - self.n] if s >= self.n else chars[-1 - s]
                ids.extend(self.bytes[b] for b in c.encode("utf-8"))
        return ids

    def by_heap(self, chunk: str) -> list[int]:
        """Ids of one chunk; the agenda is a heap of (rank, position)."""
        sym = [self.symbol.get(c, -1 - i) for i, c in enumerate(chunk)]
        n, base, table = len(sym), self.base, self.table
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and sym[i] >= 0 and sym[j] >= 0 and (hit := table.get(sym[i] * base + sym[j])):
                heapq.heappush(agenda, (hit[0], i, sym[i], sym[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i]
            if gone[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i] = table[a * base + b][1]
            gone[j] = True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return self.finish([s for s, g in zip(sym, gone, strict=True) if not g], chunk)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk."""
        out: list = [None] * len(chunks)
        by_width: dict[int, list[int]] = {}
        for i, c in enumerate(chunks):
            if len(c) > WIDE:
                out[i] = self.by_heap(c)
            else:
                by_width.setdefault(-(-len(c) // 6) * 6, []).append(i)
        for width, rows in by_width.items():
            for k in range(0, len(rows), 50_000):
                self._together(chunks, rows[k : k + 50_000], width, out)
        return out

    def _together(self, chunks: list[str], rows: list[int], width: int, out: list) -> None:
        """Advance the agendas of many chunks, one row each."""
        width = max(width, 2)
        texts = [chunks[r] for r in rows]
        codes = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        values, back = np.unique(codes, return_inverse=True)
        first = np.array([self.symbol.get(chr(v), -1) for v in values.tolist()], np.int64)
        n = len(texts)
        sizes = np.fromiter(map(len, texts), np.int64, n)
        sym = first[back].reshape(n, width)
        place = np.arange(width)
        inside = place[None, :] < sizes[:, None]
        sym[inside & (sym < 0)] = (-1 - np.broadcast_to(place, sym.shape))[inside & (sym < 0)]
        sym[~inside] = -(10**6)
        before = np.tile(np.arange(-1, width - 1, dtype=np.int16), (n, 1))
        after = np.tile(np.arange(1, width + 1, dtype=np.int16), (n, 1))
        agenda = np.full((n, width), NEVER, np.int32)
        entry = np.full((n, width), -1, np.int64)
        r, c = np.nonzero((sym[:, :-1] >= 0) & (sym[:, 1:] >= 0))

        def offer(r: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
            found = self.look_up(sym[r, i], sym[r, j])
            entry[r, i] = found
            agenda[r, i] = np.where(found >= 0, self.ranks[found], NEVER)

        offer(r, c, c + 1)
        live = np.flatnonzero(agenda.min(axis=1) < NEVER) if n else np.empty(0, np.int64)
        while len(live):
            own = agenda[live]
            i = own.argmin(axis=1)
            going = own[np.arange(len(live)), i] < NEVER
            live, i = live[going], i[going]
            if not len(live):
                break
            j = after[live, i].astype(np.int64)
            sym[live, i] = self.joined[entry[live, i]]
            sym[live, j] = -(10**6)
            agenda[live, j] = NEVER
            nxt = after[live, j].astype(np.int64)
            after[live, i] = nxt
            has = nxt < width
            before[live[has], nxt[has]] = i[has]
            agenda[live, i] = NEVER
            has &= sym[live, np.minimum(nxt, width - 1)] > -(10**6)
            offer(live[has], i[has], nxt[has])
            b = before[live, i].astype(np.int64)
            has = b >= 0
            offer(live[has], b[has], i[has])
        kept = sym > -(10**6)
        counts = kept.sum(axis=1)
        flat = sym[kept]
        odd = (flat < 0) | (flat >= self.n)
        ends = np.cumsum(counts)
        whole = flat.tolist()
        odd_rows = set(np.searchsorted(ends, np.flatnonzero(odd), side="right").tolist())
        start = 0
        for k, end in enumerate(ends.tolist()):
            ids = whole[start:end]
            out[rows[k]] = self.finish(ids, texts[k]) if k in odd_rows else ids
            start = end


class Encoder:
    """Encodes groups of texts with cached chunks."""

    def __init__(self, model_file: str) -> None:
        self.pairs = Pairs(model_file)
        self.cache = ChunkCache(self._new)

    def _new(self, chunks: list[str]) -> list[bytes | None]:
        """Ids of new chunks as int32 bytes; None for chunks whose text must be cut otherwise."""
        plain = [c for c in chunks if c and SPACE not in c]
        ours = self.pairs.encode([c if c[0] == "\n" else SPACE + c for c in plain])
        theirs = self.pairs.library.encode(plain, num_threads=1) if plain else []
        out = {}
        for c, a, b in zip(plain, ours, theirs, strict=True):
            # The library puts a space before each chunk; a line break joins with none.
            if a != (b[1:] if c[0] == "\n" else b):
                raise ValueError(f"ids differ from the library's for {c!r}: {a} {b}")
            out[c] = np.array(a, np.int32).tobytes()
        return [out.get(c) for c in chunks]

    def whole(self, text: str) -> bytes:
        """Ids of a text with runs of spaces, by runs of space marks and what follows."""
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        chunks, start = [], 0
        for k in range(1, len(marked)):
            if marked[k] == SPACE and marked[k - 1] != SPACE:
                chunks.append(marked[start:k])
                start = k
        chunks.append(marked[start:])
        ids = [i for part in self.pairs.encode(chunks) for i in part]
        if ids != self.pairs.library.encode(text, num_threads=1):
            raise ValueError("ids differ from the library's for a text with runs of spaces")
        return np.array(ids, np.int32).tobytes()

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as int32 bytes."""
        split = [pieces_of(t) if t else [] for t in texts]
        known = self.cache.of(set().union(*split)) if split else {}
        checked = False
        for text, chunks in zip(texts, split, strict=True):
            try:
                ids = b"".join([known[c] for c in chunks])
            except TypeError:
                yield self.whole(text)
                continue
            if ids and not checked and len(text) < 100_000:
                checked = True
                if np.frombuffer(ids, np.int32).tolist() != self.pairs.library.encode(text, num_threads=1):
                    raise ValueError("ids differ from the library's for a whole text")
            yield ids


def encode_decode(docs: DataFrame, model_file: str, text: str = "text", decode: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, if asked for, ``decoded`` in place of the text column.

    Runs in the scan's tasks, without a shuffle.
    """
    others = [f for f in docs.schema.fields if f.name != text and f.name not in ("ids", "decoded")]
    fields = [*others, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    if decode:
        fields.append(T.StructField("decoded", T.StringType(), False))
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(f"sentencepieces {model_file}", lambda: Encoder(model_file))
        for rows in batches:
            texts = rows.column(len(names)).to_pylist()
            for a, b in groups_of(texts):
                parts = list(encoder.ids(texts[a:b]))
                ids = pa.array(np.frombuffer(b"".join(parts), np.int32))
                ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
                made = [pa.ListArray.from_arrays(pa.array(ends), ids)]
                if decode:
                    lib = encoder.pairs.library
                    made.append(pa.array([lib.decode(np.frombuffer(p, np.int32).tolist()) if p else "" for p in parts], pa.string()))
                kept = [rows.column(k).slice(a, b - a) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(kept + made, names=[*names, "ids", "decoded"][: len(kept) + len(made)])

    return docs.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text}`")).mapInArrow(run, T.StructType(fields))


def digests(encoded: DataFrame) -> DataFrame:
    """Number and SHA-256 of ids and decoded text, per row."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
