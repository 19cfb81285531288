"""FM-index over integer words: wavelet matrix, backward search, smallest owner of a match.

The index of a shard holds many short segments, each with an owner. Its suffix
order is exact up to ``DEPTH`` words, the longest pattern that is asked for, so
that backward search is exact for such patterns. The wavelet matrix keeps one
packed bit per word and level, with a running count for every 64 bits.
"""

from __future__ import annotations

import numpy as np

#: Longest pattern, and words to which the suffixes are sorted.
DEPTH = 128


def suffix_order(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions in the order of their first ``depth`` symbols, by prefix doubling."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < depth:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(max(rank.max(), n)) + 2) + follow
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        place = np.zeros(n, np.int64)
        place[1:] = np.cumsum(sorted_[1:] != sorted_[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = place
        if place[-1] == n - 1:
            break
        step *= 2
    return order


class Wavelet:
    """Wavelet matrix: how often a symbol stands before a position."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.levels = max(1, int(symbols - 1).bit_length())
        n = len(values)
        words = n // 64 + 1
        self.bits = np.zeros((self.levels, words), np.uint64)
        self.counts = np.zeros((self.levels, words), np.int64)
        self.zeros = np.zeros(self.levels, np.int64)
        now = values.astype(np.int64)
        for level in range(self.levels):
            bit = (now >> (self.levels - 1 - level)) & 1
            full = np.zeros(words * 64, np.uint8)
            full[:n] = bit
            self.bits[level] = np.packbits(full, bitorder="little").view("<u8")
            ones = np.bitwise_count(self.bits[level]).astype(np.int64)
            self.counts[level] = np.cumsum(ones) - ones
            self.zeros[level] = n - int(bit.sum())
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        # Where each symbol starts in the last level's order.
        self.first = self.walk(np.arange(symbols), np.zeros(symbols, np.int64))

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][block] + np.bitwise_count(self.bits[level][block] & below)
            bit = (symbol >> (self.levels - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self.walk(symbol, at) - self.first[symbol]


class FMIndex:
    """Index of segments. ``owners`` are compared by order; equal owners are one."""

    def __init__(self, segments: list[np.ndarray], owners: np.ndarray) -> None:
        sizes = np.array([len(s) + 1 for s in segments], np.int64)
        n = int(sizes.sum())
        ends = np.cumsum(sizes) - 1
        text = np.zeros(n, np.uint64)
        word = np.ones(n, bool)
        word[ends] = False
        text[word] = np.concatenate(segments)
        values, ids = np.unique(text[word], return_inverse=True)
        self.values = values
        self.text = np.zeros(n, np.int64)  # 0 ends a segment
        self.text[word] = ids + 1
        self.starts = ends + 1 - sizes
        self.sizes = sizes - 1
        order = suffix_order(self.text)
        symbols = len(values) + 1
        self.wavelet = Wavelet(self.text[order - 1], symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=symbols))])[:-1]
        self.n = n
        least = np.repeat(owners, sizes)[order]
        # Smallest owner of every run of 2^k rows.
        self.least = [least]
        step = 1
        while 2 * step <= n:
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns with one more symbol in front."""
        m = len(symbol)
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.before[symbol] + both[:m], self.before[symbol] + both[m:]

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest owner among non-empty row ranges."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.least[0].dtype)
        for k in np.unique(level).tolist():
            of = level == k
            table = self.least[k]
            out[of] = np.minimum(table[low[of]], table[high[of] - (1 << k)])
        return out

    def earlier(self, asked: np.ndarray, owners: np.ndarray, length: int) -> list[np.ndarray]:
        """For the asked segments, which windows of ``length`` words also lie in a segment of a smaller owner.

        The segments are streamed together, one backward step for all of them at
        a time. Each one asks for a run of windows at once: matching statistics
        say that if the run's whole string has an earlier owner, so has every
        window in it. It begins with all its windows, then with one, and doubles
        the run after a success. When a single window fails after matching back
        to position ``f + 1``, no window that holds ``[f, end]`` can match, and
        the next one to ask for starts behind ``f``.
        """
        start = self.starts[asked]
        windows = self.sizes[asked] - length + 1
        marks = [np.zeros(int(w), bool) for w in windows]
        lane = np.flatnonzero(windows > 0)
        s, run = np.zeros(len(lane), np.int64), windows[lane].copy()
        at = start[lane] + s + length - 2 + run
        low, high = np.zeros(len(lane), np.int64), np.full(len(lane), self.n, np.int64)
        while len(lane):
            low, high = self.extend(self.text[at], low, high)
            own = owners[lane]
            good = high - low > 0
            good[good] = self.smallest(low[good], high[good]) < own[good]
            done = good & (at == start[lane] + s)
            failed = ~good
            for k in np.flatnonzero(done).tolist():
                marks[lane[k]][s[k] : s[k] + run[k]] = True
            left = windows[lane]
            reached = at - start[lane]
            single = failed & (run == 1)
            s = np.where(done, s + run, np.where(single, reached + 1, s))
            whole = failed & (run == left)
            run = np.where(done, 2 * run, np.where(failed, np.where(whole, 1, np.maximum(run // 2, 1)), run))
            again = done | failed
            run = np.where(again, np.minimum(run, left - s), run)
            at = np.where(again, start[lane] + s + length - 2 + run, at - 1)
            low, high = np.where(again, 0, low), np.where(again, self.n, high)
            on = s < left
            lane, s, run, at, low, high = (x[on] for x in (lane, s, run, at, low, high))
        return marks
