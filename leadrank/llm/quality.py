"""Quality classifier: a generalised additive model with pairwise interactions.

The score of a text is the logistic of a sum of table entries: one table per
feature and one per chosen pair of features. The tables are learned by cyclic
boosting: each round visits every feature in turn, fits a shallow tree to the
gradients over that feature's bins alone and adds a small step of it to the
table; afterwards the pairs whose trees would lower the loss most get the same
treatment on two-way bins. Scoring is a few look-ups and additions on whole
numpy columns.

Features come from the whole text in one pass and never from labels, lang,
source or ids. The tables are fitted on at most ``sample_rows`` labelled rows,
chosen by a hash of the key; at that bound they and the collected feature rows
stay small whatever the table's size. Everything else runs on all rows.

Null and empty texts have features of zero length and get a score. Very long texts
are read whole, one at a time. Repeated
rows stay. Null keys are scored and count as not held out; they carry no label.
Without labelled rows every score is 0.5; with one class only, its share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from leadrank.llm.shared import crc_mod, share

FEATURES = [
    "log_bytes",
    "mean_word",
    "upper_share",
    "mark_share",
    "rare_mark_share",
    "digit_share",
    "wide_share",
    "distinct_words",
    "adjacent_repeats",
    "distinct_lines",
    "mean_line",
    "mean_sentence",
]
#: Marks that prose seldom uses.
RARE_MARKS = b"#$%&*<=>@[\\]^_`{|}~!"
SAMPLE_ROWS = 20_000
MAX_BINS, PAIR_BINS, N_PAIRS = 64, 12, 8


def text_features(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n_words = max(1, len(words))
    upper, digits, wide = counts[65:91].sum(), counts[48:58].sum(), counts[128:].sum()
    marks = counts[33:127].sum() - upper - digits - counts[97:123].sum()
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    filled = [x for x in lines if x] or [b""]
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n_words,
        upper / n,
        marks / n,
        counts[list(RARE_MARKS)].sum() / n,
        digits / n,
        wide / n,
        len(set(words)) / n_words,
        repeats / n_words,
        len(set(filled)) / len(filled),
        n_words / len(filled),
        n_words / max(1, int(counts[46] + counts[63])),
    ]


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", others: list[str] | None = None) -> DataFrame:
    """``key``, ``others`` and the array ``x`` of features of each row."""
    kept = [key, *(others or [])]
    schema = docs.select(*kept).schema.add("x", T.ArrayType(T.DoubleType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = np.array([text_features(t.as_py()) for t in rows.column(len(kept))], np.float64).reshape(-1, len(FEATURES))
            ends = np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(kept)], lists], names=[*kept, "x"])

    return docs.select(*kept, text).mapInArrow(run, schema)


@dataclass
class Model:
    """Cut points and tables. ``pairs`` hold (first, second, their cuts, table)."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[k], x[:, k], side="right")]
        for a, b, cut_a, cut_b, table in self.pairs:
            total += table[np.searchsorted(cut_a, x[:, a], side="right"), np.searchsorted(cut_b, x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _split(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, int]:
    """Best gain and its place among the bins of one node (0: no split)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = _gain(left_g, left_h, ridge) + _gain(all_g - left_g, all_h - left_h, ridge) - _gain(all_g, all_h, ridge)
    gain[(left_h < least) | (all_h - left_h < least)] = -1
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def tree_1d(g: np.ndarray, h: np.ndarray, leaves: int = 4, ridge: float = 1.0, least: float = 2.0) -> np.ndarray:
    """Step of each bin: a tree with so many leaves, grown best split first."""
    nodes = [(0, len(g), *_split(g, h, ridge, least))]
    while len(nodes) < leaves:
        k = max(range(len(nodes)), key=lambda i: nodes[i][2])
        a, b, gain, at = nodes[k]
        if gain <= 0:
            break
        nodes[k] = (a, a + at, *_split(g[a : a + at], h[a : a + at], ridge, least))
        nodes.append((a + at, b, *_split(g[a + at : b], h[a + at : b], ridge, least)))
    out = np.zeros(len(g))
    for a, b, _, _ in nodes:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def tree_2d(g: np.ndarray, h: np.ndarray, ridge: float = 1.0, least: float = 2.0) -> tuple[np.ndarray, float]:
    """Step of each two-way bin and its gain: one cut of the first feature, then one of the second on each side, or the other way round."""
    best, steps = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            total, out = 0.0, np.zeros_like(gg)
            for part in (slice(0, cut), slice(cut, None)):
                pg, ph = gg[part].sum(axis=0), hh[part].sum(axis=0)
                gain, at = _split(pg, ph, ridge, least)
                total += gain + _gain(pg.sum(), ph.sum(), ridge)
                for side in (slice(0, at), slice(at, None)):
                    out[part, side] = pg[side].sum() / (ph[side].sum() + ridge) if ph[side].size else 0.0
            total -= _gain(g.sum(), h.sum(), ridge)
            if total > best:
                best, steps = total, (out.T if turned else out)
    return steps, best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, rate: float = 0.15) -> Model:
    """Cyclic boosting of the feature tables, then of the chosen pairs."""
    if not len(y):
        return Model()
    p = y.mean()
    model = Model(base=float(np.log(p / (1 - p))) if 0 < p < 1 else (40.0 if p else -40.0))
    if not 0 < p < 1:
        return model
    n_features = x.shape[1]
    model.cuts = [_cuts(x[:, k], MAX_BINS) for k in range(n_features)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(model.cuts)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return y - q, np.maximum(q * (1 - q), 1e-6)

    for _ in range(rounds):
        for k in range(n_features):
            g, h = slopes()
            size = len(model.tables[k])
            step = rate * tree_1d(np.bincount(bins[k], g, size), np.bincount(bins[k], h, size))
            model.tables[k] += step
            total += step[bins[k]]
    coarse = [_cuts(x[:, k], PAIR_BINS) for k in range(n_features)]
    small = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(coarse)]

    def cells(a: int, b: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return small[a] * shape[1] + small[b], shape

    def two_way(a: int, b: int) -> tuple[np.ndarray, float, np.ndarray]:
        at, shape = cells(a, b)
        g, h = slopes()
        step, gain = tree_2d(*(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))
        return step, gain, at

    ranked = sorted(((two_way(a, b)[1], a, b) for a in range(n_features) for b in range(a + 1, n_features)), reverse=True)
    chosen = [(a, b) for gain, a, b in ranked[:N_PAIRS] if gain > 0]
    tables = {ab: np.zeros(cells(*ab)[1]) for ab in chosen}
    for _ in range(pair_rounds):
        for ab in chosen:
            step, _, at = two_way(*ab)
            tables[ab] += rate * step
            total += rate * step.reshape(-1)[at]
    model.pairs = [(a, b, coarse[a], coarse[b], t) for (a, b), t in tables.items()]
    return model


def learn(featured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled rows outside the held-out fold, at most about ``sample_rows`` of them."""
    wanted = labels.select(F.col(key).alias("_k"), F.col(label).cast("double").alias("y")).where("y is not null and _k is not null")
    wanted = wanted.where(crc_mod("_k", 5) != 0)
    n = wanted.count()
    picked = wanted.where(share(F.col("_k"), "quality") < F.lit(sample_rows / max(1, n)))
    rows = featured.join(picked, F.col(key) == F.col("_k")).orderBy(key).limit(2 * sample_rows).select("x", "y").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, rows.column("y").to_numpy())


def score(featured: DataFrame, model: Model, cut: float = 0.3) -> DataFrame:
    """``featured`` without ``x``, with ``score`` and ``predicted``."""
    names = [c for c in featured.columns if c != "x"]
    schema = featured.select(*names).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = rows.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = model.score(x)
            made = [pa.array(s), pa.array((s >= cut).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(names)], *made], names=[*names, "score", "predicted"])

    return featured.select(*names, "x").mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    return F.coalesce(crc_mod(key, 5) == 0, F.lit(False))
