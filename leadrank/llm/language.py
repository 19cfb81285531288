"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the character n-grams
of one to three letters that both hold, over the geometric mean of how many each
holds. Texts are lower-cased and everything but letters counts as a space;
n-grams are hashed to 16,384 places. Nyström landmarks, an equal share of each
language, turn the kernel into features, and one ridge regression per language
against all others is solved on them. Scoring a batch is two matrix products:
presence by landmarks, kernels by weights.

The model is fitted on at most about ``sample_rows`` rows with a language,
the same number of each, chosen by a hash of the key; what is collected are
their presence bits (2 KB a row), never texts. Ids, sources and languages are no
inputs of a prediction.

A null text and a text without a letter are ``und`` with score 0; so is every
text where there is no row to learn from. Ties go to the first language in
alphabetical order. Very long texts are read whole, in slices of characters that
overlap. Repeated rows stay; null keys count as not held out and
are learned from as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from leadrank.llm.shared import crc_mod, groups_of, once, share

LONGEST, PLACES = 3, 1 << 14
SAMPLE_ROWS, LANDMARKS, RIDGE = 6_000, 160, 1e-2
#: Languages that a model tells apart at most.
MAX_LANGUAGES = 500
UNKNOWN = "und"
#: Characters and texts that are worked on at once.
SLICE, ROWS = 2_000_000, 256


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return once("language letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrix of n-gram places by text, and whether each text has a letter."""
    is_letter = letters()
    seen = np.zeros((len(texts), PLACES), np.uint8)
    flat = seen.reshape(-1)
    has_letter = np.zeros(len(texts), bool)
    lower = [(t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower))
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    row_of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    for a in range(0, len(codes), SLICE):
        # Slices overlap, so that no n-gram is cut.
        part, rows = codes[a : a + SLICE + LONGEST - 1], row_of[a : a + SLICE + LONGEST - 1]
        known = is_letter[part]
        has_letter[rows[known]] = True
        part = np.where(known, part, np.uint32(32))
        gram = np.zeros(len(part), np.uint32)
        for n in range(1, LONGEST + 1):
            if len(part) < n:
                break
            m = len(part) - n + 1
            gram = gram[:m] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(n == 1)
            place = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)
            whole = rows[:m] == rows[n - 1 :]
            flat[(rows[:m].astype(np.int64) * PLACES + place)[whole]] = 1
    return seen, has_letter


@dataclass
class Model:
    """Languages, landmark presence over its norm (places by landmarks), weights (landmarks by languages)."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def kernel(self, seen: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(seen.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
        return seen.astype(np.float32) @ self.landmarks / norm[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for a in range(0, len(texts), ROWS):
            part = texts[a : a + ROWS]
            if not self.languages:
                names.extend([UNKNOWN] * len(part))
                continue
            seen, has_letter = presence(part)
            values = self.kernel(seen) @ self.weights
            best = values.argmax(axis=1)
            scores[a : a + len(part)] = np.where(has_letter, np.clip((values.max(axis=1) + 1) / 2, 0, 1), 0.0)
            names.extend(self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), has_letter.tolist(), strict=True))
        return names, scores


def fit(seen: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström features of the rows and a one-versus-rest ridge regression on them."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((PLACES, 0), np.float32), np.zeros((0, 0), np.float32))
    of = np.array([languages.index(x) for x in langs])
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(of == k)[:each] for k in range(len(languages))])
    z = seen[chosen].astype(np.float32)
    z /= np.sqrt(np.maximum(z.sum(axis=1, keepdims=True), 1))
    model = Model(languages, np.ascontiguousarray(z.T), np.zeros((len(chosen), len(languages)), np.float32))
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.concatenate([model.kernel(seen[a : a + ROWS]) for a in range(0, len(seen), ROWS)]).astype(np.float64) @ root
    target = np.where(of[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Every language weighs the same, however many rows it has.
    weight = (1.0 / np.bincount(of, minlength=len(languages)))[of][:, None]
    inner = phi.T @ (phi * weight) + ridge * np.eye(phi.shape[1])
    model.weights = (root @ np.linalg.solve(inner, phi.T @ (target * weight))).astype(np.float32)
    return model


def held_out(key: str = "doc_id"):
    return F.coalesce(crc_mod(key, 4) == 2, F.lit(False))


def learn(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS, max_languages: int = MAX_LANGUAGES
) -> Model:
    """Fit on rows outside the held-out fold; at most ``max_languages`` languages are learned, the commonest."""
    rows = docs.where(~held_out(key)).where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    # One row per language comes to the driver.
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    if not sizes:
        return fit(np.zeros((0, PLACES), np.uint8), [])
    each = max(1, sample_rows // len(sizes))
    part = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, each / n)])
    order = share(F.coalesce(F.col(key).cast("string"), F.lit("")), "language")
    picked = rows.where(order < part[F.col(lang)]).select(F.col(lang).cast("string").alias("lang"), order.alias("o"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a in range(0, len(texts), ROWS):
                bits = np.packbits(presence(texts[a : a + ROWS])[0], axis=1)
                n = len(bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array([b.tobytes() for b in bits], pa.binary())],
                    names=["lang", "o", "bits"],
                )

    # The share test keeps about this many; the limit bounds rows that repeat one key.
    found = picked.mapInArrow(run, "lang string, o double, bits binary").orderBy("o", "bits").limit(2 * sample_rows + len(sizes)).toArrow()
    seen = np.unpackbits(np.frombuffer(b"".join(found.column("bits").to_pylist()), np.uint8).reshape(-1, PLACES // 8), axis=1)
    return fit(seen, found.column("lang").to_pylist())


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score)`` of every row."""
    # Arrays and names only, so that workers need not have this package.
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.landmarks, model.weights))
    schema = docs.select(key).schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for rows in batches:
            texts = rows.column(1).to_pylist()
            for a, b in groups_of(texts):
                names, scores = model.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(a, b - a), pa.array(names), pa.array(scores)], names=[key, "lang_pred", "score"])

    return docs.select(key, text).mapInArrow(run, schema)
