"""Quality rules: a hashed n-gram logistic regression, calibrated, beside counted base rules."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import labelled_sample, rows_of

WORD_SLOTS = 1 << 16
GRAM_SLOTS = 1 << 16
WORD_SIZES, GRAM_SIZES = (1, 2), (2, 3)
#: A document is rejected by the method when its calibrated probability of good quality lies below this.
LEAST_PROBABILITY = 0.5
#: At most this many labelled rows of each class are used to fit.
ROWS_PER_CLASS = 2000
# The signs counted as symbols, and the white space between words.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def grams(items: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """32-bit hashes of all runs of so many neighbouring items (32-bit numbers)."""
    found = [np.zeros(0, dtype=np.uint32)]
    for size in sizes:
        if len(items) >= size:
            key = np.full(len(items) - size + 1, size, dtype=np.uint32)
            for k in range(size):
                key = (key ^ items[k : len(items) - size + 1 + k]) * np.uint32(2654435761)
                key ^= key >> np.uint32(15)
            found.append(key)
    return np.concatenate(found)


def slots(data: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the word n-grams, and of the n-grams of code points, of one text."""
    hashed = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    signs = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), dtype="<u4")
    word, gram = grams(hashed, WORD_SIZES), grams(signs, GRAM_SIZES)
    return (word >> 16).astype(np.int64) % WORD_SLOTS, (gram >> 16).astype(np.int64) % GRAM_SLOTS + WORD_SLOTS


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one text: each kind's frequencies, on a common scale."""
    out = []
    for found in slots(data, data.split()):
        at, n = np.unique(found, return_counts=True)
        out.append((at, np.sqrt(n / max(1, len(found)))))
    return np.concatenate([a for a, _ in out]), np.concatenate([v for _, v in out])


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, data: bytes) -> float:
        at, value = features(data)
        raw = float(self.weights[at] @ value) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -60, 60))))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, steps: int = 150) -> tuple:
    """Weights and bias by accelerated gradient descent; classes weigh the same, weights are kept small."""
    sizes = np.array([len(a) for a, _ in rows])
    at, value = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    weights, bias, ahead, ahead_bias, decay, rate = np.zeros(width), 0.0, np.zeros(width), 0.0, 1e-4, 2.0
    for step in range(steps):
        score = np.bincount(row, weights=value * ahead[at], minlength=len(rows)) + ahead_bias
        off = (sigmoid(score) - y) * share
        new = ahead - rate * (np.bincount(at, weights=value * off[row], minlength=width) + decay * ahead)
        new_bias = ahead_bias - rate * float(off.sum())
        push = step / (step + 3)
        ahead, ahead_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, bias


def fit_scale(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities, by Newton's method on held-out rows."""
    # Targets a little inside 0 and 1, so that separable classes keep a finite slope.
    good, bad = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    beta, x = np.array([1.0, 0.0]), np.stack([score, np.ones(len(score))], axis=1)
    for _ in range(50):
        p = sigmoid(x @ beta)
        curve = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (target - p) - 1e-6 * beta)
        beta = beta + np.clip(step, -5, 5)
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit_quality(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> QualityModel:
    """Fit on at most ``rows_per_class`` labelled rows a class: four fifths for the weights, the rest to calibrate.

    Only their sparse features reach the driver. Without rows of both classes every document counts as good.
    """

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.encode("utf-8")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([a.astype("<u4").tobytes() for a, _ in found], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                ],
                names=["doc_id", "label", "at", "value"],
            )

    sample = labelled_sample(docs, labels, "quality", rows_per_class)
    rows = sample.mapInArrow(sparse, "doc_id long, label int, at binary, value binary").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.at))
    y = np.array([r.label for r in rows], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return QualityModel(np.zeros(WORD_SLOTS + GRAM_SLOTS, dtype=np.float32), 0.0, 1.0, 60.0)
    found = [(np.frombuffer(r.at, "<u4").astype(np.int64), np.frombuffer(r.value, "<f4").astype(float)) for r in rows]
    # Every fifth row of each class; of a class with fewer than five the last one, which so is fitted on too.
    place = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0))
    last = np.where(y == 1, (y == 1).sum(), (y == 0).sum())
    held = (place % 5 == 0) | ((last < 5) & (place == last))
    fitted = ~held | (last < 5)
    weights, bias = fit_logistic(
        [f for f, h in zip(found, fitted, strict=True) if h], y[fitted], WORD_SLOTS + GRAM_SLOTS
    )
    score = np.array([weights[a] @ v for (a, v), c in zip(found, held, strict=True) if c]) + bias
    slope, shift = fit_scale(score, y[held])
    return QualityModel(weights.astype(np.float32), bias, slope, shift)


MIX = (np.int64(0x5DEECE66D1CE4E5B), np.int64(0x27D4EB2F165667C5))


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeated = 0
    if len(words) > 3:
        # The process's own 64-bit hash stands for a word; three of them are mixed for a window.
        h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
        with np.errstate(over="ignore"):
            window = (h[:-2] * MIX[0] + h[1:-1]) * MIX[1] + h[2:]
        _, inverse, n = np.unique(window, return_inverse=True, return_counts=True)
        again = n[inverse] > 1
        covered = np.zeros(len(words), dtype=bool)
        for k in range(3):
            covered[k : len(words) - 2 + k] |= again
        repeated = int(covered.sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


def judge_quality(docs: DataFrame, model: QualityModel, least: float = LEAST_PROBABILITY) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept.

    Null and empty texts have no words and fail the base rule; repeated rows are judged alike; null ids stay; other
    columns are left behind; an empty table gives an empty one.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"]
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                data = text.encode("utf-8")
                words = data.split()
                out.append((len(words), *base_counts(text, words), model.probability(data)))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", *names],
            )

    scored = rows_of(docs).mapInArrow(
        score,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "probability double",
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= least)
    )
