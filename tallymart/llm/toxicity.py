"""Toxicity grades by cumulative-link ordinal regression on all hashed text features.

P(grade <= k) is the logistic function of threshold k minus one weighted sum, so all thresholds share the weights. The
features are words and word beginnings, hashed to a fixed number of slots: the logarithm of how many distinct words of the
text show them. Each enters on the scale of what the labelled rows say for it beyond chance, and the weights are kept
small. The two classes weigh what they are among all labels, however many rows of each were drawn: so a text that shows
nothing known has the severity of the base rate at most, and evidence must raise it to the rejecting one. Grades of the
labelled rows: 0 not toxic, 1 toxic, 2 toxic with more evidence than the median toxic row.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import (
    TwoGenerations,
    batch_whole_texts,
    labelled_sample,
    leave_encoder,
    rows_of,
    ship_package,
)

LETTERS = re.compile(r"[^\W\d_]+")
OPENINGS = (4, 5, 3, 2)
SLOTS = 1 << 18
GRADES = 3
#: Log likelihood that a slot gains by chance: what the labelled rows say for it counts from there on.
CHANCE = 2.0
#: A document is rejected from this expected severity on, and only this far above that of a text without evidence.
REJECT_AT, MARGIN = 0.25, 0.15
#: At most this many labelled rows of each class are used to fit.
ROWS_PER_CLASS = 2500
# Odd multipliers of the minimum hashes.
ODD = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09)


def codes_of(word: str) -> list[int]:
    """Slots of a word's features: the word, and its beginnings under a leading circumflex."""
    found = [zlib.crc32(word.encode())]
    found += [zlib.crc32(b"^" + word[:size].encode()) for size in OPENINGS if len(word) >= size]
    return [code % SLOTS for code in found]


class WordCodes(TwoGenerations):
    """Slots of words as packed 32-bit numbers."""

    def __init__(self, size: int = 50_000):
        super().__init__(size)

    def make(self, word: str) -> bytes:
        return np.array(codes_of(word), dtype="<u4").tobytes()


def features(text: str, cache: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text in rising order, and how many features of its distinct words fall into each."""
    codes = b"".join(map(cache.__getitem__, set(LETTERS.findall(text.lower()))))
    return np.unique(np.frombuffer(codes, dtype="<u4"), return_counts=True)


def strength(count):
    return np.log2(1 + count)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by slot, thresholds in rising order, and the expected severity that rejects."""

    weights: np.ndarray
    thresholds: tuple[float, ...]
    reject_at: float = REJECT_AT

    def severity(self, text: str, cache: WordCodes) -> float:
        """Expected grade: the sum over thresholds of the probability of lying above."""
        slots, counts = features(text, cache)
        return self.expected(float(self.weights[slots] @ strength(counts)))

    def expected(self, score: float) -> float:
        return sum(1 / (1 + math.exp(min(60.0, max(-60.0, t - score)))) for t in self.thresholds)


NOTHING_TOXIC = ToxicityModel(np.zeros(SLOTS), tuple(60.0 + k for k in range(GRADES - 1)))


class Sparse:
    """Rows of slots and values, multiplied from either side."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(at) for at, _ in rows])
        self.at = np.concatenate([at for at, _ in rows]).astype(np.int64)
        self.value = np.concatenate([value for _, value in rows])

    def by(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * weights[self.at], minlength=self.n)

    def back(self, share: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=self.value * share[self.row], minlength=SLOTS)


def fit_ordinal(
    x: Sparse, y: np.ndarray, share: np.ndarray, grades: int = GRADES, steps: int = 200, prior: float = 0.15
) -> tuple:
    """Shared weights and rising thresholds by accelerated gradient descent on the mean log likelihood.

    ``share`` is the part of each row in that mean; the prior on the weights counts as so many rows' part. Thresholds
    begin where they would end without features. Half the largest eigenvalue of the weighted Gram matrix bounds the
    curvature, with some room for the thresholds, and so the step; thresholds are put back in order after each.
    """
    n, width, decay = x.n, SLOTS, prior / max(1, x.n)
    reach, size = np.ones(width), 0.0
    for _ in range(15):
        reach = x.back(share * x.by(reach))
        size = float(np.linalg.norm(reach))
        reach = reach / max(size, 1e-12)
    rate = 1.0 / (0.55 * size + 2.0)
    below = np.clip(np.cumsum(np.bincount(y, weights=share, minlength=grades))[:-1], 1e-6, 1 - 1e-6)
    start = np.log(below / (1 - below)) + 0.1 * np.arange(grades - 1)
    beta = np.concatenate([np.zeros(width), start])
    ahead, edge = beta.copy(), np.zeros((n, 2))
    for step in range(steps):
        score = x.by(ahead[:width])
        cut = np.concatenate([[-60.0], ahead[width:], [60.0]])
        edge[:, 0], edge[:, 1] = cut[y] - score, cut[y + 1] - score
        p = 1 / (1 + np.exp(-np.clip(edge, -60, 60)))
        chance = np.maximum(p[:, 1] - p[:, 0], 1e-12)
        slope = p * (1 - p)
        slope[y == 0, 0] = 0
        slope[y == grades - 1, 1] = 0
        low, high = share * slope[:, 0] / chance, share * slope[:, 1] / chance
        thresholds = [low[y == k + 1].sum() - high[y == k].sum() for k in range(grades - 1)]
        new = ahead - rate * np.concatenate([x.back(high - low) + decay * ahead[:width], thresholds])
        for k in range(width + 1, len(new)):
            new[k] = max(new[k], new[k - 1] + 0.1)
        ahead = new + step / (step + 3) * (new - beta)
        beta = new
    if not np.isfinite(beta).all():
        raise ArithmeticError("the ordinal regression did not settle")
    return beta[:width], tuple(float(t) for t in beta[width:])


def distinct_rows(rows: list[np.ndarray]) -> list[int]:
    """Numbers of the rows (sorted feature hashes) that are not near copies of an earlier one.

    Near copies would make any of their words look telling. Rows with an equal pair of minimum hashes of their uncommon
    features, in one of four pairs, are compared; sharing half of these features makes a near copy.
    """
    every, times = np.unique(np.concatenate(rows), return_counts=True)
    rare = every[times <= max(2, len(rows) // 20)]
    uncommon = [np.intersect1d(found, rare, assume_unique=True) for found in rows]
    seen: dict[tuple, int] = {}
    kept = []
    for k, found in enumerate(uncommon):
        bands = []
        if len(found):
            least = [int((found.astype(np.uint64) * np.uint64(odd) & np.uint64(0xFFFFFFFF)).min()) for odd in ODD]
            bands = [(j, least[j], least[j + 1]) for j in range(0, len(ODD), 2)]
        others = {seen[band] for band in bands if band in seen}
        shared = [(len(np.intersect1d(found, uncommon[o], assume_unique=True)), len(uncommon[o])) for o in others]
        if not any(3 * n >= len(found) + other for n, other in shared):
            kept.append(k)
            for band in bands:
                seen.setdefault(band, k)
    return kept


def evidence(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
    """What the rows say for each slot: the log likelihood gained by its own share of toxic rows, less what chance gives;
    negative below the mean."""
    every, ones = np.zeros(SLOTS), np.zeros(SLOTS)
    for (at, _), t in zip(rows, toxic, strict=True):
        every[at] += 1
        ones[at] += t
    base, share = toxic.mean(), ones / np.maximum(every, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ones > 0, ones * np.log(share / base), 0.0)
        gain += np.where(every > ones, (every - ones) * np.log((1 - share) / (1 - base)), 0.0)
    return np.where(share > base, 1, -1) * np.maximum(gain - CHANCE, 0.0)


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, base: float) -> ToxicityModel:
    """The model of rows of slots and values, which hold both classes; ``base`` is the share of toxic ones among labels.

    The root of a slot's evidence is its scale, so little-known features need larger weights, which the decay holds back.
    """
    told = evidence(rows, toxic)
    for_toxic = np.array([np.maximum(told[at], 0) @ value for at, value in rows])
    grade = np.where(toxic == 0, 0, np.where(for_toxic > np.median(for_toxic[toxic == 1]), 2, 1))
    scale = np.sqrt(np.abs(told))
    scale /= max(float(scale.max()), 1e-12)
    x = Sparse([(at, value * scale[at]) for at, value in rows])
    share = np.where(toxic == 1, base / (toxic == 1).sum(), (1 - base) / (toxic == 0).sum())
    weights, thresholds = fit_ordinal(x, grade, share)
    model = ToxicityModel(weights * scale, thresholds)
    return ToxicityModel(model.weights, thresholds, max(REJECT_AT, model.expected(0.0) + MARGIN))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> ToxicityModel:
    """Fit on at most ``rows_per_class`` labelled rows a class; copies of a text count once.

    Only those rows' feature sets reach the driver, and how many ids each class has among all labels. Without rows of
    both classes no document is toxic.
    """

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        cache = WordCodes()
        for batch in batches:
            found = [features(t, cache) for t in batch.column("text").to_pylist()]
            codes = [c.astype("<u4").tobytes() for c, _ in found]
            counts = [n.astype("<u4").tobytes() for _, n in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())],
                names=["label", "codes", "counts"],
            )

    sample = labelled_sample(docs, labels, "toxic", rows_per_class)
    found = sample.mapInArrow(sparse, "label int, codes binary, counts binary")
    found = found.groupBy("codes", "counts").agg(F.max("label").alias("label")).toArrow()
    found = found.sort_by([("codes", "ascending"), ("counts", "ascending")])
    toxic = found.column("label").to_numpy().astype(np.int64)
    codes = [np.frombuffer(x, dtype="<u4") for x in found.column("codes").to_pylist()]
    counts = [np.frombuffer(x, dtype="<u4") for x in found.column("counts").to_pylist()]
    if len(set(toxic.tolist())) < 2:
        return NOTHING_TOXIC
    own = distinct_rows(codes)
    if len(set(toxic[own].tolist())) < 2:
        own = list(range(len(codes)))
    rows, toxic = [(codes[k], strength(counts[k].astype(float))) for k in own], toxic[own]
    every = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = every.where("toxic IN (0, 1)").agg(F.avg("toxic").alias("base")).first()
    return fit_rows(rows, toxic, known.base)


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows that ``grade_toxicity`` does not reject, each judged for itself, with all their columns."""
    ship_package(docs.sparkSession)
    batch_whole_texts(docs.sparkSession)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        cache = WordCodes()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([model.severity(t or "", cache) < model.reject_at for t in texts], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def grade_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, severity (expected grade), grade (the nearest), rejected.

    Null and empty texts hold no feature, are graded by the thresholds alone and are never rejected; repeated rows are graded alike; null
    ids stay; other columns are left behind; an empty table gives an empty one.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        cache = WordCodes()
        for batch in batches:
            found = [model.severity(t, cache) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "severity"]
            )

    scored = rows_of(docs).mapInArrow(score, "doc_id long, severity double")
    return scored.select(
        "doc_id",
        F.round("severity", 6).alias("severity"),
        F.round("severity").cast("int").alias("grade"),
        (F.col("severity") >= model.reject_at).alias("rejected"),
    )
