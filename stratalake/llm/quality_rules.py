"""Quality rules: counts of each text, and a hashed n-gram logistic regression learned from labels.

Features are hashed word unigrams and bigrams and character (code point) 3-grams and 5-grams of the text; each kind counts
as relative frequencies in ``2**BITS`` cells; no n-gram crosses the end of its text. The regression is fitted on a bounded sample of labelled
rows by full gradient steps (AdaGrad), calibrated on other labelled rows at their natural rates, and
scored in Arrow batches against the fixed threshold ``THRESHOLD``.

Words are runs of bytes other than ASCII white space. Defined results: a null text has no words and
all counts 0; texts under 50 words, or with over half of their words in repeated 3-word windows, fail the
base rules; without labels of both classes the verdict is the smoothed share of good labels.

Bounds (documented parameters): ``TRAINING`` rows fit the weights and ``CALIBRATION`` rows the
calibration, each text of at most ``MAX_BYTES``. All texts are counted and scored, whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import words as W
from stratalake.llm.batches import appended
from stratalake.llm.training import fit_logistic, labelled, sigmoid

TRAINING, CALIBRATION, MAX_BYTES = 1_000, 2_000, 16_384
BITS, EPOCHS, THRESHOLD = 18, 40, 0.3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.isin(W.BYTES, list(b"#*$%&|<>"))
_CODE_POINTS = (W.BYTES & 0xC0) != 0x80


def row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[rows[1:]] - total[rows[:-1]]


class Texts:
    """Words of a slice of texts, and what is counted of them."""

    def __init__(self, column: pa.Array):
        self.data, self.rows = W.text_bytes(column)
        self.starts, self.ends, self.words = W.spans(self.data, self.rows, W.NOT_SPACE)
        self.hashes = W.hashes(self.data, self.starts, self.ends, lower=False)

    def counts(self) -> dict[str, np.ndarray]:
        data, rows = self.data, self.rows
        return {
            "n_words": np.diff(self.words),
            "word_chars": row_sums(W.NOT_SPACE[data] & _CODE_POINTS[data], rows),
            "n_symbols": row_sums(_SYMBOLS[data], rows),
            "n_dup_lines": self.dup_lines(),
            "n_repeat_words": self.repeat_words(),
        }

    def dup_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        breaks = np.flatnonzero(self.data == 0x0A)
        begins = np.unique(np.concatenate([self.rows[:-1], breaks + 1]))
        begins = begins[begins < len(self.data)]
        row = np.searchsorted(self.rows, begins, "right") - 1
        ends = np.minimum(np.append(breaks, len(self.data))[np.searchsorted(breaks, begins)], self.rows[row + 1])
        worded = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, begins)
        begins, ends, row = begins[worded], ends[worded], row[worded]
        keys = self._in_row(W.hashes(self.data, begins, ends, lower=False), row)
        _, first = np.unique(keys, return_index=True)
        n = len(self.rows) - 1
        return np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)

    def repeat_words(self) -> np.ndarray:
        """Words in 3-word windows that their text has twice or more."""
        n = len(self.hashes)
        row = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.words))
        at = np.flatnonzero(row[:-2] == row[2:]) if n > 2 else np.zeros(0, np.int64)
        h = self.hashes
        keys = self._in_row(W.mix(h[at] ^ W.mix(h[at + 1] + np.uint64(1)) ^ W.mix(W.mix(h[at + 2] + np.uint64(2)))), row[at])
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        hit = at[times[which] > 1]
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[hit + k] = True
        return row_sums(inside, self.words)

    @staticmethod
    def _in_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
        return W.mix(keys + row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per kind of n-gram: cells of all n-grams, and where each row starts among them."""
        shift = np.uint64(64 - BITS)
        at, pairs = _inside(self.words, 2)
        pair = self.hashes[at] ^ W.mix(self.hashes[at + 1])
        out = [((self.hashes >> shift).astype(np.int32), self.words), ((pair >> shift).astype(np.int32), pairs)]
        points, begins = self.characters()
        for size in (3, 5):
            n = max(0, len(points) - size + 1)
            gram = np.zeros(n, np.uint64)
            for k in range(size):
                gram = gram * np.uint64(0x9E3779B97F4A7C15) + points[k : k + n]
            gram = (gram + np.uint64(size)) * np.uint64(0xD1342543DE82EF95)
            at, grams = _inside(begins, size)
            out.append(((gram >> shift).astype(np.int32)[at], grams))
        return out

    def characters(self) -> tuple[np.ndarray, np.ndarray]:
        """A number for each code point, made of its bytes, and where each text's begin (end appended)."""
        first = np.flatnonzero(_CODE_POINTS[self.data])
        sizes = np.diff(np.append(first, len(self.data)))
        points = self.data[first].astype(np.uint64)
        for k in range(1, 4):
            more = sizes > k
            points[more] |= self.data[first[more] + k].astype(np.uint64) << np.uint64(8 * k)
        return points, np.searchsorted(first, self.rows)


def _inside(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the ``size``-grams that end within their row, and where each row starts among them."""
    counts = np.maximum(np.diff(rows) - size + 1, 0)
    begins = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(begins[-1]) + np.repeat(rows[:-1] - begins[:-1], counts), begins


def _means(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Each row is summed by itself, so that its neighbours don't round it."""
    sizes, sums = np.diff(rows), np.zeros(len(rows) - 1)
    if len(values):
        sums[sizes > 0] = np.add.reduceat(values, rows[:-1][sizes > 0])
    return sums / np.maximum(sizes, 1)


def raw_scores(features: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> np.ndarray:
    return sum(_means(w[cells].astype(np.float64), rows) for w, (cells, rows) in zip(weights, features))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Weights by kind and cell, and the calibration's slope and intercept."""
    half = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2))
    rows = [r for y in (1, 0) for r in labelled(docs, labels, label, TRAINING, MAX_BYTES, 3, half == 0, y)]
    rest = labelled(docs, labels, label, CALIBRATION, MAX_BYTES, 4, half == 1)
    weights = np.zeros((4, 1 << BITS), np.float32)
    y = np.array([v for _, v in rows], float)
    target = np.array([v for _, v in rest], float)
    if len(set(y)) < 2:
        return weights, fit_logistic(np.zeros((len(rest), 1)), target)
    features = Texts(pa.array([t for t, _ in rows])).features()
    seen = np.full(weights.shape, 1e-8)
    bias, balance = 0.0, np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for _ in range(EPOCHS):
        error = (y - sigmoid(raw_scores(features, weights) + bias)) * balance
        bias += 2 * error.sum()
        for k, (cells, at) in enumerate(features):
            sizes = np.diff(at)
            per = np.repeat(error / np.maximum(sizes, 1), sizes)
            step = np.bincount(cells[: len(per)], per, 1 << BITS)
            seen[k] += step**2
            weights[k] += (0.5 * step / np.sqrt(seen[k])).astype(np.float32)
    raw = raw_scores(Texts(pa.array([t for t, _ in rest], pa.string())).features(), weights) + bias
    slope = fit_logistic(raw[:, None], target)
    return weights, np.array([slope[0], slope[1] + slope[0] * bias])


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), the counts, and ``score``, the calibrated chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS cells of four kinds

    def work():
        weights, line = shared.value

        def score(batch: pa.RecordBatch) -> list:
            texts = Texts(batch.column(0))
            counts = texts.counts()
            return [*(counts[c].astype(np.int64) for c in COUNTS), sigmoid(raw_scores(texts.features(), weights) * line[0] + line[1])]

        return score

    return appended(docs, {"text": text}, ", ".join(f"{c} bigint" for c in COUNTS) + ", score double", work, "text")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the counts, base_failed, score and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored(docs, fit(docs, labels)).select(
        "row.doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= THRESHOLD)).alias("kept"), "score")
