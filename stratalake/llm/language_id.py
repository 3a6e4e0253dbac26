"""Language by multinomial naive Bayes over hashed character n-grams.

Characters (code points) are lower-cased; each run of characters that aren't letters counts as one blank, so digits, marks
and markup say nothing. All n-grams of ``ORDERS`` characters that lie within one text are hashed into buckets.

*Training* covers all usable rows: each task counts its texts' n-grams per language and bucket, tasks' counts are summed
by Spark, and the log-probability matrix (one row per language, one column per bucket, add-``SMOOTHING`` estimates) with
the languages' log shares is broadcast. The matrix has at most ``CELLS`` cells whatever the input: more languages make
fewer buckets; more than ``CELLS / 256`` different languages are an error.

*Scoring* is by slices of an Arrow batch in numpy: the buckets of all n-grams of the slice in one sparse list, each
language's row looked up at it, and summed by text. The score is the posterior of the predicted language.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned;
equal posteriors go to the language that comes first by name. An empty text in training counts for its language's share
only. Scores depend on the text and the learned counts alone; repeated rows are counted as often as they stand.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import words as W
from stratalake.llm.batches import appended
from stratalake.llm.training import crc32_of_id

ORDERS, BITS, CELLS, SMOOTHING, UNKNOWN = (1, 2, 3, 4), 16, 1 << 22, 0.5, "und"
SLICE_BYTES = 1 << 19
_FACTOR = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    bits: int
    prior: np.ndarray
    #: (languages, buckets)
    log_p: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with one blank for what isn't letters, where each text starts, and if it has a letter."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    data, _ = W.text_bytes(low)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    rows = np.concatenate([[0], np.cumsum(sizes)])
    keep = letter.copy()
    if len(points):
        keep[0] = True
        keep[1:] |= letter[:-1]
        keep[rows[:-1][sizes > 0]] = True
    before = np.concatenate([[0], np.cumsum(keep)])[rows]
    counts = np.concatenate([[0], np.cumsum(letter)])[rows]
    return np.where(letter, points, np.uint32(32))[keep], before, np.diff(counts) > 0


def buckets(points: np.ndarray, rows: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: the buckets of the n-grams of all texts, and where each text's begin (end appended)."""
    mixed = (points + np.uint32(1)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    hashed = np.zeros(len(points), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            return
        hashed = hashed[:n] * _FACTOR + mixed[order - 1 :]
        if order not in ORDERS:
            continue
        found = hashed * np.uint32(0xC2B2AE35)
        found ^= found >> np.uint32(16)
        found = (found * _FACTOR) >> np.uint32(32 - bits)
        sizes = np.maximum(np.diff(rows) - order + 1, 0)
        if order > 1:
            inside = np.ones(len(points), bool)
            for k in range(1, order):
                ends = rows[1:] - k
                inside[ends[ends >= rows[:-1]]] = False
            found = found[inside[:n]]
        yield found, np.concatenate([[0], np.cumsum(sizes)])


def _by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums per text, each of its own values alone."""
    out, full = np.zeros(len(starts) - 1), np.diff(starts) > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full], dtype=np.float64)
    return out


def log_joint(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(texts, languages) log of share times likelihood, and which texts have a letter."""
    points, rows, lettered = characters(texts)
    out = np.tile(model.prior, (len(texts), 1))
    for found, starts in buckets(points, rows, model.bits):
        for k, row in enumerate(model.log_p):
            out[:, k] += _by_text(row[found], starts)
    return out, lettered


def _size(languages: int) -> int:
    if languages * 256 > CELLS:
        raise ValueError(f"{languages} languages; a model holds at most {CELLS // 256}")
    return min(BITS, (CELLS // max(languages, 1)).bit_length() - 1)


def fit(docs: DataFrame, usable: Column | None = None) -> Model:
    """Counts over all rows with text and lang (and ``usable``); only the matrix and the languages reach the driver."""
    train = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.lit(True) if usable is None else usable)).select("text", "lang")
    shares = {r.lang: r["count"] for r in train.groupBy("lang").count().limit(CELLS // 256 + 1).collect()}
    languages = sorted(shares)
    bits = _size(len(languages))
    number = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(1 << bits, np.int64))
        for batch in batches:
            for part in W.slices(batch, "text", SLICE_BYTES):
                which = np.array([number[x] for x in part.column(1).to_pylist()])
                for k in np.unique(which).tolist():
                    points, rows, _ = characters(part.column(0).filter(pa.array(which == k)))
                    for found, _ in buckets(points, rows, bits):
                        total[k] += np.bincount(found, minlength=1 << bits)
        for k, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["k", "bucket", "c"])

    sums = train.mapInArrow(count, "k int, bucket int, c bigint").groupBy("k", "bucket").agg(F.sum("c").alias("c")).toArrow()
    matrix = np.full((len(languages), 1 << bits), SMOOTHING)
    matrix[sums["k"].to_numpy(), sums["bucket"].to_numpy()] += sums["c"].to_numpy()
    log_p = np.log(matrix) - np.log(matrix.sum(axis=1, keepdims=True))
    prior = np.array([shares[x] for x in languages], float)
    return Model(languages, bits, np.log(prior / max(prior.sum(), 1)), log_p.astype(np.float32))


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS cells at most

    def work():
        model = shared.value

        def predict(batch: pa.RecordBatch) -> list:
            if not model.languages:
                return [[UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)]
            best, score = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
            at = 0
            for part in W.slices(batch, batch.schema.names[0], SLICE_BYTES):
                joint, lettered = log_joint(part.column(0), model)
                span = slice(at, at + part.num_rows)
                at += part.num_rows
                top = joint.max(axis=1)
                posterior = 1 / np.exp(joint - top[:, None]).sum(axis=1)
                best[span] = np.where(lettered, joint.argmax(axis=1), len(model.languages))
                score[span] = np.where(lettered, posterior, 0)
            return [pa.array([*model.languages, UNKNOWN]).take(pa.array(best)), score]

        return predict

    return appended(docs, {"text": text}, "lang_pred string, score double", work, "text")


def report(docs: DataFrame) -> DataFrame:
    """Per document: held_out, lang_pred, score; learned from rows that aren't held out."""
    model = fit(docs, crc32_of_id() % 5 != 0)
    held_out = F.coalesce(crc32_of_id() % 5 == 0, F.lit(False))
    found = predicted(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
