"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is compressed once with each dictionary. The difference of the two sizes, normalised by the
text's length and by the two sizes together, goes through a logistic calibration fitted on labelled
rows that the dictionaries have not seen, at the labels' natural rates. The calibration also sees the
size under the good dictionary per byte and the text's length, for what the difference is worth depends
on them (a text of one word repeated shrinks to nothing under either dictionary).

Bounds (documented parameters): ``per_class`` texts build each dictionary and ``calibration`` texts
fit the calibration, each of at most ``max_bytes``. All texts are scored, whole.

Defined results: a null text scores like the empty one; without labels of both classes every score is
the smoothed share of good labels (0.5 without labels). Scores depend on the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import words as W
from stratalake.llm.batches import appended
from stratalake.llm.training import crc32_of_id, fit_logistic, labelled, sigmoid

PER_CLASS, CALIBRATION, MAX_BYTES, DICTIONARY_BYTES, LEVEL = 1_500, 4_000, 32_768, 65_536, 3
THRESHOLD = 0.3


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the end of the texts themselves where they are too few to train one."""
    texts = [t for t in texts if t]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, texts)) // 8)), texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:]


class Sizes:
    """Compressed sizes of texts under each of some dictionaries."""

    def __init__(self, dictionaries: list[bytes], level: int = LEVEL):
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.tools = [
            zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(d), **plain) if d else zstandard.ZstdCompressor(level=level, **plain)
            for d in dictionaries]

    def features(self, texts: list[bytes]) -> np.ndarray:
        """(bad - good) / length, (bad - good) / (bad + good), good / length and log length per text."""
        good, bad = np.array([[len(t.compress(x)) for t in self.tools] for x in texts], float).reshape(-1, 2).T
        length = np.array([len(x) for x in texts], float) + 1
        return np.column_stack([(bad - good) / length, (bad - good) / np.maximum(good + bad, 1), good / length, np.log(length)])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None) -> tuple[list[bytes], np.ndarray]:
    """The two dictionaries and the calibration's weights."""
    usable = F.lit(True) if usable is None else usable
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))
    texts = [[t.encode() for t, _ in labelled(docs, labels, label, PER_CLASS, MAX_BYTES, 1, usable & (half == 0), y)] for y in (1, 0)]
    rest = labelled(docs, labels, label, CALIBRATION, MAX_BYTES, 2, usable & (half == 1))
    if not any(texts[0]) or not any(texts[1]):
        return [b"", b""], fit_logistic(np.zeros((len(rest), 4)), np.array([y for _, y in rest], float))
    built = [dictionary(t) for t in texts]
    return built, fit_logistic(Sizes(built).features([t.encode() for t, _ in rest]), np.array([y for _, y in rest], float))


def scored(docs: DataFrame, model: tuple[list[bytes], np.ndarray], text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score``, the calibrated chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most DICTIONARY_BYTES

    def work():
        built, weights = shared.value
        sizes = Sizes(built)

        def score(batch: pa.RecordBatch) -> list:
            data, rows = W.text_bytes(batch.column(0))
            body = data.tobytes()
            x = sizes.features([body[a:b] for a, b in zip(rows[:-1], rows[1:])])
            return [sigmoid(x @ weights[:-1] + weights[-1])]

        return score

    return appended(docs, {"text": text}, "score double", work, "text")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score, predicted; learned from rows that aren't held out."""
    held_out = F.coalesce(crc32_of_id() % 5 == 0, F.lit(False))
    found = scored(docs, fit(docs, labels, usable=crc32_of_id() % 5 != 0))
    return found.select("row.doc_id", "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns."""
    return scored(docs, fit(docs, labels, usable=crc32_of_id() % 5 != 0)).where(F.col("score") >= THRESHOLD).select("row.*")
