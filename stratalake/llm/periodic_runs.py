"""Stretches of words that repeat with a period (runs), found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a length
of at least ``max(6, 4 * q)`` that neither neighbouring word extends. Each of its words therefore occurs
at least ``OFTEN`` times in any segment that holds the run. So:

1. *Splitting.* A text is one segment. Words that occur fewer than ``OFTEN`` times within their segment
   are in no run and split it; pieces of fewer than ``SHORTEST`` words go. Segments that lost words are
   counted again until none does. The work is bounded by ``ROUNDS`` counts of the whole slice; a hostile
   text that would still split then is left to the scan, which needs no stability to be exact.
2. *Lag scan.* Lags are taken by powers of two, P <= q < 2 P. Words q apart that are equal over a run's
   3 q words hold two blocks or more of P words that begin at multiples of P, so only those beginnings are
   compared, P lags with one block each: as many comparisons as words for each power. Blocks of P words are
   compared by exact numbers (a block's number comes from those of its two halves, no hashing), and the
   same numbers lengthen a stretch of blocks word by word to both sides.
3. A stretch found at a multiple of its smallest period has the same two ends there; the least lag stays.

All segments of an Arrow slice are worked on together in numpy; every text is whole, and memory follows
the slice (a text longer than a slice is a slice of its own, at some 150 bytes a word that survives splitting).

Defined results: a null text is the empty one and has no runs; words are `[^\\x20\\x09-\\x0D]+` and told apart by
64-bit hashes; runs are ordered by start, then period; repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import words as W
from stratalake.llm.batches import appended

SHORTEST, OFTEN, ROUNDS, CELLS = 6, 4, 64, 1 << 18
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def survivors(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that can be in runs, ascending, and the segment of each; segments ascend as well."""
    at = np.arange(len(words))
    segment = np.repeat(np.arange(len(rows) - 1, dtype=np.uint64), np.diff(rows))
    kept, work = [at[:0]], ROUNDS * len(words)
    while len(at) and work > 0:
        work -= len(at)
        _, which, times = np.unique(W.mix(words[at] ^ W.mix(segment)), return_inverse=True, return_counts=True)
        often = times[which] >= OFTEN
        splits = np.isin(segment, np.unique(segment[~often]))
        kept.append(at[~splits])
        at, segment = at[often & splits], segment[often & splits]
        at, segment = _pieces(at, segment)
    at = np.sort(np.concatenate([*kept, at]))
    return _pieces(at, np.searchsorted(rows, at, "right"))


def _pieces(at: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring places of one ``within`` as numbered pieces, without those that are too short."""
    fresh = np.ones(len(at), np.int64)
    fresh[1:] = (np.diff(at) > 1) | (within[1:] != within[:-1])
    pieces = np.cumsum(fresh) - 1
    long = np.bincount(pieces, minlength=1)[pieces] >= SHORTEST
    return at[long], (np.cumsum(fresh[long]) - 1).astype(np.uint64)


class Blocks:
    """Exact numbers of the blocks of 1, 2, 4 ... words at each place; blocks beyond the end have none."""

    def __init__(self, words: np.ndarray):
        self.levels = [np.unique(words, return_inverse=True)[1].astype(np.int32)]

    def of(self, level: int) -> np.ndarray:
        while len(self.levels) <= level:
            half, size = self.levels[-1].astype(np.int64), 1 << (len(self.levels) - 1)
            pairs = half[:-size] * (int(half.max(initial=0)) + 1) + half[size:] if size < len(half) else half[:0]
            self.levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
        return self.levels[level]

    def ahead(self, a: np.ndarray, b: np.ndarray, end: np.ndarray, level: int) -> np.ndarray:
        """How many words, under 2 ** level, are equal from places a and b on, b's before ``end``."""
        return self._along(a, b, end, level, 1)

    def behind(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray, level: int) -> np.ndarray:
        """How many words, under 2 ** level, are equal before places a and b, a's not before ``begin``."""
        return self._along(a, b, begin, level, -1)

    def _along(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, level: int, way: int) -> np.ndarray:
        done = np.zeros(len(a), np.int64)
        for k in range(level - 1, -1, -1):
            size, block = 1 << k, self.of(k)
            if way > 0:
                x, y = a + done, b + done
                room = y + size <= limit
            else:
                x, y = a - done - size, b - done - size
                room = x >= limit
            top = max(len(block) - 1, 0)
            same = room & (block[np.clip(x, 0, top)] == block[np.clip(y, 0, top)]) if len(block) else np.zeros(len(a), bool)
            done += np.where(same, size, 0)
        return done


def _stretches(blocks: Blocks, level: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, lag) of all stretches long enough at lags of 2 ** level or more, under twice that.

    ``begin`` and ``end`` are the limits of each word's segment.
    """
    size, block = 1 << level, blocks.of(level)
    anchors = np.arange(0, len(begin), size)
    anchors = anchors[end[anchors] - begin[anchors] >= max(SHORTEST, 4 * size)]
    found = []
    wide = max(1, CELLS // max(len(anchors), 1))
    for first in range(size, 2 * size, wide):
        lags = np.arange(first, min(first + wide, 2 * size))
        # one row per lag, so that a stretch of blocks is a stretch of one row; rows are kept apart by a last False
        there = anchors[None, :] + lags[:, None]
        inside = there + size <= end[anchors][None, :]
        same = np.zeros((len(lags), len(anchors) + 1), bool)
        if len(block):
            top = len(block) - 1
            same[:, :-1] = inside & (block[np.minimum(anchors, top)][None, :] == block[np.minimum(there, top)])
        edge = np.diff(np.concatenate([[0], same.ravel().astype(np.int8)]))
        opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(opens):
            continue
        row, left, right = opens // (len(anchors) + 1), opens % (len(anchors) + 1), (closes - 1) % (len(anchors) + 1)
        found.append((lags[row], left, right))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    lag, left, right = (np.concatenate(c) for c in zip(*found))
    # anchors next to each other in the list may have a gap or a segment's end between them
    lag, a, b = _apart(lag, left, right, anchors, begin, size)
    least = np.maximum(SHORTEST, 4 * lag) - lag
    long = b - a + 2 * (size - 1) >= least
    lag, a, b = lag[long], a[long], b[long]
    if not len(lag):
        return (np.zeros(0, np.int64),) * 3
    start, stop = begin[a], end[a]
    first = a - blocks.behind(a, a + lag, start, level)
    last = b + lag + blocks.ahead(b, b + lag, stop, level)
    long = last - first >= np.maximum(SHORTEST, 4 * lag)
    return first[long], last[long], lag[long]


def _apart(lag: np.ndarray, left: np.ndarray, right: np.ndarray, anchors: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of anchors cut where their blocks don't follow each other in one segment: (lag, first word, end)."""
    cut = np.ones(len(anchors) + 1, bool)
    cut[1:-1] = (np.diff(anchors) != size) | (np.diff(begin[anchors]) != 0)
    starts = np.flatnonzero(cut)
    pieces = np.searchsorted(starts, right, "right") - np.searchsorted(starts, left, "right") + 1
    which = np.repeat(np.arange(len(left)), pieces)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    base = np.searchsorted(starts, left, "right")[which] + nth
    a = np.where(nth == 0, left[which], starts[np.minimum(base - 1, len(starts) - 1)])
    b = np.where(nth == pieces[which] - 1, right[which], starts[np.minimum(base, len(starts) - 1)] - 1)
    return lag[which], anchors[a], anchors[b] + size


def runs(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period; starts are word numbers within the text."""
    at, segment = survivors(words, rows)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none, none
    sizes = np.bincount(segment.astype(np.int64))
    ends = np.cumsum(sizes)
    begin, end, blocks = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes), Blocks(words[at])
    found, level = [], 0
    while level == 0 or sizes.max() >= 4 << level:
        first, last, lag = _stretches(blocks, level, begin, end)
        found.append((at[first], last - first, lag))
        level += 1
    start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(rows, start, "right") - 1
    return text, start - rows[text], length, period


def collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, found: tuple[np.ndarray, ...]) -> pa.Array:
    """Each text's words without those that a run holds after its first period, joined by one space."""
    text, start, length, period = found
    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, rows[text] + start + period, 1)
    np.add.at(step, rows[text] + start + length, -1)
    stays = np.cumsum(step)[:-1] == 0
    before = np.concatenate([[0], np.cumsum(stays)])[rows]
    a, b = starts[stays], ends[stays]
    sizes = b - a + 1  # with a space after each word
    stops = np.cumsum(sizes)
    out = np.full(int(stops[-1]) if len(stops) else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[stops - 1] = False
    mask = np.zeros(len(data) + 1, np.int8)
    mask[a] += 1
    mask[b] -= 1
    out[inside] = data[np.cumsum(mask[:-1], dtype=np.int8).astype(bool)]
    edges = np.concatenate([[0], stops])[before]
    # the space after a text's last word belongs to no text, so it is taken out
    last = edges[1:][np.diff(edges) > 0] - 1
    out = np.delete(out, last)
    texts = np.concatenate([[0], np.cumsum(np.diff(before) > 0)])
    return pa.Array.from_buffers(pa.large_string(), len(rows) - 1, [None, pa.py_buffer((edges - texts).astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())


def found_in(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``runs`` (by start, then period) and ``collapsed``, the text without repetitions."""

    def work():
        fields = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]
        kind = pa.list_(pa.field("element", pa.struct(fields)))

        def find(batch: pa.RecordBatch) -> list:
            data, at = W.text_bytes(batch.column(0))
            starts, ends, rows = W.spans(data, at, W.NOT_SPACE)
            found = runs(W.hashes(data, starts, ends, False), rows)
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in found[1:]], fields=fields)
            offsets = np.searchsorted(found[0], np.arange(len(rows)))
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs, type=kind), collapsed(data, starts, ends, rows, found)]

        return find

    return appended(docs, {"text": text}, f"runs {RUNS}, collapsed string", work, "text")


def rewritten(text: str = "text", key: str = "doc_id") -> Column:
    """The text with a periodic tail where crc32 of the id is divisible by 10 (the query's own planting).

    With h the checksum, g = floor(h / 10) and n words, each word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and texts without an id or words, stay.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(w, a + i % p))
        return F.array_join(F.concat(F.slice(w, 1, a), again), " ")

    # one element, so that the words are made once
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(F.col(text)))
    return F.when((h % 10 == 0) & F.col(text).isNotNull(), F.get(made, F.lit(0))).otherwise(F.col(text))


def report(docs: DataFrame) -> DataFrame:
    """Per document: n_runs, the longest run (ties: smallest start, then period; none: nulls) and digests of all runs and kept words."""
    found = found_in(docs.select("doc_id", rewritten().alias("text"))).select("row.doc_id", "runs", "collapsed")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    out = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.short")
    return out.select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div -best.short").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
