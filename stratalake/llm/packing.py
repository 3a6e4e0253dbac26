"""Best-fit packing of token pieces, certified by lower bounds from dual-feasible functions.

A document is its token ids and one closing id; only longer ones than ``capacity`` are cut. Pieces are
dealt at random to packing partitions. In each, best-fit decreasing packs the pieces, and the largest of
a family of dual-feasible bounds tells how few bins any packing of these pieces needs. A partition that
meets its bound is certified and done. The others keep their full bins, and pool the pieces of their
open bins with those of other such partitions, into fewer partitions, to be packed again, until all are
certified, one partition is left, or a round brings nothing.

Defined results: a null or empty text is one piece of the closing id alone; repeated rows are packed
each; ties in length go by the order in the partition, which changes no count of bins. Rows may hold
null ids. An empty table gives an empty result.

Memory: a task holds the rows (not the ids) of at most about ``piece_bound`` pieces. Pooled partitions
hold only pieces of open bins, under the same bound.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import words as W
from stratalake.llm.batches import appended
from stratalake.llm.scratch import stored

PIECE_BOUND = 100_000
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"
ROUNDS = 8


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, closing: int = 1, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and one row per piece: number, start, length and CRC of its ids."""

    def work():
        from stratalake.llm.tokens import chunk_tokens

        encoder = chunk_tokens(tokenizer)

        def cut(batch: pa.RecordBatch) -> list:
            data, rows = W.text_bytes(batch.column(0))
            ids, at = encoder.encode(data, rows)
            out = []
            for a, b in zip(at[:-1], at[1:]):
                whole = np.append(ids[a:b], np.uint32(closing)).astype("<u4")
                out.append([
                    {"piece": k, "start": s, "length": len(p := whole[s : s + capacity]), "ids_crc32": zlib.crc32(p.tobytes())}
                    for k, s in enumerate(range(0, len(whole), capacity))])
            return [out]

        return cut

    found = appended(docs, {"text": text}, f"pieces array<struct<{PIECES.replace(' ', ':').replace(',:', ',')}>>", work, "text")
    return found.select("row", F.inline("pieces"))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: longest first, each into the fullest bin that it fits."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0  # bit r of rooms: some bin has room r
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, room, opened = opened, capacity, opened + 1
        bins[k], offsets[k] = b, capacity - room
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A proven lower bound of the bins needed, the best of three kinds of dual-feasible functions.

    Volume; "big piece" (for each e: pieces over capacity - e count whole, those under e nothing);
    rounding (for each k: (k+1)x/c rounded down and divided by k, unless it is an integer).
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for e in np.unique(np.minimum(sizes, capacity - sizes)):
        if 0 < e <= capacity // 2:
            used = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
            best = max(best, -(-int((used * counts).sum()) // capacity))
    for k in range(1, 65):
        grown = sizes * (k + 1)
        used = np.where(grown % capacity == 0, sizes * k, grown // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((used * counts).sum()) // (k * capacity)))
    return best


def _packed(capacity: int):
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        full = np.bincount(bins, lengths).astype(np.int64)
        certified = len(full) == least_bins(lengths, capacity)
        ids = np.int64(key[0].as_py()) * np.int64(1 << 32) + bins  # 2**32 bins a partition, 2**31 partitions over all rounds
        done = pa.array(np.full(len(lengths), certified) | (full[bins] == capacity))
        return table.drop_columns(["part"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets)).append_column("done", done).append_column("certified", pa.array(np.full(len(lengths), certified)))

    return pack


def pack(pieces: DataFrame, capacity: int = 4096, piece_bound: int = PIECE_BOUND, rounds: int = ROUNDS) -> DataFrame:
    """The pieces (a column ``length``) with sequence_id, offset and ``certified`` (its partition met its bound)."""
    kept = stored(pieces, "pieces")
    names, waiting = kept.columns, kept
    n = kept.count()
    out, first, before = None, 0, None
    for k in range(rounds):
        parts = max(1, math.ceil(n / piece_bound))
        dealt = waiting.withColumn("part", (F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(k)), F.lit(parts)) + first).cast("bigint"))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", sequence_id bigint, offset bigint, done boolean, certified boolean"
        result = stored(dealt.groupBy("part").applyInArrow(_packed(capacity), schema), "packed")
        left, open_bins = result.where("not done").agg(F.count("*"), F.count_distinct("sequence_id")).first()
        final = left == 0 or parts == 1 or k == rounds - 1 or (before is not None and open_bins >= before)
        taken = result if final else result.where("done")
        out = taken if out is None else out.unionByName(taken)
        if final:
            break
        first, n, before, waiting = first + parts, left, open_bins, result.where("not done").select(names)
    return out.drop("done")


def sequences(docs: DataFrame, tokenizer: str, capacity: int = 4096, closing: int = 1, piece_bound: int = PIECE_BOUND) -> DataFrame:
    """Per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified."""
    found = token_pieces(docs, tokenizer, capacity, closing).select("row.doc_id", "piece", "start", "length", "ids_crc32")
    return pack(found, capacity, piece_bound)
