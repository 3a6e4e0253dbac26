"""Words, word hashes and shingles of Arrow text columns, as numpy passes over UTF-8 bytes.

A word class is a table over the 256 byte values, so every character above ASCII belongs wholly to
words or wholly to gaps. A word's hash is a polynomial over a random value of each of its bytes,
modulo 2**64, then mixed; equal words have equal hashes, and with 64 bits different ones practically
never meet. All sizes of memory follow ``SLICE_BYTES``, not the batch; only one single row longer than
that is worked on alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Less than a power of two, so that ``powers`` of a slice are no more.
SLICE_BYTES = (1 << 20) - 2
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

BYTES = np.arange(256)
#: Bytes of words: everything but the ASCII space and \t \n \v \f \r.
NOT_SPACE = ~((BYTES == 0x20) | ((BYTES >= 0x09) & (BYTES <= 0x0D)))
#: Bytes of words: ASCII digits and letters, and all bytes of characters above ASCII.
ALNUM = ((BYTES >= 0x30) & (BYTES <= 0x39)) | ((BYTES >= 0x41) & (BYTES <= 0x5A)) | ((BYTES >= 0x61) & (BYTES <= 0x7A)) | (BYTES >= 0x80)
#: A-Z lower-cased, other bytes as they are.
LOWER = np.where((BYTES >= 0x41) & (BYTES <= 0x5A), BYTES + 32, BYTES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of the hash's base and of its inverse."""
    return _powers(1 << max(20, int(size).bit_length()))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty) and where each row starts, with the end appended."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    large = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    starts = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = large.buffers()[2]
    body = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return body, starts - starts[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` text bytes; a longer row is a run of its own."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def spans(data: np.ndarray, rows: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the number of words before each row (end appended)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    heads = rows[:-1][(rows[:-1] < rows[1:])]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    last = inside[:-1] & ~inside[1:]
    tails = heads[1:] - 1
    last[tails] = inside[tails]
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, rows)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z lower-cased if asked."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    values = (_VALUES[LOWER] if lower else _VALUES)[data]
    values *= up[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row and the number of runs before each row.

    A row of fewer words, but not none, has one run: the whole row.
    """
    counts = np.diff(rows)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(begins[-1]) - np.repeat(begins[:-1] - rows[:-1], runs)
    stop = np.repeat(rows[1:], runs)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    total = np.repeat(np.minimum(counts, size), runs).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    for k in range(size):
        factor = np.uint64((0x9FB21C651E98DF25 * (2 * k + 1) + 2 * k) % (1 << 64) | 1)
        total += np.where(at + k < stop, mix(padded[at + k] ^ factor) * factor, np.uint64(0))
    return mix(total), begins


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)
