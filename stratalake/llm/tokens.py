"""Token ids of whole texts by a public tokenizer file, with each distinct chunk encoded once per task.

The tokenizer's rules never join characters across white space (its pre-tokenizer drops it), so a text
is cut at ASCII white space, each different chunk is encoded by the ``tokenizers`` library, and ids
are put together by numpy. Two more cuts that the rules allow make chunks meet more often: A-Z are
folded (the tokenizer folds them too, but for special tokens, which hold ``<``), and one ``.`` or ``,``
after an ASCII letter at a chunk's end is a chunk of its own. Chunks are known by 64-bit hashes. A
Python worker keeps its chunks from task to task; they are forgotten when there are ``CACHE_CHUNKS``,
so memory is bounded.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from stratalake.llm import words as W

CACHE_CHUNKS = 1 << 21
_LETTER = ((W.BYTES >= 0x41) & (W.BYTES <= 0x5A)) | ((W.BYTES >= 0x61) & (W.BYTES <= 0x7A))
_MARK = (W.BYTES == ord(",")) | (W.BYTES == ord("."))


class ChunkTokens:
    """``encode`` gives the ids of all rows of a text column, and where each row starts among them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._empty()

    def _empty(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        """Adds new chunks, given with sorted new keys."""
        if len(self.keys) + len(keys) > CACHE_CHUNKS:
            self._empty()
        found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        new = np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum()))
        at = len(self.ids) + np.cumsum(lengths) - lengths
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at = np.insert(self.keys, place, keys), np.insert(self.at, place, at)
        self.lengths, self.ids = np.insert(self.lengths, place, lengths), np.concatenate([self.ids, new])

    def encode(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, _ = W.spans(data, rows, W.NOT_SPACE)
        marked = np.flatnonzero((ends - starts > 1) & _MARK[data[ends - 1]] & _LETTER[data[ends - 2]])
        marks = ends[marked] - 1
        ends[marked] -= 1
        starts, ends = np.insert(starts, marked + 1, marks), np.insert(ends, marked + 1, marks + 1)
        before = np.searchsorted(starts, rows)
        keys = W.hashes(data, starts, ends, lower=True)
        angles = np.flatnonzero(data == ord("<"))
        if len(angles):  # as they are written
            exact = np.unique(np.searchsorted(starts, angles, "right") - 1)
            keys[exact] = ~W.hashes(data, starts[exact], ends[exact], lower=False)
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = (place < len(self.keys)) & (self.keys[np.minimum(place, max(len(self.keys) - 1, 0))] == distinct) if len(self.keys) else np.zeros(len(distinct), bool)
        if not known.all():
            if len(self.keys) + int((~known).sum()) > CACHE_CHUNKS:
                self._empty()
                known[:] = False
            new = first[~known]
            body = data.tobytes()
            self._learn(distinct[~known], [body[s:e].decode("utf-8", "replace") for s, e in zip(starts[new], ends[new])])
            place = np.searchsorted(self.keys, distinct)
        lengths = self.lengths[place][which]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        take = np.arange(total) + np.repeat(self.at[place][which] - (stops - lengths), lengths)
        return self.ids[take], np.concatenate([[0], stops])[before]


@lru_cache(maxsize=2)
def chunk_tokens(path: str) -> ChunkTokens:
    """This Python worker's encoder of a tokenizer file."""
    return ChunkTokens(path)
