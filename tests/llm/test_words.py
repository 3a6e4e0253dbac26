"""Word and shingle passes against regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa

from stratalake.llm import words as W

PIECES = ["a", "Ab", "é", "ß", "x1", " ", "\n", "\t", "  ", ".", "||", " ", "日本", "\x00", "\x7f"]


def texts(seed, n=60):
    rng = random.Random(seed)
    return [None, "", " ", *("".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n))]


def test_spans_are_the_words_of_each_row():
    for table, pattern in ((W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        rows = texts(1)
        data, at = W.text_bytes(pa.array(rows))
        starts, ends, before = W.spans(data, at, table)
        found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
        assert [found[a:b] for a, b in zip(before[:-1], before[1:])] == [re.findall(pattern, t or "") for t in rows]


def test_hashes_tell_words_apart_and_fold_ascii_only():
    rows = ["ABC abc Abc É é abcd ab c"]
    data, at = W.text_bytes(pa.array(rows))
    starts, ends, _ = W.spans(data, at, W.NOT_SPACE)
    low, exact = W.hashes(data, starts, ends, True), W.hashes(data, starts, ends, False)
    assert low[0] == low[1] == low[2] and low[3] != low[4]
    assert len(set(low.tolist())) == 6 and len(set(exact.tolist())) == 8


def test_shingles_of_short_rows_are_the_whole_row():
    rows = texts(2)
    data, at = W.text_bytes(pa.array(rows))
    starts, ends, before = W.spans(data, at, W.NOT_SPACE)
    hashes, begins = W.shingles(W.hashes(data, starts, ends, True), before, 4)
    seen = {}
    for k, t in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        runs = [tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        mine = hashes[begins[k] : begins[k + 1]].tolist()
        assert len(mine) == len(runs)
        for h, r in zip(mine, runs):
            assert seen.setdefault(r, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_keep_rows_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "", "c"])], ["text"])
    parts = list(W.slices(batch, limit=20))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert np.concatenate([W.text_bytes(p.column(0))[0] for p in parts]).tobytes() == b"a" * 10 + b"b" * 50 + b"c"
