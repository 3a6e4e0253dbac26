"""Periodic runs against brute force over all lags and places."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa

from stratalake.llm import periodic_runs
from stratalake.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """Every lag that some place could have, each maximal stretch looked at word by word."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic(rng):
    """Words of a small alphabet with repeated pieces, repetitions of repetitions and broken ones."""
    w = []
    for _ in range(rng.randint(0, 6)):
        piece = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))]
        if rng.random() < 0.4:
            piece = piece * rng.randint(2, 7) + [rng.choice("abx")]
        w += piece * rng.randint(1, 9)
        w += [rng.choice(["a", "b", "z", "é"]) for _ in range(rng.randint(0, 3))]
    return w


def found(texts):
    data, at = W.text_bytes(pa.array(texts, pa.string()))
    starts, ends, rows = W.spans(data, at, W.NOT_SPACE)
    got = periodic_runs.runs(W.hashes(data, starts, ends, False), rows)
    out = [[] for _ in texts]
    for k, s, n, q in zip(*(c.tolist() for c in got)):
        out[k].append((s, n, q))
    return out, periodic_runs.collapsed(data, starts, ends, rows, got).to_pylist()


def test_runs_and_kept_words_like_brute_force():
    rng = random.Random(4)
    texts = [None, "", " \n", "a", "a " * 5, "a " * 6, "a\n" * 7 + "b", "a b " * 3, "a b " * 4]
    texts += [" ".join(periodic(rng)) for _ in range(400)]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    runs, kept = found(texts)
    assert sum(map(len, runs)) > 500
    for text, r, k in zip(texts, runs, kept):
        w = WORD.findall(text or "")
        assert r == brute_runs(w), text
        gone = {i for s, n, q in r for i in range(s + q, s + n)}
        assert k == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_neighbouring_texts_do_not_join():
    assert found(["a a a", "a a a"]) == ([[], []], ["a a a", "a a a"])
    assert found(["a " * 6, "a " * 7]) == ([[(0, 6, 1)], [(0, 7, 1)]], ["a", "a"])


def test_long_periods_and_hostile_texts_stay_cheap():
    unit = [f"w{i}" for i in range(5_000)]
    runs, kept = found([" ".join(unit * 4), "x " * 200_000, " ".join(unit * 3 + unit[:4_999])])
    assert runs == [[(0, 20_000, 5_000)], [(0, 200_000, 1)], []]
    assert kept[:2] == [" ".join(unit), "x"]
    # Fibonacci and Thue-Morse words, and words that are peeled off one by one
    a, b = "a", "ab"
    while len(b) < 40_000:
        a, b = b, b + a
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(40_000))
    peeled = [f"p{i}" for i in range(8_000)] * 3 + [f"p{i}" for i in range(1, 8_000)]
    started = time.perf_counter()
    runs, _ = found([" ".join(b), " ".join(morse), " ".join(peeled)])
    assert time.perf_counter() - started < 30
    assert runs == [[], [], []]  # neither has a fourth power


def test_splitting_keeps_only_segments_of_frequent_words():
    w = "r1 a a a a a a r2 b c b c b c b c r3 d d d d r4".split()
    data, at = W.text_bytes(pa.array([" ".join(w)]))
    starts, ends, rows = W.spans(data, at, W.NOT_SPACE)
    places, segment = periodic_runs.survivors(W.hashes(data, starts, ends, False), rows)
    assert places.tolist() == [*range(1, 7), *range(8, 16)] and np.diff(segment.astype(int)).sum() == 1


def test_report_like_brute_force(table):
    rng = random.Random(8)
    rows = [(None, "a " * 9), (1, None), (1, None), (2, ""), (3, "word " * 2_000), (4, " ".join(f"x{i}" for i in range(1_000)))]
    rows += [(i, " ".join(periodic(rng)) if i % 3 else " ".join(rng.choice("abcdefghijkl") for _ in range(i))) for i in range(5, 150)]
    got = [tuple(r) for r in periodic_runs.report(table(rows)).collect()]
    assert sorted(got, key=repr) == sorted((brute_row(*r) for r in rows), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    empty = periodic_runs.report(table([]))
    assert empty.count() == 0 and [t for _, t in empty.dtypes] == ["bigint"] * 6 + ["string"] * 2


def test_operator_returns_runs_and_text_beside_all_columns(table):
    got = periodic_runs.found_in(table([(1, "so so so so so so it is")])).select("row.*", "runs", "collapsed").first()
    assert got["doc_id"] == 1 and got["row"] == "x" and got["collapsed"] == "so it is"
    assert [tuple(r) for r in got[got.__fields__.index("collapsed") - 1]] == [(0, 6, 1)]
