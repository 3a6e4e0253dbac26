import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import language_model, markov

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def chain(states=3, symbols=5, seed=2):
    rng = np.random.default_rng(seed)
    return markov.Chain(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(symbols), states).T.copy())


def paths(c, s):
    for z in itertools.product(range(len(c.start)), repeat=len(s)):
        p = c.start[z[0]] * c.emit[s[0], z[0]]
        for a, b, o in zip(z, z[1:], s[1:]):
            p *= c.move[a, b] * c.emit[o, b]
        yield z, p


def test_forward_recursion_sums_over_all_paths():
    c, rng = chain(), np.random.default_rng(1)
    lengths = [1, 4, 2, 6, 3]
    symbols = rng.integers(0, 5, sum(lengths))
    rows = np.concatenate([[0], np.cumsum(lengths)])
    got = markov.log_likelihoods(c, symbols, rows)
    for k in range(5):
        assert got[k] == pytest.approx(math.log(sum(p for _, p in paths(c, symbols[rows[k] : rows[k + 1]]))))


def test_segments_of_long_sequences_are_exact(monkeypatch):
    c, rng = chain(), np.random.default_rng(3)
    rows = np.array([0, 50, 57, 57, 200])
    symbols = rng.integers(0, 5, 200)
    whole = markov.log_likelihoods(c, symbols, rows)
    monkeypatch.setattr(markov, "SEGMENT", 7)
    assert np.allclose(whole, markov.log_likelihoods(c, symbols, rows))
    assert whole[2] == 0


def test_baum_welch_counts_like_brute_force():
    c, s = chain(), np.array([0, 3, 1, 4, 2, 2, 0])
    rows = np.array([0, 4, 7])
    first, move, emit = markov.expected_counts(c, s, rows)
    e_first, e_move, e_emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for a, b in zip(rows, rows[1:]):
        total = sum(p for _, p in paths(c, s[a:b]))
        for z, p in paths(c, s[a:b]):
            e_first[z[0]] += p / total
            for x, y in zip(z, z[1:]):
                e_move[x, y] += p / total
            for o, x in zip(s[a:b], z):
                e_emit[o, x] += p / total
    assert np.allclose(first, e_first) and np.allclose(move, e_move) and np.allclose(emit, e_emit)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(5)
    rows = np.arange(0, 2001, 20)
    symbols = np.concatenate([rng.choice(5, 20, p=p) for p in rng.dirichlet(np.ones(5) * 0.2, 3)[rng.integers(0, 3, 100)]])
    usual = (np.bincount(symbols, minlength=5) + 0.5) / (len(symbols) + 2.5)
    c = markov.first_chain(symbols, rows, usual, 3)
    before = markov.log_likelihoods(c, symbols, rows).sum()
    for _ in range(3):
        c = markov.refitted(*markov.expected_counts(c, symbols, rows), usual, weight=0.1)
    assert markov.log_likelihoods(c, symbols, rows).sum() > before
    assert np.allclose(c.emit.sum(axis=0), 1) and np.allclose(c.move.sum(axis=1), 1)


def brute_base(docs):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    tokens = [(i, [*WORD.findall((t or "").translate(FOLD)), None]) for i, t in docs]
    c = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted(
        ((i, held[i], len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in tokens),
        key=repr)


def cases():
    rng = random.Random(8)
    names = [["the", "of", "and", "Cat"], ["der", "und", "ß", "die"]]
    docs = [(i, " ".join(rng.choice(names[i % 2]) + rng.choice(["", "", "x", str(rng.randint(0, 99))]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    return [*docs, (None, "the und"), (3, None), (4, ""), (4, ""), (200, "the of " * 20_000)]


@pytest.mark.parametrize("top", [8, language_model.TOP])
def test_base_scores_and_counts_like_brute_force(table, spark, monkeypatch, top):
    monkeypatch.setattr(language_model, "TOP", top)
    docs = cases()
    got = language_model.report(table(docs)).collect()
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr)
    assert rows == brute_base(docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_without_training_texts(table, spark):
    assert language_model.report(table([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    only = language_model.report(table([(held, "a b")])).first()
    assert (only.n_tokens, only.n_known, only.train_tokens) == (3, 0, 0) and only.base_score == pytest.approx(0) and math.isfinite(only.score)


def test_chances_within_a_class_sum_to_at_most_one(spark, table):
    counts = language_model.word_counts(table([(1, " ".join(f"w{k}" for k in range(300)) * 2)]).selectExpr("false as held_out", "text"))
    v = language_model.Vocabulary(counts)
    rows = [r for r in counts.collect() if r.h != int(np.int64(language_model.END.astype(np.int64)))]
    assert v.total == sum(r.c for r in rows) + 1 and v.distinct == len(rows) + 1
    own = {int(w.astype(np.int64)) for w, o in zip(v.words, v.own) if o >= 0}
    for shared in {r.shared for r in rows}:
        inside = [r.c for r in rows if r.shared == shared and r.h not in own]
        total = sum(10 ** v.within(np.array([shared]), np.array([c]))[0] for c in inside)
        assert total + 10 ** v.within(np.array([shared]), np.array([0]))[0] == pytest.approx(1)


def test_all_rounds_count_all_training_texts(spark):
    rng = np.random.default_rng(4)
    rows = [rng.choice(40, 12) + 40 * int(rng.integers(0, 3)) for _ in range(2_200)] + [np.arange(9)] * 900
    symbols, at = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    usual = (np.bincount(symbols, minlength=language_model.CLASSES) + 0.5) / (len(symbols) + 0.5 * language_model.CLASSES)
    chain = markov.seeded_chain(usual, 3)
    for _ in range(2):
        chain = markov.refitted(*markov.expected_counts(chain, symbols, at), usual)
    texts = spark.createDataFrame([(r.astype("<u2").tobytes(),) for r in rows], "classes binary").repartition(3, F.rand(1))
    got = language_model.trained(texts, type("V", (), {"usual": usual}), 3, 2)
    assert np.allclose(got.emit, chain.emit) and np.allclose(got.move, chain.move) and np.allclose(got.start, chain.start)


def test_counters_of_many_tasks_are_added_in_two_levels(spark):
    """Counters of tasks that lie far apart: sums are exact, and blocks stay apart."""
    from stratalake.llm import language_model as L

    ones = np.arange(L.BLOCK, dtype=float).tobytes()
    rows = [(b, t // L.TOGETHER, ones) for b in (0, 1) for t in (0, 1, L.TOGETHER, 50 * L.TOGETHER, 99 * L.TOGETHER + 7)]
    found = {r.block: np.frombuffer(r.counts) for r in L.added(spark.createDataFrame(rows, L.COUNTS)).collect()}
    assert sorted(found) == [0, 1] and all(np.array_equal(v, 5 * np.arange(L.BLOCK)) for v in found.values())
    assert L.added(spark.createDataFrame([], L.COUNTS)).count() == 0
