import hashlib
import random
from collections import Counter

import pytest

from stratalake.llm import suffix_dedup, suffixes


def brute_runs(strings, weights, length):
    times = Counter()
    for s, w in zip(strings, weights):
        for i in range(len(s) - length + 1):
            times[s[i : i + length]] += w
    out = []
    for s in strings:
        hit = [times[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] + [False]
        runs, start = [], None
        for i, h in enumerate(hit):
            if h and start is None:
                start = i
            elif not h and start is not None:
                runs.append((start, i))
                start = None
        out.append(runs)
    return out


def test_two_stage_sorting_finds_repeats_like_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        length = rng.choice([1, 2, 3, 5, 8, 15])
        alphabet = rng.choice([b"ab", b"abc", b"\x00\xffa", bytes(range(256))])
        strings = []
        for _ in range(rng.randint(1, 6)):
            s = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            if strings and rng.random() < 0.5:
                s = s[: rng.randint(0, len(s))] + rng.choice(strings)[rng.randint(0, 10) :] + s[:3]
            strings.append(s[:1] * rng.randint(0, 60) if rng.random() < 0.2 else s)
        weights = [rng.choice([1, 1, 1, 2]) for _ in strings]
        assert suffixes.repeated(strings, weights, length) == brute_runs(strings, weights, length)


def test_suffix_array_is_sorted():
    text = suffixes.Strings([b"banana", b"bananas", b"", b"ananas"], 3)
    order = suffixes.suffix_array(text)
    parts = [bytes((text.symbols[i : i + 3] - 1).astype("u1")) for i in order]
    assert parts == sorted(parts) and len(parts) == 4 + 5 + 4


def brute(docs, length):
    bodies = [(d, (t or "").encode()) for d, t in docs]
    runs = brute_runs([b for _, b in bodies], [1] * len(bodies), length)
    out = []
    for (d, b), rs in zip(bodies, runs):
        gone = {k for a, e in rs for k in range(a, e + length - 1)}
        kept = bytes(x for k, x in enumerate(b) if k not in gone)
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((d, len(b), len(gone), spans, hashlib.sha256(kept).hexdigest(), len(kept), len(gone) > 0))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    shared, line = text(70), text(45)
    docs = [(k, text(rng.randint(0, 60)) + rng.choice([shared, line, "", line[5:]]) + text(rng.randint(0, 80))) for k in range(40)]
    docs += [(100 + k, docs[1][1]) for k in range(6)]
    return [*docs, (None, docs[2][1]), (None, None), (7, None), (8, ""), (200, "x" * 500), (201, "ab " * 300), (202, "x" * 39), (203, text(3000) + shared + text(10))]


@pytest.mark.parametrize("seed, hot", [(1, 1000), (2, 1), (3, 3)])
def test_like_brute_force_with_copies_hot_passages_and_odd_rows(table, spark, monkeypatch, seed, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = corpus(seed)
    got = suffix_dedup.report(table(docs), 40, 10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, 40)


def test_window_anchors_are_leftmost_minima():
    import numpy as np

    grams = np.array([5, 3, 9, 3, 7, 1, 8, 8, 2], np.uint64) << np.uint64(40)
    got = suffix_dedup.window_anchors(grams, 3)
    assert got.tolist() == [1, 1, 3, 5, 5, 5, 8]


def test_long_texts_in_overlapping_pieces(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    data = rng.integers(0, 4, 5000).astype(np.uint8)
    whole = suffix_dedup.stretches(data, 40, 10)
    starts, sizes, _, _ = whole
    covered = np.zeros(5000 - 39, int)
    for s, n in zip(starts, sizes):
        covered[s : s + n - 39] += 1
    assert (covered == 1).all()


def test_cleaned_texts_stay_text_and_keep_columns(table, spark):
    passage = "äöü" * 30
    docs = table([(1, "é" + passage + "1"), (2, "ê" + passage + "2"), (3, "short"), (4, None)], extra=("n_chars",))
    docs = docs.withColumn("n_chars", docs.doc_id * 0)
    got = {r.doc_id: r for r in suffix_dedup.cleaned(docs, 40, 10).collect()}
    assert suffix_dedup.cleaned(docs, 40, 10).columns == docs.columns
    assert (got[1].text, got[1].n_chars, got[2].text) == ("é1", 2, "ê2") and got[3].text == "short" and got[4].text is None


def brute_words(docs, length):
    times = Counter(tuple(w[i : i + length]) for w in docs for i in range(len(w) - length + 1))
    out = []
    for w in docs:
        hit = [i for i in range(len(w) - length + 1) if times[tuple(w[i : i + length])] > 1]
        gone = {k for i in hit for k in range(i, i + length)}
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


@pytest.mark.parametrize("seed, hot", [(1, 1000), (2, 1), (3, 3)])
def test_passages_counted_in_words_like_brute_force(table, spark, monkeypatch, seed, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(seed)
    words = lambda n: [rng.choice(["a", "b", "é", "ccc"]) for _ in range(n)]
    shared, line = words(30), words(13)
    docs = [words(rng.randint(0, 20)) + rng.choice([shared, line, [], line[2:], shared[:19]]) + words(rng.randint(0, 25)) for _ in range(40)]
    docs += [["x"] * 50, words(8) + ["y"] * 11, docs[3], docs[3], []]
    gaps = [" ", "\n", "  ", "\t"]
    texts = [rng.choice(["", " "]) + "".join(w + rng.choice(gaps) for w in d) for d in docs]
    got = {r.doc_id: r.text.split() for r in suffix_dedup.cleaned(table(list(enumerate(texts))), 12, 3, words=True).collect()}
    assert [got[k] for k in range(len(docs))] == brute_words(docs, 12)


def test_empty_table(table, spark):
    assert suffix_dedup.report(table([])).count() == 0


def test_a_group_of_word_passages_keeps_memory_bounded():
    import random
    import tracemalloc

    rng = random.Random(4)
    one = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)).encode() for _ in range(suffix_dedup.PART_BYTES // 1500)]
    tracemalloc.start()
    runs = suffix_dedup.repeated_words(one + one + [b"alone " * 3], [1] * (2 * len(one) + 1), 51)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert runs == [[(0, 50)]] * (2 * len(one)) + [[]]
    assert peak < 96 << 20
