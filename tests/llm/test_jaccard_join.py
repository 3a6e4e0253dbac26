import random
import re

import pyarrow as pa
import pytest

from stratalake.llm import components, jaccard_join, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(docs, size, percent):
    sets = []
    for _, t in docs:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def near(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return words


def corpus(seed, families=6, singles=20):
    """Families of near copies that reach across chains, a passage that many share, odd rows."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([3, 8, 60, 120]))]
        for _ in range(rng.randint(1, 14)):
            base = near(rng, base, rng.choice([0, 0, 1, 1, 2])) if rng.random() < 0.7 else base
            texts.append(" ".join(base) if rng.random() < 0.8 else "  ".join(base).upper())
    for _ in range(singles):
        own = [word() for _ in range(rng.randint(1, 80))]
        texts.append(" ".join(own + passage * (rng.random() < 0.7)))
    rng.shuffle(texts)
    return [*enumerate(texts), (None, texts[0]), (None, "only me here now"), (500, None), (501, ""), (502, " \n"), (3, texts[3]), (503, "b " * 30_000)]


@pytest.mark.parametrize("seed, small, size, percent", [(1, 12, 4, 85), (2, 2, 4, 85), (3, 2, 5, 80), (4, 3, 2, 60)])
def test_components_like_brute_force(table, spark, monkeypatch, seed, small, size, percent):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    monkeypatch.setattr(jaccard_join, "MINOR", small)
    docs = corpus(seed)
    got = jaccard_join.components_of(table(docs), size, percent)
    assert sorted(((r.id, r.n, r.component) for r in got.collect()), key=repr) == brute(docs, size, percent)


def test_one_of_each_component_stays(table, spark):
    docs = corpus(5)
    kept = jaccard_join.one_of_each(table(docs))
    assert set(kept.columns) == set(table([]).columns)
    expected = {c for d, n, c in brute(docs, 5, 80) if n and c is not None}
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert {d for d, _ in rows} >= expected and len(rows) == len(set(rows))
    groups = dict(zip([i for i, _ in enumerate(docs)], brute(docs, 5, 80)))
    assert len(rows) == len({c if c is not None else f"none{k}" for k, (_, n, c) in groups.items() if n}) + 3  # and those without words


def test_nothing_and_alone(table, spark):
    assert jaccard_join.report(table([])).count() == 0
    assert [tuple(r) for r in jaccard_join.report(table([(5, "a b"), (6, None)])).orderBy("doc_id").collect()] == [(5, 1, 5), (6, 0, 6)]


def test_a_group_with_a_third_of_all_rows(table, spark):
    rng = random.Random(6)
    base = [f"w{k}" for k in range(100)]
    docs = [(k, " ".join(near(rng, base, 1))) for k in range(300)] + [(1000 + k, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))) for k in range(600)]
    got = {r.doc_id: r.component_id for r in jaccard_join.report(table(docs)).collect()}
    assert {got[k] for k in range(300)} == {0} and all(got[k] == k for k in got if k >= 1000)


def test_a_dense_group_of_copies_that_mostly_do_not_link(table, spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "MINOR", 4)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    docs = [(k, " ".join(near(rng, base, rng.choice([0, 1, 2, 3, 4, 5, 6])))) for k in range(150)]
    docs += [(200 + k, t.replace("w77", "x")) for k, (_, t) in enumerate(docs[:40])]
    got = jaccard_join.components_of(table(docs), 4, 85)
    assert sorted(((r.id, r.n, r.component) for r in got.collect()), key=repr) == brute(docs, 4, 85)


def dense(seed, copies, most):
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(90)]
    return list(enumerate(" ".join(near(rng, base, rng.randint(1, most))) for _ in range(copies)))


@pytest.mark.parametrize("seed, most", [(2, 7)])
def test_changes_divide_a_dense_group_down_to_single_links(table, spark, monkeypatch, seed, most):
    for name, value in {"SMALL": 3, "CLOSE": 5, "MINOR": 1, "PIVOTS": 2}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    docs = dense(seed, 70, most)
    found = jaccard_join.report(table(docs))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, 4, 85)


def test_a_dense_group_takes_few_levels_and_pairs(table, spark, monkeypatch):
    levels, pairs = [], []
    mixed, distances = jaccard_join._mixed, jaccard_join._distances

    def counted(asked, *more):
        pairs.append(asked.count())
        return distances(asked, *more)

    monkeypatch.setattr(jaccard_join, "_mixed", lambda *a: levels.append(1) or mixed(*a))
    monkeypatch.setattr(jaccard_join, "_distances", counted)
    docs = dense(5, 300, 12)
    found = jaccard_join.report(table(docs))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, 4, 85)
    assert len(levels) <= 5
    assert sum(pairs) < 300 * 40


def test_long_texts_near_and_apart(table, spark):
    """Sets of over BITS shingles, some at the edge of linking, some that share half, one with a short partner."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(2500)]
    docs = [(k, " ".join(near(rng, base, changes))) for k, changes in enumerate([0, 20, 45, 50, 52, 55, 60, 90, 300])]
    docs += [(20 + k, " ".join(base[:1250] + [f"o{k}-{j}" for j in range(1250)])) for k in range(8)]
    edge = [f"e{k}" for k in range(1100)]
    docs += [(40, " ".join(edge)), (41, " ".join(edge[:1000])), (42, " ".join(edge[:900]))]
    assert sorted(((r.id, r.n, r.component) for r in jaccard_join.components_of(table(docs), 4, 85).collect()), key=repr) == brute(docs, 4, 85)


def test_roots_of_paths_and_stars(spark):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: find(n) for n in nodes if find(n) != n}


def test_rare_shingles_have_counters_of_their_own(spark):
    n = 300_000  # more different shingles than a sketch of 2**18 counters can tell apart
    docs = spark.range(60).selectExpr(f"concat_ws(' ', transform(sequence(id * {n // 60}, id * {n // 60} + {n // 60 + 2}), x -> concat('w', x))) as text")
    sketch = jaccard_join.frequency_sketch(docs, 4)
    once = 300_000 - 60 * 3
    assert sketch.sum() >= once
    assert (sketch == 1).sum() > 0.7 * once


def test_batches_for_python_workers_are_bounded_by_their_bytes(spark, tmp_path):
    spark.range(40).selectExpr("id as doc_id", "repeat('word ', 200000) as text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = queries.table(spark, str(tmp_path), "documents")
    sizes = docs.mapInArrow(lambda batches: (b.select([0]).slice(0, 1).set_column(0, "doc_id", pa.array([b.num_rows])) for b in batches), "doc_id bigint")
    assert max(r.doc_id for r in sizes.collect()) <= 1 + queries.BATCH_BYTES // 1_000_000
