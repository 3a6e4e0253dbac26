import random
import zlib
from collections import Counter

import pytest

from stratalake.llm import sharding


def test_matrix_has_exact_margins():
    rng = random.Random(1)
    for _ in range(50):
        counts = [rng.choice([0, 1, 5, 1000, 12345]) for _ in range(rng.randint(0, 8))]
        matrix = sharding.communication_matrix(counts, 16, rng.randrange(100))
        assert [sum(r) for r in matrix] == counts and all(x >= 0 for r in matrix for x in r)
        sizes = [sum(c) for c in zip(*matrix)] or [0]
        assert max(sizes) - min(sizes) <= 1


def test_draws_follow_the_hypergeometric_law():
    rng = random.Random(2)
    seen = Counter(sharding.hypergeometric(rng, 10, 15, 40) for _ in range(20_000))
    from math import comb

    for k in range(11):
        p = comb(15, k) * comb(25, 10 - k) / comb(40, 10)
        assert seen[k] / 20_000 == pytest.approx(p, abs=4 * (p / 20_000) ** 0.5 + 1e-3)
    large = [sharding.hypergeometric(rng, 10**8, 10**8, 16 * 10**8) for _ in range(50)]
    assert abs(sum(large) / 50 / (10**8 / 16) - 1) < 1e-3


def check(rows, docs):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(k, [])) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))


def test_exact_sizes_and_gapless_slots(table, spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 10)
    docs = [(k, "copy" if k % 3 else f"text é {k}") for k in range(1000)] + [(None, None), (1, None), (1, ""), (2, "x" * 100_000)]
    got = sharding.report(table(docs).repartition(7)).collect()
    check(got, docs)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_rows_are_spread_over_shards_and_places(table, spark):
    docs = [(k, "x") for k in range(3200)]
    got = sharding.report(table(docs).coalesce(1)).collect()
    first = Counter(r.shard for r in got if r.doc_id < 1600)
    assert all(60 < first[k] < 140 for k in range(16))
    early = sum(r.slot < 100 for r in got if r.doc_id < 1600)
    assert 700 < early < 900


def test_few_rows_and_none(table, spark):
    check(sharding.report(table([(1, "a"), (2, "b")])).collect(), [(1, "a"), (2, "b")])
    assert sharding.report(table([])).count() == 0


def test_plan_has_no_python(table, spark):
    plan = sharding.report(table([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
