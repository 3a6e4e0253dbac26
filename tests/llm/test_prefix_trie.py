"""The prefix trie against all prefixes of all conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stratalake.llm import prefix_trie
from stratalake.llm.queries import ready

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def code(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, code(role or "", text or ""), len(text or "")))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        out[c] = own.get(base, [])[:h] + t[h:]
    return out


def brute(sequences):
    members, ends, chars = defaultdict(list), defaultdict(list), {(): 0}
    for c, t in sequences.items():
        for d in range(len(t) + 1):
            p = tuple(x[0] for x in t[:d])
            members[p].append(c)
            chars[p] = t[d - 1][1] if d else 0
        ends[tuple(x[0] for x in t)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(members[p]) - 1) * chars[p]
            leaves[p[:d]] += p not in children
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
          hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def made(seed, n=250):
    """Copies, shared beginnings, deep conversations, nulls, ties, repeated rows and ids below 0."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 700), n):
        kind = rng.random()
        if kind < 0.3:
            texts = ["hi", "copy", "copy"]
        elif kind < 0.4:
            texts = ["hi"] + [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        else:
            texts = [rng.choice(["hi", "a", "b", "é日", "", None]) for _ in range(rng.randint(1, 7))]
        rows += [(c, k if rng.random() < 0.9 else rng.choice([None, 0, 1]), rng.choice(["user", "user", None]), t) for k, t in enumerate(texts)]
    rows += [rows[0], (None, 0, "user", "hi"), (None, None, None, None), (5_000, 0, "user", "long " * 100_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    ready(spark)
    clashing = ("t", "base", "head", "code", "codes", "key", "shard", "depth", "saved")
    kept = [(*r, *["x"] * len(clashing)) for r in rows]
    return spark.createDataFrame(kept, "conv_id bigint, turn bigint, role string, text string" + "".join(f", `{c}` string" for c in clashing))


def rows_of(df):
    return sorted((tuple(r) for r in df.withColumnRenamed("saved", "saved_tokens").select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize(("seed", "shard_turns", "group"), [(1, 100_000, 256), (2, 40, 2), (3, 15, 3)])
def test_nodes_like_all_prefixes(spark, seed, shard_turns, group):
    rows = made(seed)
    got = prefix_trie.nodes(prefix_trie.rebuilt(frame(spark, rows)), shard_turns, group)
    assert rows_of(got) == brute(rebuilt(rows))


def test_one_conversation_copied_many_times_falls_to_many_shards(spark):
    rows = [(100 * c, k, "user", f"t{k}") for c in range(400) for k in range(3)] + [(100 * c, 0, "user", f"u{c}") for c in range(400, 450)]
    got = prefix_trie.nodes(prefix_trie.sequences(frame(spark, rows)), 60, 4)
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((code(role, text), len(text)))
    assert rows_of(got) == brute(own)


def test_report_of_nothing_and_of_one(spark):
    assert prefix_trie.report(frame(spark, [])).count() == 0
    assert prefix_trie.report(frame(spark, [(None, 1, "a", "b")])).count() == 0
    got = prefix_trie.report(frame(spark, [(7, None, None, None)]))
    assert got.columns == list(COLUMNS)
    assert rows_of(got) == brute(rebuilt([(7, None, None, None)]))


def test_siblings_form_a_balanced_tree():
    tree = prefix_trie.Tree()
    for k in prefix_trie.medians(1_000):
        tree.insert([k], [1])

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.less[at]), height(tree.more[at]))

    assert height(tree.inner[0]) == 10 and sorted(prefix_trie.medians(37)) == list(range(37))
