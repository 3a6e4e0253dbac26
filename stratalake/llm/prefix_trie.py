"""Prefix trie over conversations: ternary search trees per range shard, and merging of the nodes that shards share.

1. A turn's code is the md5 of its role and text. A conversation is the list of its turns' codes and sizes.
2. Conversations are dealt out by ranges of (codes, conv_id), so copies of one conversation, however many, and the
   conversations under one hot first turn fall to as many shards as they need.
3. A shard encodes its codes with a dictionary of its own (small ids in the order of the codes) and inserts its
   different sequences into a ternary search tree, the median first and then the medians of both halves, so that the
   siblings of every node form a balanced binary tree. An iterative traversal, leaves first, gives each node's
   members, least member, leaves and savings.
4. Only nodes on the paths to a shard's first and last sequence can stand in other shards too. They leave the shard as
   partial sums; all others are final. Partial nodes come in order, so one pass with a stack as deep as the trie merges
   those of ``GROUP`` shards, and what the ends of a group may share with other groups goes on to the next round.
5. The ids of a partial node's ends are joined per shard, and one streaming pass over these pieces makes their digest.

Bounds: a shard holds some ``SHARD_TURNS`` turns; a task sees one shard, or streams partial nodes. A single conversation's
codes (16 bytes a turn) are one row, as its text would be. Nothing reaches the driver but the number of turns.

Defined results: a null role or text is the empty one; null turns come first, and turns of equal number go by code; equal
rows are separate turns. Rows without conv_id belong to no conversation and are left out. Without any conversation
there is no node, not even the root. Other columns and their names play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.scratch import stored

SHARD_TURNS, GROUP, BLOCK, CHUNK = 100_000, 256, 100, 20_000
#: Columns of trie nodes on their way; ``saved`` leaves out a partial node's own share, which needs all its members.
FIELDS = {
    "shard": "bigint", "place": "bigint", "depth": "bigint", "key": "binary", "parent_key": "binary", "parent_conv_id": "bigint", "chars": "bigint",
    "conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "saved": "bigint", "done": "boolean", "ends": "string"}
NODE = ", ".join(f"{k} {v}" for k, v in FIELDS.items())
ARROW = pa.schema([(k, {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}[v]) for k, v in FIELDS.items()])
ROOT, NOTHING = b"", hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, code, size) of each row that has a conv_id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return conversations.where("conv_id is not null").select("conv_id", "turn", code.alias("code"), F.length(text).alias("size"))


def _in_order() -> Column:
    return F.sort_array(F.collect_list(F.struct("turn", "code", "size")))


def _listed(found: DataFrame, t: Column) -> DataFrame:
    """``t`` as two lists of a trie's input, (conv_id, codes, sizes)."""
    return found.select("conv_id", t.alias("t")).select("conv_id", F.col("t.code").alias("codes"), F.col("t.size").alias("sizes"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, codes, sizes) of each conversation as it is."""
    return _listed(turns(conversations).groupBy("conv_id").agg(_in_order().alias("t")), F.col("t"))


def rebuilt(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sequences that share beginnings: the first h turns of conversation c - c % block, then c's own after its first h.

    h is crc32 of the id, modulo 6. One exchange by c - c % block serves the grouping and the look at the block's first
    conversation; the window over a block holds fewer than ``2 * block`` conversations.
    """
    found = turns(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % block).repartition("base")
    own = found.groupBy("base", "conv_id").agg(_in_order().alias("t"))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("t", 1, 5))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    after = F.slice("t", h + 1, F.size("t"))
    return _listed(own.withColumn("head", head), F.when(F.col("head").isNull(), after).otherwise(F.concat(F.slice("head", F.lit(1), h), after)))


class Tree:
    """A ternary search tree over sequences of small ids; node 0 is the root of the trie and has no sibling."""

    def __init__(self):
        self.ids, self.less, self.more, self.inner, self.up, self.size, self.depth = [-1], [-1], [-1], [-1], [-1], [0], [0]

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """Adds a sequence; returns the node where it ends."""
        at = 0
        for symbol, size in zip(ids, sizes):
            parent, at = at, self.inner[at]
            if at < 0:
                at = self.inner[parent] = self._node(symbol, size, parent)
            while self.ids[at] != symbol:
                side = self.less if symbol < self.ids[at] else self.more
                if side[at] < 0:
                    side[at] = self._node(symbol, size, parent)
                at = side[at]
        return at

    def _node(self, symbol: int, size: int, parent: int) -> int:
        self.ids.append(symbol)
        for links in (self.less, self.more, self.inner):
            links.append(-1)
        self.up.append(parent)
        self.size.append(size)
        self.depth.append(self.depth[parent] + 1)
        return len(self.ids) - 1


def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle one first, then the middles of what lies on both sides."""
    spans = [(0, n)]
    while spans:
        a, b = spans.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            spans += [(middle + 1, b), (a, middle)]


def shard_nodes(shard: int, convs: list[tuple[int, tuple[bytes, ...], list[int]]]) -> list[tuple]:
    """The trie nodes of one shard's conversations (sorted by codes, then id) as rows of ``FIELDS``."""
    different: list[tuple[tuple[bytes, ...], list[int], list[int]]] = []
    for conv, codes, sizes in convs:
        if not different or different[-1][0] != codes:
            different.append((codes, sizes, []))
        different[-1][2].append(conv)
    names = sorted({c for codes, _, _ in different for c in codes})
    dictionary = {code: k for k, code in enumerate(names)}
    tree, ends, last = Tree(), {}, len(different) - 1
    paths = [0, 0]
    for k in medians(len(different)):
        codes, sizes, members = different[k]
        at = tree.insert([dictionary[c] for c in codes], sizes)
        ends[at] = members
        paths = [at if k == 0 else paths[0], at if k == last else paths[1]]
    shared: dict[int, bytes] = {}  # in the order of the trie: the first path, then what the last path adds
    for end in paths:
        path = [end]
        while tree.up[path[-1]] >= 0:
            path.append(tree.up[path[-1]])
        for at in path[::-1]:
            if at not in shared:
                shared[at] = hashlib.md5(shared[tree.up[at]] + names[tree.ids[at]]).digest() if at else ROOT
    place = {at: k for k, at in enumerate(shared)}
    n = len(tree.ids)
    count, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for at, members in ends.items():
        count[at], least[at] = len(members), members[0]
    for at in range(n - 1, -1, -1):  # nodes are made after their parents, so all inner nodes come before a node
        up = tree.up[at]
        if up >= 0:
            count[up] += count[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
        if at not in shared:
            leaves[at] = leaves[at] or 1
            saved[at] += (count[at] - 1) * tree.size[at]
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    rows = []
    for at in range(n):
        up, joined = tree.up[at], ",".join(map(str, ends[at])) if at in ends else None
        if at in shared:
            rows.append((shard, place[at], tree.depth[at], shared[at], shared.get(up), None, tree.size[at], least[at], count[at], children[at], leaves[at], saved[at], False, joined))
        else:
            digest = None if joined is None else hashlib.sha256(joined.encode()).hexdigest()
            parent = (shared[up], None) if up in shared else (None, least[up])
            rows.append((shard, None, tree.depth[at], None, *parent, tree.size[at], least[at], count[at], children[at], leaves[at], saved[at], True, digest))
    return rows


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), CHUNK):
        columns = zip(*rows[k : k + CHUNK])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs = [
        (conv, tuple(codes), sizes) for batch in batches
        for conv, codes, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "codes", "sizes")))]
    if convs:
        yield from _batches(shard_nodes(TaskContext.get().partitionId(), convs))


class Merge:
    """Partial nodes of neighbouring shards, in order, into final ones and those that may go on in other groups."""

    def __init__(self, unit: int, last: bool):
        self.unit, self.last, self.stack, self.rows, self.leading, self.made = unit, last, [], [], not last, 0

    def add(self, r: dict) -> None:
        if len(self.stack) > r["depth"] and self.stack[r["depth"]]["key"] == r["key"]:
            top = self.stack[r["depth"]]
            top["conv_id"] = min(top["conv_id"], r["conv_id"])
            for name in ("n_convs", "n_children", "n_leaves", "saved"):
                top[name] += r[name]
            return
        while len(self.stack) > r["depth"]:
            self._close()
        self.stack.append({**r, "leading": self.leading, "place": self.made})
        self.made += 1

    def _close(self) -> None:
        """The deepest open node is complete, unless groups before this one may hold it as well."""
        self.leading, r = False, self.stack.pop()
        if not r["leading"]:
            r |= {"done": True, "n_leaves": r["n_leaves"] or 1, "saved": r["saved"] + (r["n_convs"] - 1) * r["chars"]}
            if self.stack:
                up = self.stack[-1]
                up["n_children"] += 1
                up["n_leaves"] += r["n_leaves"]
                up["saved"] += r["saved"]
        self.rows.append(r)

    def end(self) -> list[dict]:
        while self.stack and self.last:
            self._close()
        rows, self.stack = self.rows + self.stack, []
        return rows


def _merged(last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def rows(found: list[dict]) -> Iterator[pa.RecordBatch]:
            return _batches([tuple(r[c] if c != "shard" else now.unit for c in FIELDS) for r in found])

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now.unit != r["unit"]:
                    if now is not None:
                        yield from rows(now.end())
                    now = Merge(r["unit"], last)
                now.add({c: r[c] for c in FIELDS})
            closed, now.rows = [r for r in now.rows if r["done"]], [r for r in now.rows if not r["done"]]
            yield from rows(closed)
        if now is not None:
            yield from rows(now.end())

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) from rows sorted by key and shard, hashed as they come."""
    now, sha, keys, out = None, None, [], []
    for batch in batches:
        for key, joined in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if key == now:
                sha.update(b",")
            else:
                if sha is not None:
                    keys.append(now)
                    out.append(sha.hexdigest())
                now, sha = key, hashlib.sha256()
            sha.update(joined.encode())
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([*keys, now], pa.binary()), "ends": pa.array([*out, sha.hexdigest()], pa.string())})


def merged(partial: DataFrame, shards: int, group: int = GROUP) -> DataFrame:
    """Final nodes from the partial ones of all shards: a round per power of ``group``."""
    finals = None
    while True:
        units = -(-shards // group)
        dealt = partial.drop("ends").withColumn("ends", F.lit(None).cast("string")).withColumn("unit", F.floor(F.col("shard") / group))
        result = stored(dealt.repartition("unit").sortWithinPartitions("unit", "shard", "place").mapInArrow(_merged(units == 1), NODE), "merged")
        done = result.where("done")
        finals = done if finals is None else finals.unionAll(done)
        if units == 1:
            return finals
        partial, shards = result.where("not done"), units


def nodes(found: DataFrame, shard_turns: int = SHARD_TURNS, group: int = GROUP) -> DataFrame:
    """All nodes of the trie over (conv_id, codes, sizes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends_sha256."""
    found = stored(found, "sequences")
    total = found.agg(F.coalesce(F.sum(F.size("codes") + 1), F.lit(0))).first()[0]
    shards = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    dealt = found.repartitionByRange(shards, "codes", "conv_id")
    all_nodes = stored(dealt.sortWithinPartitions("codes", "conv_id").mapInArrow(_shard, NODE), "nodes")
    partial = all_nodes.where("not done")
    final = stored(merged(partial, all_nodes.agg(F.coalesce(F.max("shard"), F.lit(0)) + 1).first()[0], group).drop("ends", "parent_conv_id"), "final")
    known = final.select("key", F.col("conv_id").alias("parent_conv_id"))
    ends = partial.where("ends is not null").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_digests, "key binary, ends string")
    top = final.join(ends, "key", "left").join(known.withColumnRenamed("key", "parent_key"), "parent_key", "left")
    # below partial nodes: each shard knows which of its nodes are partial, and their final ids come back to it
    parents = partial.select("shard", "key").join(known, "key").withColumnRenamed("key", "parent_key")
    below = all_nodes.where("done and parent_key is not null").drop("parent_conv_id").join(parents, ["shard", "parent_key"])
    within = all_nodes.where("done and parent_key is null")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")]
    return within.select(*columns).unionAll(below.select(*columns)).unionAll(top.select(*columns))


def report(conversations: DataFrame) -> DataFrame:
    """Per node of the trie over rebuilt conversations, with its savings in code points."""
    return nodes(rebuilt(conversations)).withColumnRenamed("saved", "saved_tokens")
