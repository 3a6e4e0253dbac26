"""Exact join of documents by Jaccard similarity of their word shingles, as a metric-space join.

1 - similarity is a metric on shingle sets, and any set may be a pivot. The join goes in levels:

* **Shingles as pivots.** Documents lie at distance 1 from nearly every other document, so documents
  can't divide the whole space (see README for figures). Sets of one shingle can: a document is nearer
  than 1 exactly to its own shingles, and these ties are broken by one fixed order, least frequent first.
  By the triangle inequality a partner within the threshold can miss at most a share of a
  document's nearest pivots: of its first ``n - ceil(threshold * n) + 1 + m`` pivots, a partner has
  at least ``m + 1`` among its own. A document is put into the regions of these pivots; documents that meet
  others in fewer than ``m + 1`` regions have no partner and leave, until no more do.
* **Documents as pivots.** Inside a region, documents are close, and document pivots divide it: a region
  is compared with one pivot first; regions whose members are by then in one component need
  nothing more. Small regions are then compared pair by pair. Large ones take more pivots: each
  document goes to the Voronoi cell of its nearest pivot and, if its distance to another pivot exceeds
  that by at most twice the radius, into that pivot's cell too; cells join recursively, and within a
  cell only documents whose distances to its pivot differ by at most the radius are compared.
* **Changes from a pivot.** Many near copies of one text, each with changes of its own, are about as far from
  each other as from any of them, and cells don't divide them. Their pivot p is what most of a few members have
  in common (any set may be a pivot), and a document's changes are the shingles that it has beyond p and those of p that it lacks.
  With ``cost = 100 * lacking + percent * beyond``, two documents link exactly if ``cost + cost <= (100 - percent) * |p| +
  (100 + percent) * common changes``. So what links without common changes links with the document of the least cost, which
  tells one edge for each; all else meets anew in the regions of changes, each document in as many (extras first) as a
  partner can't avoid. Where two meet in their first common change, what follows it in their lists bounds what they share. About half of a region's members have a change at most, so regions shrink at each such level.
  A region that all but a few members of one component are left in is settled by comparing these few with all.

Distances are only counted where they may matter. Each set has an odd sketch: whether an odd number of its shingles falls
into each of ``BITS`` cells. Two sketches differ at most in as many cells as the sets differ in shingles, so pairs whose
sketches differ too much don't link and their sets are never moved. Sets of over ``BITS`` shingles, which fill such a
sketch, have one of ``FINE`` cells too.

Exact copies of a set are one point of the space. The order of shingles comes from a sketch of
``SKETCH`` counters summed over all documents: any order that is the same for all documents gives exact
results (so counters may overflow); a good one keeps frequent passages out of the regions. With fewer counters, those of
rare shingles are mostly filled by others, and more documents meet by chance the larger the input. Shingles are 64-bit
hashes of words.

Defined results: a null text, or one without words, has an empty set and links with nothing; a
text of fewer words than a shingle is one shingle; equal sets link at any threshold; documents with a null
id take part, and the smallest id of a component ignores nulls. Repeated rows are rows like others.

Skew: all groups are counted and reduced before their shuffle; hot regions and hot sets meet the rest in
sort-merge joins that AQE splits; no task gathers a region.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm import components
from stratalake.llm import words as W
from stratalake.llm.scratch import removed, stored
from stratalake.llm.textkeys import flagged, text_key

SKETCH, BLOCK, SMALL, PIVOTS, MINOR, VOTERS, BITS, FINE = 1 << 20, 4096, 32, 8, 64, 16, 1024, 8192
#: Members of a region of a change, whose costs rule out most pairs, up to which it is compared pair by pair.
CLOSE = 256
#: Partitions whose counters are added up together before all are.
TOGETHER = 256
#: What is known of a member in its region: its distance to the pivot of its cell; or the cost of its changes, the room
#: that links have, and its changes from the region's on.
KNOWN = {"near": "double", "cost": "bigint", "room": "bigint", "rest": "bigint"}
#: Regions in which two documents that link meet at least (fewer for the smallest sets), and rounds of leaving.
MEETINGS, LEAVING = 8, 2


def row_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data, rows = W.text_bytes(column)
    starts, ends, words = W.spans(data, rows, W.NOT_SPACE)
    found, at = W.shingles(W.hashes(data, starts, ends, lower=True), words, size)
    for a, b in zip(at[:-1], at[1:]):
        yield np.unique(found[a:b])


def odd_sketch(found: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` cells hold an odd number of a set's shingles, as 64-bit words."""
    cells = np.bincount((W.mix(found) % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((cells & 1).astype(np.uint8), bitorder="little").view(np.int64)


def frequency_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Counts of all shingles of all documents in SKETCH cells, summed over tasks block by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for part in W.slices(batch):
                data, rows = W.text_bytes(part.column(0))
                starts, ends, words = W.spans(data, rows, W.NOT_SPACE)
                found, _ = W.shingles(W.hashes(data, starts, ends, lower=True), words, size)
                total += np.bincount((found & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
        blocks = [b.tobytes() for b in total.reshape(-1, BLOCK)]
        part = TaskContext.get().partitionId() // TOGETHER
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())], ["block", "part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.uint32) for b in table["counts"])
        return pa.table({"block": table["block"].slice(0, 1), "part": table["part"].slice(0, 1), "counts": pa.array([total.astype(np.uint32).tobytes()], pa.binary())})

    kind = "block int, part int, counts binary"
    counted = docs.select("text").mapInArrow(count, kind)
    blocks = counted.groupBy("block", "part").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind).collect()
    out = np.zeros((SKETCH // BLOCK, BLOCK), np.uint32)
    for r in blocks:
        out[r.block] = np.frombuffer(r.counts, np.uint32)
    return out.ravel()


def points(docs: DataFrame, size: int, percent: int, id_column: str) -> DataFrame:
    """Per document: id, text_key, sid (hash of its set), n (size of its set) and its nearest pivots."""
    # SKETCH counters, whatever the size of the input
    order = docs.sparkSession.sparkContext.broadcast(frequency_sketch(docs, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = order.value
        for batch in batches:
            for part in W.slices(batch):
                sids, sizes, nearest = [], [], []
                for s in row_sets(part.column(2), size):
                    n = len(s)
                    sizes.append(n)
                    sids.append((int(s.sum()) + 3 * int(np.bitwise_xor.reduce(s)) + n) % (1 << 64) if n else 0)
                    least = -(percent * n // -100)  # shingles that a partner has
                    first = np.argsort(sketch[(s & np.uint64(SKETCH - 1)).astype(np.int64)], kind="stable")[: n - least + min(MEETINGS, least)]
                    nearest.append(W.signed(s[first]))
                keys = W.signed(W.mix(np.array(sids, np.uint64)))
                ends = np.concatenate([[0], np.cumsum([len(x) for x in nearest])]).astype(np.int32)
                pivots = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(nearest) if nearest else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys), pa.array(sizes, pa.int64()), pivots], ["id", "text_key", "sid", "n", "pivots"])

    seen = docs.select(F.col(id_column).cast("bigint").alias("id"), text_key().alias("text_key"), "text")
    return seen.mapInArrow(place, "id bigint, text_key bigint, sid bigint, n bigint, pivots array<bigint>")


def regions(placed: DataFrame, percent: int) -> DataFrame:
    """Members (region, sid, n) of the regions where sets may meet partners.

    Of regions with the same members, one is kept.
    """
    sets = placed.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("pivots").alias("pivots"))
    sets = stored(sets, "pivots")
    members = sets.select("sid", F.explode("pivots").alias("region"))
    need = F.least(F.lit(MEETINGS), F.ceil(F.lit(percent) * F.col("n") / 100))
    for k in range(LEAVING):
        shared = members.groupBy("region").agg(F.count("*").alias("c")).where("c > 1").select("region")
        before, members = members, stored(members.join(shared, "region").select("sid", "region"), "meetings")
        removed(before)
        staying = members.groupBy("sid").agg(F.count("*").alias("k")).join(sets.select("sid", "n"), "sid").where(F.col("k") >= need).select("sid", "n")
        if k == LEAVING - 1:
            last = stored(members.join(staying, "sid"), "members")
            out = stored(_different(last), "regions")
            removed(sets, members, last)
            return out
        members = stored(members.join(staying.select("sid"), "sid"), "meetings")
    raise AssertionError("LEAVING is 1 at least")


def _different(members: DataFrame) -> DataFrame:
    """The regions with two members or more, one of each group of regions with equal members."""
    counted = members.groupBy("region").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("sid")).alias("who"), F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("c > 1")
    kept = counted.groupBy("c", "who", "lo", "hi").agg(F.min("region").alias("region"))
    return members.join(kept.select("region"), "region").select("region", "sid", "n")


def surviving_sets(docs: DataFrame, placed: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(sid, set, n, odd, fine) of all sets in regions, from one text of each: shingles, their number and their odd sketches."""
    alive = members.select("sid").distinct()
    keys = stored(placed.join(alive, "sid").groupBy("sid").agg(F.min("text_key").alias("text_key")), "keys")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            for part in W.slices(batch.take(pa.array(first))):
                sets = list(row_sets(part.column(1), size))
                odd = [odd_sketch(s, BITS) for s in sets]
                fine = [odd_sketch(s, FINE) if len(s) > BITS else s[:0].view(np.int64) for s in sets]
                lists = [pa.array(x, pa.list_(pa.int64())) for x in ([W.signed(s) for s in sets], odd, fine)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["text_key", "set", "odd", "fine"])

    seen = flagged(docs.select(text_key().alias("text_key"), "text"), keys).where("flag").select("text_key", "text")
    found = seen.mapInArrow(collect, "text_key bigint, set array<bigint>, odd array<bigint>, fine array<bigint>")
    one = found.groupBy("text_key").agg(*(F.first(c).alias(c) for c in ("set", "odd", "fine")))
    return one.join(keys, "text_key").select("sid", "set", F.size("set").cast("bigint").alias("n"), "odd", "fine")


def _those(sets: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """The sets that stand in pairs, with one column of theirs."""
    ids = pairs.selectExpr("a as sid").unionAll(pairs.selectExpr("b as sid")).distinct()
    return sets.select("sid", column).join(ids, "sid", "left_semi")


def _distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their distance and whether they link, without those that aren't ``asked`` for and can't link."""
    # 100 * i >= percent * (na + nb - i) says that the sets differ in at most (na + nb) * (100 - percent) / (100 + percent) shingles
    most = (F.col("na") + F.col("nb")) * (100 - percent)
    left, right = sets.selectExpr("sid as a", "n as na", "odd as oa", "fine as fa"), sets.selectExpr("sid as b", "n as nb", "odd as ob", "fine as fb")
    cells = sum(F.bit_count(F.col("oa")[k].bitwiseXOR(F.col("ob")[k])) for k in range(BITS // 64))
    # short sets have no fine sketch: those pairs' sum is 0 or null
    fine = F.aggregate(F.zip_with("fa", "fb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    may = F.col("asked") | ((cells * (100 + percent) <= most) & F.coalesce(fine * (100 + percent) <= most, F.lit(True)))
    near = stored(pairs.join(left, "a").join(right, "b").where(may).select("a", "b"), "near")
    needed = stored(_those(sets, near, "set"), "needed")
    both = near.join(needed.selectExpr("sid as a", "set as sa"), "a").join(needed.selectExpr("sid as b", "set as sb"), "b")
    common = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    whole = F.col("t") - F.col("i")
    out = stored(common.select("a", "b", (1 - F.col("i") / whole).alias("d"), (100 * F.col("i") >= percent * whole).alias("linked")), "distances")
    removed(near, needed)
    return out


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with their ``root``, of regions with several roots; ``c`` members, of which ``minor`` are outside
    the root that most have (``minority``)."""
    rooted = members.join(found.selectExpr("node as sid", "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = stored(rooted.select("region", "sid", "n", *KNOWN, "root"), "members")
    by_root = rooted.groupBy("region", "root").agg(F.count("*").alias("k"))
    mixed = by_root.groupBy("region").agg(
        F.sum("k").alias("c"), F.count("*").alias("roots"), F.max(F.struct("k", "root")).alias("most")).where("roots > 1")
    mixed = mixed.select("region", "c", (F.col("c") - F.col("most.k")).alias("minor"), F.col("most.root").alias("major"))
    out = stored(rooted.join(mixed, "region").select(*rooted.columns, "c", "minor", (F.col("root") != F.col("major")).alias("minority")), "mixed")
    removed(rooted)
    return out


def _first(live: DataFrame, few: int, seed: int) -> DataFrame:
    """``few`` members of each region, by a hash; Spark keeps as many per partition before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("sid", F.lit(seed)), "sid"))
    return live.withColumn("rank", rank).where(F.col("rank") <= few).drop("rank")


def _unknown(*names: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(k) for k, kind in KNOWN.items() if not names or k in names]


def _joined(found: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """Components after more edges: those between different ones alone are joined."""
    if found is None:
        return None if edges.isEmpty() else components.roots(edges)
    ends = edges.join(found.selectExpr("node as a", "root as ra"), "a", "left").join(found.selectExpr("node as b", "root as rb"), "b", "left")
    ends = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a != b")
    fresh = stored(ends.distinct(), "edges")
    if fresh.isEmpty():
        return found
    more = components.roots(fresh)
    moved = found.join(more.selectExpr("node as root", "root as above"), "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return stored(moved.unionAll(more), "found")


def links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the components that the links between members of common regions make."""
    spark, radius = members.sparkSession, 1 - percent / 100
    now = members.select("*", *_unknown())
    none = spark.createDataFrame([], "node bigint, root bigint")
    found = None
    level = 0
    while True:
        live = _mixed(now, none if found is None else found)
        if level:
            removed(now)
        if live.isEmpty():
            return none if found is None else found
        small = F.col("c") <= F.when(F.col("cost").isNull(), SMALL).otherwise(CLOSE)
        settled = small | (F.col("minor") <= MINOR)
        wide = live.where(~settled)
        cells = level > 0 and level % 3 == 0
        if level == 0:
            chosen = _first(live, 1, level)
        else:
            chosen = live.where(settled & (small | F.col("minority")))
            chosen = chosen.unionByName(_first(wide, PIVOTS, level)) if cells else chosen
        pivots = stored(chosen.selectExpr("region", "sid as pivot", "n as pn", "root as proot", "near as pnear", "cost as pcost", "rest as prest"), "pivots")
        met = live.join(pivots, "region").where("sid != pivot")
        possible = (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn")) & (F.col("root") != F.col("proot"))
        possible &= F.coalesce(F.abs(F.col("near") - F.col("pnear")) <= radius + 1e-9, F.lit(True))
        possible &= F.coalesce(F.col("cost") + F.col("pcost") - F.col("room") <= (100 + percent) * F.least("rest", "prest"), F.lit(True))
        asked = ~settled if cells else F.lit(False)  # these are divided by their distances
        pairs = met.where(possible | asked).select(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b"), asked.alias("asked"))
        measured = _distances(pairs.groupBy("a", "b").agg(F.max("asked").alias("asked")), sets, percent)
        edges = measured.where("linked").select("a", "b")
        done = level > 0 and wide.isEmpty()
        changed = _changes(wide, sets, percent, level) if level and not cells and not done else None
        if changed is not None:
            edges = edges.unionAll(_sure_links(changed))
        found = _joined(found, edges)
        if done:
            removed(live, pivots, measured)
            return none if found is None else found
        if level == 0:
            rest = live.join(pivots.selectExpr("region", "pivot as sid"), ["region", "sid"], "left_anti")
            now = stored(rest.select("region", "sid", "n", *KNOWN), "next")
        elif cells:
            rest = wide.join(pivots.selectExpr("region", "pivot as sid"), ["region", "sid"], "left_anti")
            apart = rest.join(pivots, "region").select("region", "c", "sid", "n", "near", "pivot", F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b"))
            apart = stored(apart.join(measured.select("a", "b", "d"), ["a", "b"]).drop("a", "b"), "apart")
            now = stored(_cells(rest, apart, radius), "next")
            removed(apart)
        else:
            now = stored(_by_change(changed, percent), "next")
            removed(changed)
        removed(live, pivots, measured)
        level += 1


def _cells(rest: DataFrame, apart: DataFrame, radius: float) -> DataFrame:
    """Members of the pivots' Voronoi cells, or of the region itself where cells don't help."""
    nearest = apart.groupBy("region", "sid").agg(F.min("d").alias("least"))
    cells = apart.join(nearest, ["region", "sid"]).where(F.col("d") - F.col("least") <= 2 * radius + 1e-9)
    helped = stored(cells.groupBy("region").agg(F.count("*").alias("rows"), F.first("c").alias("c")).where("2 * rows <= 3 * c").select("region"), "helped")
    divided = cells.join(helped, "region", "left_semi").select(F.xxhash64("region", "pivot").alias("region"), "sid", "n", F.col("d").alias("near"))
    whole = rest.join(helped, "region", "left_anti").select("region", "sid", "n", "near")
    return divided.unionAll(whole).select("*", *_unknown("cost", "room", "rest"))


def _changes(wide: DataFrame, sets: DataFrame, percent: int, level: int) -> DataFrame:
    """Members with their changes from their region's pivot, the majority of VOTERS members: (pivot, sid, n, changes, cost),
    the room that links have in costs, and the member of the least cost (``lo``). Regions with equal pivots are one."""
    votes = _first(wide.select("region", "sid"), VOTERS, level).join(sets, "sid").select("region", F.explode("set").alias("shingle"))
    agreed = votes.groupBy("region", "shingle").agg(F.count("*").alias("k")).where(2 * F.col("k") > VOTERS)
    bases = agreed.groupBy("region").agg(F.array_sort(F.collect_list("shingle")).alias("base")).withColumn("pivot", F.xxhash64("base"))
    bases = stored(bases, "bases")
    placed = wide.select("region", "sid", "n").join(bases.select("region", "pivot"), "region", "left").withColumn("pivot", F.coalesce("pivot", F.lit(0)))
    both = placed.select("pivot", "sid", "n").distinct().join(sets.selectExpr("sid", "set"), "sid")
    both = both.join(bases.select("pivot", "base").dropDuplicates(["pivot"]), "pivot", "left")
    both = both.withColumn("base", F.coalesce("base", F.array().cast("array<bigint>")))
    both = both.select("pivot", "sid", "n", F.size("base").alias("p"), F.array_except("set", "base").alias("beyond"), F.array_except("base", "set").alias("lacking"))
    cost = 100 * F.size("lacking") + percent * F.size("beyond")
    # extras come first, in the order of the sets: one order for all
    both = stored(both.select("pivot", "sid", "n", F.concat("beyond", "lacking").alias("changes"), cost.alias("cost"), ((100 - percent) * F.col("p")).alias("room")), "changes")
    least = both.groupBy("pivot").agg(F.min(F.struct("cost", "sid")).alias("lo"))
    out = stored(both.join(least, "pivot"), "changed")
    removed(bases, both)
    return out


def _sure_links(changed: DataFrame) -> DataFrame:
    """Links with the member of the least cost that need no common change."""
    sure = changed.where((F.col("sid") != F.col("lo.sid")) & (F.col("cost") + F.col("lo.cost") <= F.col("room")))
    return sure.select(F.least("sid", "lo.sid").alias("a"), F.greatest("sid", "lo.sid").alias("b"))


def _by_change(changed: DataFrame, percent: int) -> DataFrame:
    """Members of the regions of changes: with ``need`` changes in common, one is among all but the last ``need - 1`` of both."""
    need = F.greatest(F.lit(1), F.ceil((F.col("cost") + F.col("lo.cost") - F.col("room")) / (100 + percent))).cast("int")
    apart = changed.withColumn("first", F.size("changes") - need + 1).where("first > 0")
    apart = apart.select("*", F.posexplode(F.slice("changes", 1, F.col("first"))).alias("at", "change"))
    apart = apart.select(F.xxhash64("pivot", "change").alias("region"), "sid", "n", "pivot", "at", F.col("cost").cast("bigint").alias("cost"), F.col("room").cast("bigint").alias("room"), (F.size("changes") - F.col("at")).cast("bigint").alias("rest"))
    apart = stored(apart, "apart")
    # of regions with the same members and pivot, the first in the order of changes is kept: there they meet first
    counted = apart.groupBy("region").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("sid")).alias("who"), F.min(F.struct("sid", "at")).alias("lo"), F.max("sid").alias("hi"), F.min("pivot").alias("pivot")).where("c > 1")
    kept = counted.groupBy("pivot", "c", "who", "lo.sid", "hi").agg(F.min(F.struct("lo.at", "region")).alias("first")).select("first.region")
    return apart.join(kept, "region").select("region", "sid", "n", *_unknown("near"), "cost", "room", "rest")


def components_of(docs: DataFrame, size: int = 4, percent: int = 85, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, text_key, n (distinct shingles), root (names its component; null without words) and
    component (the smallest id reachable by links)."""
    docs = docs.select(id_column, "text")
    placed = stored(points(docs, size, percent, id_column), "points")
    members = regions(placed, percent)
    sets = stored(surviving_sets(docs, placed, members, size), "sets")
    found = links(members, sets, percent)
    removed(members, sets)
    least = placed.where("n > 0").groupBy("sid").agg(F.min("id").alias("id"))
    rooted = stored(least.join(found.selectExpr("node as sid", "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid")), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("id").alias("component")), "root").select("sid", "root", "component")
    named = stored(named, "named")
    return placed.select("id", "text_key", "sid", "n").join(named, "sid", "left").select(
        "id", "text_key", "n", "root", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return components_of(docs).selectExpr("id as doc_id", "n as n_shingles", "component as component_id")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with its own columns: the smallest id, then the least hash of the text.

    Documents without words stay. Rows with the same id and the same text are one document.
    """
    key = (F.col("doc_id").cast("bigint"), text_key())
    found = stored(components_of(docs, size, percent).where("n > 0"), "classes")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("best")).select("root", "best.id", "best.text_key")
    rest = found.join(best.selectExpr("root", "id as best_id", "text_key as best_key"), "root").where("not (id <=> best_id and text_key = best_key)")
    gone = stored(rest.selectExpr("id as _id", "text_key as _key").distinct(), "copies")
    twice = stored(found.groupBy("id", "text_key").agg(F.count("*").alias("k")).where("k > 1").selectExpr("id as _id", "text_key as _key"), "twice")

    def same(other: DataFrame):
        return key[0].eqNullSafe(other["_id"]) & (key[1] == other["_key"])

    kept = docs.join(gone, same(gone), "left_anti")
    if twice.isEmpty():
        return kept
    single, again = kept.join(twice, same(twice), "left_anti"), kept.join(twice, same(twice), "left_semi")
    return single.unionByName(again.withColumns({"_id": key[0], "_key": key[1]}).dropDuplicates(["_id", "_key"]).drop("_id", "_key"))
