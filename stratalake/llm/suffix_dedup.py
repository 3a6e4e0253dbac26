"""Removal of long repeated substrings by two-stage suffix sorting.

A byte goes if some ``length``-byte string that covers it also starts anywhere else, in the same
document or another. Suffixes of all documents are sorted in partitions:

* Each ``length``-byte window has one anchor, the ``GRAM``-byte string in it of the least hash, so
  equal windows have equal anchors. Successive windows with one anchor are one stretch of text.
* Only stretches whose anchor occurs twice or more are kept (all others hold no repeated window);
  equal stretches are one, with the number of places where they stand.
* Stretches with equal anchors come to one partition, which sorts their suffixes in two stages, compares
  neighbours' common prefixes (``suffixes.repeated``), and returns the runs of repeated windows.
* An anchor with more than ``HOT`` different stretches (one passage in many contexts) would not stay
  in one partition of bounded size: the windows of its stretches are compared by fingerprint, first
  within each task, which settles most, then what is left of each task, dealt out by fingerprint.

With ``words``, lengths, places and windows are counted in words (runs of bytes other than ASCII white
space; which white space parts them plays no part), so what goes are passages of ``length`` words or more:
suffixes are sorted for the bytes of the shortest such passage, and of the windows of words in what
repeats so far those that are equal as a whole are told exactly.

What is decided follows from a text and the number of its copies alone, so places are known by text_key.

Defined results: a null text has no bytes; texts shorter than ``length`` lose nothing; a text that stands
twice goes wholly; repeated rows are copies; other columns and their names play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import suffixes
from stratalake.llm import words as W
from stratalake.llm.batches import appended
from stratalake.llm.scratch import stored
from stratalake.llm.textkeys import flagged, text_key

LENGTH, GRAM, HOT, PART_BYTES, HOT_BYTES = 400, 100, 1_000, 1 << 19, 2 << 20
STRETCH = "text_key bigint, anchor bigint, content bigint, size int, places array<int>, count bigint"


def window_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, where its least one stands (the first of equal ones)."""
    n = len(grams) - width + 1
    keys = (grams >> np.uint64(28) << np.uint64(28)) | np.arange(len(grams), dtype=np.uint64)
    pad = -len(keys) % width
    rows = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & np.uint64((1 << 28) - 1)).astype(np.int64)


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes, anchor hashes and content hashes of one text's stretches, from its bytes or word hashes.

    A text of 2**28 bytes or more is worked on in overlapping pieces.
    """
    most = 1 << 24
    if len(data) > most + length:
        parts = [(k, stretches(data[k : k + most + length - 1], length, gram)) for k in range(0, len(data) - length + 1, most)]
        return tuple(np.concatenate([p[i] + (k if i == 0 else 0) for k, p in parts]) for i in range(4))
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    up, down = W.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((W._VALUES[data] if data.dtype == np.uint8 else data) * up[: len(data)], out=sums[1:])
    n = len(data) - gram + 1
    grams = W.mix((sums[gram : gram + n] - sums[:n]) * down[:n])
    anchors = window_anchors(grams, length - gram + 1)
    new = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    ends = np.append(new[1:], len(anchors)) - 1 + length
    return new, ends - new, grams[anchors[new]], W.mix((sums[ends] - sums[new]) * down[new] + (ends - new).astype(np.uint64))


def least_bytes(length: int, words: bool) -> int:
    """The bytes of the shortest window."""
    return 2 * length - 1 if words else length


def text_stretches(docs: DataFrame, length: int, gram: int, words: bool = False) -> DataFrame:
    """One row for each different stretch of each text, with its places in the text and its copies.

    With ``words`` also the byte where the first place starts, and the bytes there.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                data, rows = W.text_bytes(part.column(1))
                if words:
                    heads = rows
                    starts, ends, rows = W.spans(data, rows, W.NOT_SPACE)
                    data = W.hashes(data, starts, ends, lower=False)
                keys = part.column(0).to_numpy()
                _, first, copies = np.unique(keys, return_index=True, return_counts=True)
                out: list[list] = [[] for _ in range(8)]
                for k, times in zip(first.tolist(), copies.tolist()):
                    at, size, anchor, content = stretches(data[rows[k] : rows[k + 1]], length, gram)
                    _, one, which = np.unique(content, return_index=True, return_inverse=True)
                    order = np.argsort(which, kind="stable")
                    counts = np.bincount(which, minlength=len(one))
                    out[0].append(np.full(len(one), keys[k]))
                    out[1].append(W.signed(anchor[one]))
                    out[2].append(W.signed(content[one]))
                    out[3].append(size[one])
                    out[4].append((at[order], counts))
                    out[5].append(counts * times)
                    if words:
                        begin = at[one] + rows[k]
                        out[6].append(starts[begin] - heads[k])
                        out[7].append(ends[begin + size[one] - 1] - starts[begin])
                if not out[0]:
                    continue
                lists = np.concatenate([[0], np.cumsum(np.concatenate([c for _, c in out[4]]))])
                places = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(np.concatenate([a for a, _ in out[4]]), pa.int32()))
                flat = [np.concatenate(c) for c in (*out[:4], out[5])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[0]), pa.array(flat[1]), pa.array(flat[2]), pa.array(flat[3], pa.int32()), places, pa.array(flat[4], pa.int64()),
                     *(pa.array(np.concatenate(c), pa.int32()) for c in out[6:] if words)],
                    ["text_key", "anchor", "content", "size", "places", "count", *(["place", "bytes"] if words else [])])

    asked = docs.where(F.octet_length("text") >= least_bytes(length, words)).select(text_key().alias("text_key"), "text")
    return asked.mapInArrow(cut, STRETCH + (", place int, bytes int" if words else ""))


def _with_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (text_key, place, size, ...) with ``bytes``, cut from one text of each key."""
    asked = stored(wanted.groupBy("text_key").agg(F.collect_list(F.struct(*[c for c in wanted.columns if c != "text_key"])).alias("cuts")), "cuts")
    texts = flagged(docs.select(text_key().alias("text_key"), "text"), asked).where("flag").select("text_key", "text")
    texts = texts.groupBy("text_key").agg(F.max("text").alias("text"))
    met = texts.join(asked, "text_key").select(F.encode("text", "UTF-8").alias("text"), F.explode("cuts").alias("cut"))
    return met.select("cut.*", F.expr("substring(text, cut.place + 1, cut.size)").alias("bytes"))


def word_windows(bodies: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Fingerprint, owner and first word of each window of ``length`` words, and the bytes [from, to) of its owner."""
    data, rows = W.text_bytes(pa.array(bodies, pa.binary()))
    starts, ends, before = W.spans(data, rows, W.NOT_SPACE)
    hashes = W.hashes(data, starts, ends, lower=False)
    up, down = W.powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    n = np.maximum(np.diff(before) - length + 1, 0)
    owner = np.repeat(np.arange(len(bodies)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = before[owner] + start
    return W.mix((sums[at + length] - sums[at]) * down[at]), owner, start, starts[at] - rows[owner], ends[at + length - 1] - rows[owner]


def repeated_words(bodies: list[bytes], weights: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Per string: runs [a, b) of words that start windows of ``length`` words that start elsewhere too."""
    plain = [b" ".join(b.split()) for b in bodies]  # splits at ASCII white space
    least = least_bytes(length, True)
    sure: list[list[tuple[int, int]]] = suffixes.repeated(plain, weights, least)
    prints, owner, start, begin, end = word_windows(plain, length)
    # a window that repeats lies in one run of repeated bytes
    base = np.concatenate([[0], np.cumsum([len(b) + 1 for b in plain])])
    heads = np.array([base[k] + a for k, runs in enumerate(sure) for a, _ in runs], np.int64)
    tails = np.array([base[k] + b for k, runs in enumerate(sure) for _, b in runs], np.int64)
    if not len(heads):
        return [[] for _ in bodies]
    run = np.searchsorted(heads, base[owner] + begin, "right") - 1
    inside = (run >= 0) & (base[owner] + end - least < tails[run])
    asked = np.flatnonzero(inside)
    asked = asked[np.argsort(prints[asked], kind="stable")]
    bounds = np.concatenate([[0], np.flatnonzero(prints[asked][1:] != prints[asked][:-1]) + 1, [len(asked)]])
    hit = np.zeros(len(prints), bool)
    for x, y in zip(bounds[:-1], bounds[1:]):  # the bytes of one fingerprint's windows at a time
        same = [(i, owner[i], plain[owner[i]][begin[i] : end[i]]) for i in asked[x:y]]
        times: Counter[bytes] = Counter()
        for _, k, window in same:
            times[window] += weights[k]
        for i, _, window in same:
            hit[i] = times[window] > 1
    out: list[list[tuple[int, int]]] = [[] for _ in bodies]
    for i in np.flatnonzero(hit):
        k, a = int(owner[i]), int(start[i])
        if out[k] and out[k][-1][1] == a:
            out[k][-1] = (out[k][-1][0], a + 1)
        else:
            out[k].append((a, a + 1))
    return out


def _sorted(length: int, words: bool):
    def sort(table: pa.Table) -> pa.Table:
        runs = (repeated_words if words else suffixes.repeated)(table["bytes"].to_pylist(), table["count"].to_pylist(), length)
        found = [(c, [{"a": a, "b": b} for a, b in r]) for c, r in zip(table["content"].to_pylist(), runs) if r]
        return pa.table({
            "content": pa.array([c for c, _ in found], pa.int64()),
            "runs": pa.array([r for _, r in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))})

    return sort


HOT_ROWS = "content bigint, runs array<struct<a:int,b:int>>, bucket int, prints array<bigint>, owners array<bigint>, starts array<int>"


def _runs(owner: np.ndarray, start: np.ndarray) -> tuple[list[int], list[list[dict]]]:
    """Owners, and the runs of successive starts of each; the input is in order of owner and start."""
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)]))
    ends = np.append(new[1:], len(owner)) - 1
    out: dict[int, list[dict]] = {}
    for a, b in zip(new.tolist(), ends.tolist()) if len(owner) else ():
        out.setdefault(int(owner[a]), []).append({"a": int(start[a]), "b": int(start[b]) + 1})
    return list(out), list(out.values())


def _byte_windows(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    text = suffixes.Strings(bodies, length)
    at = np.flatnonzero(text.left >= length)
    owner = text.owner[at]
    return text.prints(at), owner, at - text.starts[owner]


def _hot_windows(length: int, buckets: int, words: bool):
    """Of hot stretches: runs of windows that repeat within the batch, and of all other windows, and once of
    those that repeat, the fingerprints, dealt out to buckets."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "bytes"):
                bodies, count = part.column(2).to_pylist(), part.column(1).to_numpy()
                prints, owner, start, *_ = (word_windows if words else _byte_windows)(bodies, length)
                prints, which = np.unique(prints, return_inverse=True)
                times = np.bincount(which, count[owner])
                content = part.column(0).to_numpy()[owner]
                many = times[which] > 1
                found, runs = _runs(content[many], start[many])
                first = np.full(len(prints), -1)
                first[which[::-1]] = np.arange(len(owner))[::-1]
                bucket = (prints % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)) if len(order) else []
                groups = np.split(order, cuts[1:]) if len(order) else []
                n, m = len(found), len(groups)
                yield pa.RecordBatch.from_arrays([
                    pa.array([*found, *[None] * m], pa.int64()),
                    pa.array([*runs, *[None] * m], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                    pa.array([*[None] * n, *(int(bucket[g[0]]) for g in groups)], pa.int32()),
                    pa.array([*[None] * n, *(W.signed(prints[g]) for g in groups)], pa.list_(pa.int64())),
                    pa.array([*[None] * n, *(content[first[g]] for g in groups)], pa.list_(pa.int64())),
                    # a window that repeats here is known to repeat: it only tells the others
                    pa.array([*[None] * n, *(np.where(times[g] > 1, -1, start[first[g]]) for g in groups)], pa.list_(pa.int32()))],
                    ["content", "runs", "bucket", "prints", "owners", "starts"])

    return deal


def _hot_bucket(table: pa.Table) -> pa.Table:
    prints, owners, starts = (np.concatenate([np.zeros(0, np.int64), *(x.values.to_numpy() for x in table[c])]) for c in ("prints", "owners", "starts"))
    _, which, times = np.unique(prints, return_inverse=True, return_counts=True)
    told = np.bincount(which, starts < 0)
    hit = ((times > 1) | (told > 0))[which] & (starts >= 0)
    order = np.lexsort((starts[hit], owners[hit]))
    found, runs = _runs(owners[hit][order], starts[hit][order])
    return pa.table({"content": pa.array(found, pa.int64()), "runs": pa.array(runs, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))})


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: bool = False) -> DataFrame:
    """(text_key, cuts): the ranges [a, b) of bytes, or words, to remove from each text, for texts that have any."""
    docs = docs.select("text")
    cut = stored(text_stretches(docs, length, gram, words), "stretches")
    more = ["place", "bytes"] if words else []
    at = F.struct("text_key", *(more or [F.col("places")[0].alias("place"), F.col("size").alias("bytes")]))
    anchors = cut.groupBy("anchor").agg(F.sum("count").alias("n")).where("n > 1").select("anchor")
    places = stored(
        cut.join(anchors, "anchor").groupBy("text_key", "anchor", "content", "size").agg(F.sum("count").alias("count"), F.first("places").alias("places"), *[F.first(m).alias(m) for m in more]), "places")
    contents = places.groupBy("anchor", "content", "size").agg(
        F.sum("count").alias("count"), F.min(at).alias("at"))
    contents = stored(contents.select("anchor", "content", F.col("at.bytes").alias("size"), "count", "at.text_key", "at.place"), "contents")
    hot = stored(contents.groupBy("anchor").agg(F.count("*").alias("k")).where(F.col("k") > HOT).select("anchor"), "hot")
    total = contents.agg(F.sum("size")).first()[0] or 0
    parts = max(1, math.ceil(total / PART_BYTES))
    marked = contents.join(hot.withColumn("hot", F.lit(True)), "anchor", "left").select(
        "text_key", "place", "size", "content", "count", F.coalesce("hot", F.lit(False)).alias("hot"), F.pmod(F.xxhash64("anchor"), F.lit(parts)).alias("part"))
    bodies = stored(_with_bytes(docs, marked), "bodies")
    kind = "content bigint, runs array<struct<a:int,b:int>>"
    found = bodies.where("not hot").select("part", "content", "count", "bytes").groupBy("part").applyInArrow(_sorted(length, words), kind)
    if not hot.isEmpty():
        size = contents.join(hot, "anchor", "left_semi").agg(F.sum("size")).first()[0]
        dealt = bodies.where("hot").select("content", "count", "bytes").mapInArrow(_hot_windows(length, max(1, math.ceil(size / HOT_BYTES)), words), HOT_ROWS)
        dealt = stored(dealt, "windows")
        found = found.unionAll(dealt.where("bucket is null").select("content", "runs")).unionAll(
            dealt.where("bucket is not null").groupBy("bucket").applyInArrow(_hot_bucket, kind))
    found = stored(found, "runs")
    met = places.select("text_key", "content", "places").join(found, "content")
    one = met.select("text_key", F.explode("places").alias("p"), "runs").select(
        "text_key", F.transform("runs", lambda r: F.struct((r["a"] + F.col("p")).alias("a"), (r["b"] + F.col("p") + (length - 1)).alias("b"))).alias("cuts"))
    return one.groupBy("text_key").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))


def merged(cuts: list[dict] | None) -> list[tuple[int, int]]:
    """Ranges as maximal ones, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((c["a"], c["b"]) for c in cuts or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    kept, last = [], 0
    for a, b in cuts:
        kept.append(text[last:a])
        last = b
    return b"".join([*kept, text[last:]])


def whole_characters(text: bytes, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges shrunk to whole characters, so that what is left is text."""
    out = []
    for a, b in cuts:
        while a < b and a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _with_cuts(docs: DataFrame, length: int, gram: int, words: bool = False) -> DataFrame:
    """(row, cuts): only documents that may lose something move to meet their cuts."""
    runs = stored(repeated_runs(docs, length, gram, words), "cuts")
    marked = flagged(docs.select(F.struct("*").alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")), runs)
    none = F.lit(None).cast(runs.schema["cuts"].dataType).alias("cuts")
    return marked.where("not flag").select("row", none).unionAll(
        marked.where("flag").join(runs, "text_key", "left").select("row", "cuts"))


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and what follows from them: n_kept (bytes) and changed."""

    def work():
        def digest(batch: pa.RecordBatch) -> list:
            data, rows = W.text_bytes(batch.column(0))
            body, out = data.tobytes(), [[], [], [], []]
            for a, b, cuts in zip(rows[:-1], rows[1:], batch.column(1).to_pylist()):
                spans = merged(cuts)
                out[0].append(int(b - a))
                out[1].append(sum(y - x for x, y in spans))
                out[2].append(len(spans))
                out[3].append(hashlib.sha256(without(body[a:b], spans)).hexdigest())
            return out

        return digest

    found = _with_cuts(docs.select("doc_id", "text"), length, gram)
    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    done = appended(found, {"text": F.col("row.text"), "cuts": F.col("cuts")}, fields, work, "text")
    left = (F.col("n_bytes") - F.col("n_removed")).alias("n_kept")
    return done.select("row.row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", left, (F.col("n_removed") > 0).alias("changed"))


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: bool = False) -> DataFrame:
    """The documents without their repeated passages (whole characters, or words), with their own columns.

    ``n_chars``, where there is such a column, is counted anew; all other columns stay.
    """

    def work():
        def cut(batch: pa.RecordBatch) -> list:
            data, rows = W.text_bytes(batch.column(0))
            body, texts = data.tobytes(), []
            starts, ends, before = W.spans(data, rows, W.NOT_SPACE) if words else (None, None, rows)
            for a, b, first, cuts in zip(rows[:-1], rows[1:], before, batch.column(1).to_pylist()):
                text, ranges = body[a:b], merged(cuts)
                if words:
                    ranges = [(starts[first + x] - a, ends[first + y - 1] - a) for x, y in ranges]
                texts.append(without(text, whole_characters(text, ranges)).decode("utf-8", "replace") if cuts else None)
            return [texts]

        return cut

    done = appended(_with_cuts(docs, length, gram, words), {"text": F.col("row.text"), "cuts": F.col("cuts")}, "_left string", work, "text")
    changed = {
        "text": F.coalesce("_left", "row.row.text"),
        "n_chars": F.when(F.col("_left").isNull(), F.col("row.row.n_chars")).otherwise(F.length("_left").cast("bigint")) if "n_chars" in docs.columns else None}
    return done.select(*[changed[c].alias(c) if changed.get(c) is not None else F.col(f"row.row.`{c}`") for c in docs.columns])
