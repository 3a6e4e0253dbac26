"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of test items.

Normalised text lower-cases A-Z and keeps words of ASCII letters, ASCII digits and characters above
ASCII, joined by one space. Every run of ``window`` words of an item is a pattern; an item of fewer
words, but not none, is one pattern. Each document is scanned once; words inside any occurrence are
hit, and hit runs are mapped back to offsets of the original text.

Defined results: null and empty texts have no words and are clean; an item without words gives no
pattern; repeated items count once; an item with a null id is known as the empty string; an empty
benchmark leaves everything clean.

Size: an automaton is built from about ``block_bytes`` of distinct item text; long items are cut into overlapping pieces
first, so a block is never much more. A larger benchmark is taken in blocks, each with one pass over the texts alone that
writes the hits it finds; documents are stored once and meet their hits in one join. So memory stays bounded and
every item is still looked for. Items are a stated query set.
"""

from __future__ import annotations

import math
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import words as W
from stratalake.llm.batches import appended
from stratalake.llm.scratch import stored

BLOCK_BYTES, PIECE_WORDS = 1 << 18, 1 << 12
_NORMAL = bytes(int(W.LOWER[b]) if W.ALNUM[b] else 0x20 for b in range(256))
FOUND = "n_words bigint, runs array<struct<start:int,stop:int>>, items array<string>"


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def patterns(items: list[tuple[str, str]], window: int) -> dict[str, list[str]]:
    """Each pattern (spaces around, one char per UTF-8 byte) with the ids of its items."""
    out: dict[str, set[str]] = {}
    for item, text in items:
        w = normal_words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            out.setdefault((b" " + b" ".join(w[k : k + window]) + b" ").decode("latin-1"), set()).add(item)
    return {p: sorted(ids) for p, ids in out.items()}


def automaton(found: dict[str, list[str]]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for pattern, ids in found.items():
        made.add_word(pattern, (pattern.count(" ") - 1, len(pattern), ids))
    made.make_automaton()
    return made


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching word runs as maximal ones."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def scan_text(text: bytes, search: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit runs of words, and items found in one text."""
    w = text.translate(_NORMAL).split()
    if not w or not len(search):
        return len(w), [], set()
    line = (b" " + b" ".join(w) + b" ").decode("latin-1")
    ends, sizes, items = [], [], set()
    for end, (count, _, ids) in search.iter(line):
        ends.append(end)
        sizes.append(count)
        items.update(ids)
    if not ends:
        return len(w), [], set()
    gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
    last = np.searchsorted(gaps, ends)  # the word before the gap that closes the occurrence
    return len(w), joined([(int(k) - n, int(k)) for k, n in zip(last, sizes)]), items


def pieces(benchmark: DataFrame, item: str, text: str, window: int, step: int = PIECE_WORDS) -> DataFrame:
    """(id, text): distinct normalised items, long ones cut into pieces that hold ``step`` windows each and overlap by one word less than a window."""
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(step))
    return (
        benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")).alias("id"), words.alias("words"))
        .where("size(words) > 0")
        .select("id", "words", F.explode(starts).alias("start"))
        .select("id", F.array_join(F.slice("words", F.col("start") + 1, step + window - 1), " ").alias("text"))
        .distinct()
    )


def _searched(docs: DataFrame, text: Column, found: dict[str, list[str]]) -> DataFrame:
    """``row`` (all columns of ``docs``), n_words, runs and items, by one automaton over these patterns."""
    shared = docs.sparkSession.sparkContext.broadcast(found)  # of at most a block of items

    def work():
        search = automaton(shared.value)

        def scan_batch(batch: pa.RecordBatch) -> list:
            data, rows = W.text_bytes(batch.column(0))
            body, counts, runs, names = data.tobytes(), [], [], []
            for a, b in zip(rows[:-1], rows[1:]):
                n, hit, ids = scan_text(body[a:b], search)
                counts.append(n)
                runs.append([{"start": s, "stop": e} for s, e in hit])
                names.append(sorted(ids))
            return [counts, runs, names]

        return scan_batch

    return appended(docs, {"text": text}, FOUND, work, "text")


def _united(hits: DataFrame) -> DataFrame:
    """Per ``key``: runs of all blocks as maximal ones, and all items. A document's hits are bounded by its words and the items."""
    listed = hits.groupBy("key").agg(F.flatten(F.collect_list("runs")).alias("all_runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def work():
        def unite(batch: pa.RecordBatch) -> list:
            return [[[{"start": s, "stop": e} for s, e in joined([(r["start"], r["stop"]) for r in found])] for found in batch.column(1).to_pylist()]]

        return unite

    made = appended(listed, {"text": F.lit(""), "found": "all_runs"}, "runs array<struct<start:int,stop:int>>", work, "text")
    return made.select("row.key", "runs", "row.items")


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (all columns of ``docs``), n_words, ``runs`` (hit runs of words) and ``items`` found."""
    items = pieces(benchmark, item, item_text, window)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    if blocks == 1:
        return _searched(docs, docs[f"`{text}`"], patterns([tuple(r) for r in items.collect()], window))
    items = stored(items, "items")
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    # keys are drawn in the scan that is stored, so they never change
    kept = stored(docs.select(whole, F.monotonically_increasing_id().alias("key")), "documents")
    texts = kept.select("key", F.col(f"row.`{text}`").alias("text"))
    hits, counts = [], None
    for k in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()  # a block
        found = _searched(texts, F.col("text"), patterns([tuple(r) for r in chosen], window)).select("row.key", "n_words", "runs", "items")
        if k == 0:
            found = stored(found, "first")
            counts = found.select("key", "n_words")
        hits.append(stored(found.where("size(runs) > 0").select("key", "runs", "items"), "hits"))
    none = [F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in (("runs", "array<struct<start:int,stop:int>>"), ("items", "array<string>"))]
    return kept.join(counts, "key").join(_united(reduce(DataFrame.unionAll, hits)), "key", "left").select("row", "n_words", *none)


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as character offsets of the original text."""
    places, inside = [], False
    for k, char in enumerate(text):
        word = char >= "\x80" or char.isalnum()
        if word and not inside:
            places.append([k, k + 1])
        elif word:
            places[-1][1] = k + 1
        inside = word
    return [(places[a][0], places[b - 1][1]) for a, b in runs]


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: words, hit words, items found (count and digest) and the verdict."""
    found = scan(docs, benchmark, window=window)
    hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + (r["stop"] - r["start"]))
    return found.select(
        "row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no test item occurs, with their own columns."""
    return scan(docs, benchmark, window=window).where(F.size("runs") == 0).select("row.*")
