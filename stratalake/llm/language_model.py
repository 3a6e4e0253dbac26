"""Language-model scores: a hidden Markov model over word classes, and words within their classes.

Frequent words are classes of their own; all others share classes by a hash of their last bytes.
Latent states emit classes (``markov``), and a word's chance within its class is Witten-Bell smoothed, with
one unseen word per class, so all chances sum to at most 1. A text's score is the exact log10 likelihood
of its classes and end, by the scaled forward recursion, plus those of the words within them.

All counts cover every training text (each that isn't held out). Word counts are summed over partitions and
kept as a table. The states begin as seeded perturbations of the classes' overall chances, and Baum-Welch
counts are summed over partitions too, in ``ROUNDS`` passes over all training texts.

Texts of over ``markov.TRAIN_SEGMENT`` tokens are trained in segments that each start from the stationary distribution, so their
Baum-Welch counts lack what one segment says of the next; their scores are exact.

Bounds: the ``TOP`` most frequent words with counts, CLASSES, and states x classes numbers are broadcast,
whatever the size of the input. Texts' other words meet the table of counts in a join; as the frequent
ones are not among them, no word is hot there. Words are 64-bit hashes.

Defined results: a null or empty text is its end alone; a null id counts as not held out; without
training texts N is 0 and chances come from smoothing alone; repeated rows count and score each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import markov
from stratalake.llm import words as W
from stratalake.llm.scratch import stored
from stratalake.llm.training import crc32_of_id

TOP, OWN, SHARED, STATES, ROUNDS = 1 << 18, 1 << 14, 1 << 12, 6, 5
CLASSES, BLOCK = OWN + SHARED, 2_048
#: Counters of so many tasks are added at once: 16 MB in a group, and in the second level one of them per 1,000 tasks.
TOGETHER, COUNTS = 1_000, "block int, part int, counts binary"
END = np.uint64(0x5851F42D4C957F2D)
FLUSH = 1 << 22


class Tokens:
    """Words of texts by hash, each text's end behind them, and the shared class of each."""

    def __init__(self, column: pa.Array):
        data, rows = W.text_bytes(column)
        starts, ends, before = W.spans(data, rows, W.NOT_SPACE)
        self.rows = before + np.arange(len(before))
        self.hashes = np.insert(W.hashes(data, starts, ends, lower=True), before[1:], END)
        tail, low = np.zeros(len(ends), np.uint64), W.LOWER[data].astype(np.uint64)
        for k in range(1, 5):
            at = ends - k
            tail |= np.where(at >= starts, low[np.maximum(at, 0)], 0).astype(np.uint64) << np.uint64(8 * k - 8)
        self.shared = np.insert((W.mix(tail) % np.uint64(SHARED)).astype(np.int32), before[1:], 0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, shared, c) of all words of training texts, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list) -> pa.RecordBatch:
            h, s, c = (np.concatenate([f[k] for f in found]) for k in range(3))
            words, first, which = np.unique(h, return_index=True, return_inverse=True)
            sums = np.bincount(which, c).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(W.signed(words)), pa.array(s[first], pa.int32()), pa.array(sums)], ["h", "shared", "c"])

        waiting, size = [], 0
        for batch in batches:
            for part in W.slices(batch):
                t = Tokens(part.column(0))
                words, first, times = np.unique(t.hashes, return_index=True, return_counts=True)
                waiting.append((words, t.shared[first], times))
                size += len(words)
                if size > FLUSH:
                    yield rows(waiting)
                    waiting, size = [], 0
        if waiting:
            yield rows(waiting)

    found = docs.where("not held_out").select("text").mapInArrow(count, "h bigint, shared int, c bigint")
    return found.groupBy("h").agg(F.first("shared").alias("shared"), F.sum("c").alias("c"))


class Vocabulary:
    """The most frequent words with counts and classes, and the sums of the shared classes' other words."""

    def __init__(self, counts: DataFrame):
        self.total, self.distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        end = F.col("h") == int(W.signed(np.array([END]))[0])
        top = counts.orderBy(end.desc(), F.col("c").desc(), "h").limit(TOP).toArrow()
        h, c = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
        own = np.arange(len(h)) < OWN - 1
        own[h == END] = False
        order = np.argsort(h)
        self.words, self.counts = h[order], c[order]
        self.own = np.where(own, np.cumsum(own), -1)[order]  # 0 is the end's
        self.own[self.words == END] = 0
        rare = np.zeros(SHARED), np.zeros(SHARED)
        sums = counts.groupBy("shared").agg(F.sum("c"), F.count("*")).collect()
        for k, n, t in sums:
            rare[0][k], rare[1][k] = n, t
        taken = self.own[order.argsort()] >= 0
        shared = top["shared"].to_numpy()
        rare[0][:] -= np.bincount(shared[taken], c[taken], SHARED)
        rare[1][:] -= np.bincount(shared[taken], minlength=SHARED)
        self.sums, self.kinds = rare
        usual = np.zeros(CLASSES)
        usual[self.own[self.own >= 0]] = self.counts[self.own >= 0]
        usual[OWN:] = self.sums
        self.usual = (usual + 0.5) / (usual.sum() + 0.5 * CLASSES)

    def within(self, shared: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 chances of words of shared classes, given their counts (0: unseen)."""
        n, t = self.sums[shared], self.kinds[shared]
        return np.log10(np.where(n + t == 0, 1.0, np.where(counts > 0, counts, t) / np.maximum(n + t, 1)))


ENCODED = "n_tokens bigint, known bigint, base double, inner double, classes binary, words array<bigint>, shared array<int>, times array<int>"


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``id`` of each text, classes (two bytes each), what its frequent words sum to, and its other words with times."""
    # at most TOP words with counts
    shared_with = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared_with.value
        for batch in batches:
            for part in W.slices(batch):
                t = Tokens(part.column(1))
                place = np.minimum(np.searchsorted(v.words, t.hashes), max(len(v.words) - 1, 0))
                top = v.words[place] == t.hashes if len(v.words) else np.zeros(len(t.hashes), bool)
                counts = np.where(top, v.counts[place], 0) if len(v.words) else np.zeros(len(t.hashes))
                own = np.where(top, v.own[place], -1) if len(v.words) else np.full(len(t.hashes), -1)
                own[t.hashes == END] = 0
                classes = np.where(own >= 0, own, OWN + t.shared).astype("<u2")
                base = np.where(top | (t.hashes == END), np.log10(counts + 0.1), 0.0)
                inner = np.where(top & (own < 0), v.within(t.shared, counts), 0.0)
                ends = np.concatenate([[0], np.cumsum(base)]), np.concatenate([[0], np.cumsum(inner)]), np.concatenate([[0], np.cumsum(top)])
                sums = [e[t.rows[1:]] - e[t.rows[:-1]] for e in ends]
                other = np.flatnonzero(~top & (t.hashes != END))
                row = np.searchsorted(t.rows, other, "right") - 1
                key = t.hashes[other] + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                _, first, times = np.unique(key, return_index=True, return_counts=True)
                order = np.argsort(first)
                first, times = first[order], times[order]
                lists = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=len(part)))]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(t.rows)), pa.array(sums[2].astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                    pa.array([classes[a:b].tobytes() for a, b in zip(t.rows[:-1], t.rows[1:])], pa.binary()),
                    pa.ListArray.from_arrays(lists, pa.array(W.signed(t.hashes[other[first]]))),
                    pa.ListArray.from_arrays(lists, pa.array(t.shared[other[first]])),
                    pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32)))],
                    ["id", "n_tokens", "known", "base", "inner", "classes", "words", "shared", "times"])

    return docs.select("id", "text").mapInArrow(encode, f"id {docs.schema['id'].dataType.simpleString()}, {ENCODED}")


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, rows = W.text_bytes(column)
    return np.frombuffer(data.tobytes(), "<u2").astype(np.int64), rows // 2


def added(counted: DataFrame) -> DataFrame:
    """Blocks of counters summed over tasks, in two levels: a group holds those of ``TOGETHER`` tasks, then one of each such group."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK)
        for counts in table["counts"]:
            total += np.frombuffer(counts.as_py(), np.float64)
        return pa.table({"block": table["block"].slice(0, 1), "part": table["part"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    return counted.groupBy("block", "part").applyInArrow(add, COUNTS).groupBy("block").applyInArrow(add, COUNTS)


def trained(texts: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> markov.Chain:
    """Baum-Welch over all rows of ``texts`` (a binary column ``classes``) in each round."""
    spark = texts.sparkSession
    chain = markov.seeded_chain(vocabulary.usual, states)
    size = states + states * states + states * CLASSES
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(chain)  # states x CLASSES numbers

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(-(-size // BLOCK) * BLOCK)
            for batch in batches:
                for part in W.slices(batch, "classes", 1 << 23):
                    found = markov.expected_counts(shared.value, *_sequences(part.column(0)))
                    total[:size] += np.concatenate([f.ravel() for f in found])
            blocks = [b.tobytes() for b in total.reshape(-1, BLOCK)]
            part = TaskContext.get().partitionId() // TOGETHER
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())], ["block", "part", "counts"])

        counted = texts.select("classes").mapInArrow(count, COUNTS)
        total = np.zeros((-(-size // BLOCK), BLOCK))
        for r in added(counted).collect():  # states x CLASSES numbers
            total[r.block] = np.frombuffer(r.counts)
        first, move, emit = np.split(total.ravel()[:size], [states, states + states * states])
        chain = markov.refitted(first, move.reshape(states, states), emit.reshape(CLASSES, states), vocabulary.usual)
    return chain


def scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, held_out, text): these but the text, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "held_out", "text")
    counts = stored(word_counts(docs), "counts")
    vocabulary = Vocabulary(counts)
    # the ids are drawn in the same scan that is stored, so they never change
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    texts = numbered.select(F.struct("row", "doc_id", "held_out").alias("id"), "text")
    found = stored(encoded(texts, vocabulary), "encoded")
    chain = trained(found.where("not id.held_out"), vocabulary, states, rounds)
    shared = spark.sparkContext.broadcast(chain)  # states x CLASSES numbers

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "classes", 1 << 23):
                logs = markov.log_likelihoods(shared.value, *_sequences(part.column(5))) / np.log(10)
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(logs)], ["id", "n_tokens", "known", "base", "inner", "outer"])

    kind = f"id {found.schema['id'].dataType.simpleString()}, n_tokens bigint, known bigint, base double, inner double, outer double"
    outer = found.select("id", "n_tokens", "known", "base", "inner", "classes").mapInArrow(forward, kind)
    sums = spark.createDataFrame([(k, float(n), float(t)) for k, (n, t) in enumerate(zip(vocabulary.sums, vocabulary.kinds))], "shared int, n double, t double")
    others = found.select(F.col("id.row").alias("row"), F.explode(F.arrays_zip("words", "shared", "times")).alias("w")).select("row", F.col("w.words").alias("h"), F.col("w.shared").alias("shared"), F.col("w.times").alias("times"))
    met = others.join(counts.select("h", "c"), "h", "left").join(F.broadcast(sums), "shared")  # SHARED rows
    c = F.coalesce("c", F.lit(0))
    chance = F.when(F.col("n") + F.col("t") == 0, 1.0).otherwise(F.when(c > 0, c).otherwise(F.col("t")) / F.greatest(F.col("n") + F.col("t"), F.lit(1.0)))
    rest = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(c + 0.1)).alias("rest_base"), F.sum(F.col("times") * F.log10(chance)).alias("rest_inner"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rest_known"))
    total = float(np.log10(vocabulary.total + 0.1 * (vocabulary.distinct + 1)))
    zero = F.lit(0.0)
    return outer.withColumn("row", F.col("id.row")).join(rest, "row", "left").select(
        "id.doc_id", "id.held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(vocabulary.total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", zero) - F.col("n_tokens") * total).alias("base_score"),
        (F.col("outer") + F.col("inner") + F.coalesce("rest_inner", zero)).alias("score"))


def report(docs: DataFrame) -> DataFrame:
    """The scores, learned from documents whose crc32(doc_id as text) mod 10 is not 0."""
    return scores(docs.select("doc_id", F.coalesce(crc32_of_id() % 10 == 0, F.lit(False)).alias("held_out"), "text"))
