"""CSV verdicts for files of any size: splits are scanned apart and put together by what state they start in.

Spark's text source hands out byte ranges that begin and end at line feeds, and no file is read whole anywhere. At the
start of a line a CSV file is in one of two states: a record begins, or a quoted field goes on. So a split is a map from
the state it starts in to the state it ends in, the records it completes, and the separators of the records that reach
over its ends. One pass scans each split both ways: as if a record began there, and as if a quoted field went on. The second
way costs nothing up to the first quote, and little behind it: once both ways find that a record begins at the same line,
they go on as one. The maps of a file's splits are then composed in order.

Quotes count only at the beginning of a field, a doubled quote stands for one, blank lines are skipped, and a quote that is
never closed ends with the file. Nearly all lines are counted by Arrow's kernels; those that a quoted line break or a stray
quote makes irregular are walked through field by field.

Bounds: a task holds one Arrow batch of lines; a split leaves two small rows, and a file's splits (one per
``spark.sql.files.maxPartitionBytes``) meet in one row. Nothing but the listing of files reaches the driver. A header ends
within its file's first split and under ``HEADER_LIMIT`` bytes, or the file is refused.
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.text import base_name, decoded
from stratalake.sources import fs
from stratalake.sources.files import HEADER_LIMIT

_FIELD, _QUOTED = '[^",]*', '"(?:[^"]|"")*"'
#: Lines whose quotes open at the beginning of a field and close at its end.
_REGULAR = f"^(?:{_FIELD}|{_QUOTED})(?:,(?:{_FIELD}|{_QUOTED}))*$"
STATE = "end_open boolean, head int, tail int, fields array<int>, counts array<bigint>"
SCANNED = f"path string, start bigint, opened boolean, {STATE}, header array<string>, utf8 boolean"
#: Lines after which it is looked whether both ways of scanning have met.
MEETING = 4_096
_BOM = b"\xef\xbb\xbf"


def walk(line: bytes, opened: bool) -> tuple[int, bool]:
    """Separators outside quotes in a line, and whether a quoted field goes on behind it."""
    at, separators = 0, 0
    while True:
        if opened or line[at : at + 1] == b'"':
            at, opened = (at if opened else at + 1), False
            while True:
                quote = line.find(b'"', at)
                if quote < 0:
                    return separators, True
                at = quote + 1
                if line[at : at + 1] != b'"':
                    break
                at += 1
        comma = line.find(b",", at)
        if comma < 0:
            return separators, False
        separators, at = separators + 1, comma + 1


class Way:
    """Counts over one split, scanned as if it started within quotes (``opened``) or not."""

    def __init__(self, path: str, start: int, opened: bool):
        self.path, self.start, self.opened, self.open = path, start, opened, opened
        self.head: int | None = None
        self.pending, self.fields, self.utf8 = 0, Counter(), True
        self.leading, self.begun = opened, False
        self.header: list[str] | None = None
        self.record, self.size = [], 0

    def add(self, lines: pa.Array, valid: np.ndarray) -> None:
        self.utf8 &= bool(valid.all())
        if not self.begun and self.start == 0 and not self.opened:
            lines = self._without_header(lines)
        if not len(lines):
            return
        lines = pc.replace_substring_regex(lines, "\r$", "")
        quotes = pc.count_substring(lines, b'"').to_numpy() > 0
        plain = np.where(quotes, 0, pc.count_substring(lines, b",").to_numpy()) + 1
        plain[pc.binary_length(lines).to_numpy() == 0] = 0
        odd = quotes.copy()
        where = np.flatnonzero(quotes)
        if len(where):
            some = lines.take(pa.array(where))
            regular = pc.match_substring_regex(some, _REGULAR).to_numpy(zero_copy_only=False)
            bare = pc.count_substring(pc.replace_substring_regex(some, _QUOTED, ""), b",").to_numpy() + 1
            plain[where[regular]], odd[where[regular]] = bare[regular], False
        irregular, at = np.flatnonzero(odd), 0
        while at < len(lines):
            if self.open:
                rest = np.searchsorted(where, at)
                if rest == len(where):
                    return
                at = int(where[rest])
            else:
                rest = np.searchsorted(irregular, at)
                stop = int(irregular[rest]) if rest < len(irregular) else len(lines)
                values, times = np.unique(plain[at:stop], return_counts=True)
                self.fields.update({int(v): int(t) for v, t in zip(values, times) if v})
                at = stop
                if at == len(lines):
                    return
            separators, self.open = walk(lines[at].as_py(), self.open)
            self.pending += separators
            at += 1
            if not self.open:
                if self.leading:
                    self.head, self.leading = self.pending, False
                else:
                    self.fields[self.pending + 1] += 1
                self.pending = 0

    def _without_header(self, lines: pa.Array) -> pa.Array:
        """Takes the header's lines away; no header is known while its quotes are open."""
        for k in range(len(lines)):
            line = lines[k].as_py()
            if not self.record:
                line = line.removeprefix(_BOM)
            self.record.append(line)
            self.size += len(line) + 1
            _, self.open = walk(line.removesuffix(b"\r"), self.open)
            if not self.open or self.size > HEADER_LIMIT:
                self.begun = True
                if self.size <= HEADER_LIMIT:
                    text = b"\n".join(self.record).decode(errors="replace")
                    self.header = next(csv.reader(io.StringIO(text, newline="")), [])
                self.open, self.record = False, []
                return lines.slice(k + 1)
        return lines.slice(len(lines))

    def row(self) -> tuple:
        fields = sorted(self.fields)
        return (self.path, self.start, self.opened, self.open, self.head, self.pending, fields, [self.fields[f] for f in fields], self.header, self.utf8)


class Split:
    """Both ways to scan one split, until they meet."""

    def __init__(self, path: str, start: int):
        self.path, self.start = path, start
        self.closed, self.opened = Way(path, start, False), Way(path, start, True)
        self.met: Counter | None = None

    def add(self, lines: pa.Array, valid: np.ndarray) -> None:
        for k in range(0, len(lines), MEETING):
            some, ok = lines.slice(k, MEETING), valid[k : k + MEETING]
            self.closed.add(some, ok)
            if self.met is None:
                self.opened.add(some, ok)
                if not self.closed.open and not self.opened.open:
                    self.met = Counter(self.closed.fields)

    def rows(self) -> list[tuple]:
        if self.met is not None:
            self.opened.fields += self.closed.fields - self.met
            self.opened.open, self.opened.pending = self.closed.open, self.closed.pending
        return [self.closed.row(), self.opened.row()]


_KINDS = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()),
          "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*(c.split(" ") for c in SCANNED.split(", ")))

    def out(split: Split) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, t in zip(zip(*split.rows()), kinds)], list(names))

    now = None
    for batch in batches:
        start, path = batch.column("start").to_numpy(), batch.column("path")
        valid = batch.column("utf8").to_numpy(zero_copy_only=False)
        # the lines of a split come one after the other
        other = pc.not_equal(path.slice(1), path.slice(0, max(len(path) - 1, 0))).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.append(len(start) > 0, (np.diff(start) != 0) | other))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(start)]):
            key = (path[a].as_py(), int(start[a]))
            if now is None or (now.path, now.start) != key:
                if now is not None:
                    yield out(now)
                now = Split(*key)
            now.add(batch.column("line").slice(a, b - a), valid[a:b])
    if now is not None:
        yield out(now)


def _of_width(split: Column, width: Column, equal: bool) -> Column:
    pairs = F.arrays_zip(split["fields"], split["counts"])
    chosen = F.filter(pairs, lambda p: p["fields"] == width) if equal else pairs
    return F.aggregate(chosen, F.lit(0).cast("bigint"), lambda a, p: a + p["counts"])


def composed(files: DataFrame) -> DataFrame:
    """``files`` with records and fitting: all records behind the header, and those with ``width`` fields.

    ``splits`` holds what was scanned of a file, both ways (structs of start, opened and ``STATE``).
    """
    def way(opened: bool) -> Column:
        return F.filter("splits", lambda s: s["opened"] == opened)

    files = files.withColumns({"closed": way(False), "opened": way(True)}).drop("splits")
    pairs = F.arrays_zip("closed", "opened")
    zero = F.struct(F.lit(False).alias("open"), F.lit(0).alias("pending"), F.lit(0).cast("bigint").alias("records"), F.lit(0).cast("bigint").alias("fitting"))
    width_of = F.col("width")

    def completed(now: Column, separators: Column) -> tuple[Column, Column]:
        return F.lit(1).cast("bigint"), F.when(now["pending"] + separators + 1 == width_of, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    def step(now: Column, s: Column) -> Column:
        split = F.when(now["open"], s["opened"]).otherwise(s["closed"])
        ends = now["open"] & split["head"].isNotNull()
        one, fits = completed(now, split["head"])
        goes_on = now["open"] & split["head"].isNull()
        return F.struct(
            split["end_open"].alias("open"),
            F.when(goes_on, now["pending"] + split["tail"]).otherwise(split["tail"]).alias("pending"),
            (now["records"] + F.when(ends, one).otherwise(F.lit(0)) + _of_width(split, width_of, False)).alias("records"),
            (now["fitting"] + F.when(ends, fits).otherwise(F.lit(0)) + _of_width(split, width_of, True)).alias("fitting"))

    def finish(now: Column) -> Column:
        one, fits = completed(now, F.lit(0))
        last = now["open"]
        return F.struct(
            (now["records"] + F.when(last, one).otherwise(F.lit(0))).alias("records"), (now["fitting"] + F.when(last, fits).otherwise(F.lit(0))).alias("fitting"))

    return files.withColumn("n", F.aggregate(pairs, zero, step, finish)).select("*", "n.records", "n.fitting").drop("n", "closed", "opened")


def _lines(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """(path, start of the split, line, utf8), in order within each split; lines end at line feeds alone."""
    return spark.read.options(pathGlobFilter=pattern, lineSep="\n").text(paths).select(
        decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"), F.is_valid_utf8("value").alias("utf8"))


def csv_verdicts(spark: SparkSession, directory: str, pattern: str, required: Sequence[str] = ()) -> DataFrame:
    """Per matching file: path, file_name, size_bytes, record_count, and the ``reason`` it is refused for (NULL: well formed)."""
    listed = spark.createDataFrame(fs.glob(spark, f"{directory.rstrip('/')}/{pattern}"), "path string, file_name string, size_bytes bigint")
    ordered = F.array_sort(F.collect_list(F.struct("start", "opened", *[c.split(" ")[0] for c in STATE.split(", ")])))
    scanned = _lines(spark, directory, pattern).mapInArrow(_scan, SCANNED)
    files = scanned.groupBy("path").agg(F.max("header").alias("header"), F.bool_and("utf8").alias("utf8"), ordered.alias("splits"))
    files = composed(files.withColumn("width", F.size("header")))
    absent = F.filter(F.array(*[F.lit(c) for c in required]).cast("array<string>"), lambda c: ~F.array_contains("header", c))
    judged = files.select(
        base_name(F.col("path")).alias("file_name"), F.lit(True).alias("seen"), "utf8", "header", "width", absent.alias("absent"), "records",
        (F.col("records") - F.col("fitting")).alias("bad"))
    reason = (
        F.when(~F.col("utf8"), "not valid UTF-8")
        .when(F.col("seen") & F.col("header").isNull(), "header is too long")
        .when(F.coalesce("width", F.lit(0)) <= 0, "file is empty or has no header")
        .when(F.size("absent") > 0, F.concat(F.lit("missing required columns: ['"), F.array_join("absent", "', '"), F.lit("']")))
        .when(F.col("bad") > 0, F.format_string("%d row(s) with a field count other than %d", "bad", "width"))
    )
    found = listed.join(judged, "file_name", "left").withColumn("reason", reason)
    return found.select("path", "file_name", "size_bytes", F.when(F.col("reason").isNull(), F.col("records")).alias("record_count"), "reason")
