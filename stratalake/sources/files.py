"""Source files: what is new, whether it is well formed, and text-preserving reads."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratalake.functions.text import base_name, decoded
from stratalake.sources import fs

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
BOM = "\ufeff"
#: JSON files are read as one line each: no well-formed JSON holds this character. As lines, files are packed into tasks
#: to find their columns out, and a number's text is taken from memory; with ``multiLine``, one task reads all files
#: for the columns and every number in a text column is read from storage again.
WHOLE = {"lineSep": "\x1e"}


#: The first record of a CSV text: up to a line break outside quotes. A header is at most so long.
FIRST_RECORD = '^(?:[^"\\n]++|"(?:[^"]++|"")*+"?)*+'
HEADER_LIMIT = 1 << 20


def _without_bom(content: Column) -> Column:
    return F.ltrim(content.cast("string"), F.lit(BOM))


def header_record(text: Column) -> Column:
    """The header of a CSV text as it is written, line breaks in quotes included."""
    return F.rtrim(F.regexp_extract(F.left(text, F.lit(HEADER_LIMIT)), FIRST_RECORD, 0), F.lit("\r"))


def is_one_json_value(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else.

    Spark's parsers stop behind the first value. Inside an array and inside an object, what follows the
    value must be the closing mark, and no text can close both.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1
    return F.coalesce(in_array & in_object, F.lit(False))


def inspect_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """One row per matching file: path, file_name, size_bytes, sha256, is_utf8, header (of a CSV), one_json
    and the first and last visible characters. Executors read the bytes; the driver only lists names.

    Spark leaves empty files out of its reads, so the listing is joined back in.
    """
    listed = fs.glob(spark, f"{directory.rstrip('/')}/{pattern}")
    names = spark.createDataFrame(listed, "path string, file_name string, size_bytes bigint")
    text, blank = _without_bom(F.col("content")), F.lit(" \t\r\n")
    read = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(directory)
        .select(
            base_name(F.col("path")).alias("file_name"),
            F.sha2("content", 256).alias("sha256"),
            F.is_valid_utf8(F.col("content").cast("string")).alias("is_utf8"),
            header_record(text).alias("header"),
            is_one_json_value(text).alias("one_json"),
            F.left(F.ltrim(text, blank), F.lit(1)).alias("opens"),
            F.right(F.rtrim(text, blank), F.lit(1)).alias("closes"),
        )
        if listed
        else spark.createDataFrame(
            [], "file_name string, sha256 string, is_utf8 boolean, header string, one_json boolean, opens string, closes string"
        )
    )
    return names.join(read, "file_name", "left").fillna(
        {"sha256": EMPTY_SHA256, "is_utf8": True, "header": "", "one_json": False, "opens": "", "closes": ""}
    )


def new_files(files: DataFrame, ledger: DataFrame | None, full_refresh: bool = False) -> DataFrame:
    """Files whose name and content hash are not in the ledger; all of them on a full refresh."""
    if full_refresh or ledger is None:
        return files
    return files.join(ledger.select("file_name", "sha256").distinct(), ["file_name", "sha256"], "left_anti")


def _corrupt_rows(other: str) -> Column:
    """Spark does not read ``_corrupt_record`` alone, so another column is counted along with it."""
    return F.count(F.when(F.col("_corrupt_record").isNotNull(), F.coalesce(F.col(other), F.lit(""))))


def _csv_verdicts(files: DataFrame, required: Sequence[str]) -> DataFrame:
    spark = files.sparkSession
    # Distinct headers of at most HEADER_LIMIT characters; longer ones are refused, not collected.
    fits = F.length("header") < HEADER_LIMIT
    facts = []
    for row in files.filter(fits).select("header").distinct().collect():
        fields = next(csv.reader(io.StringIO(row.header, newline="")), [])
        absent = [c for c in required if c not in fields]
        facts.append((row.header, len(fields), f"missing required columns: {absent}" if fields and absent else None))
    shape = spark.createDataFrame(facts, "header string, width int, absent string")
    shaped = files.join(shape, "header", "left")
    counts = []
    for width in sorted({n for _, n, absent in facts if n and absent is None}):
        paths = [r.path for r in shaped.filter((F.col("width") == width) & F.col("absent").isNull() & F.col("is_utf8")).select("path").collect()]
        if paths:
            columns = [f"_c{i} string" for i in range(width)]
            counts.append(
                spark.read.schema(", ".join([*columns, "_corrupt_record string"]))
                .options(header=True, multiLine=True, escape='"', columnNameOfCorruptRecord="_corrupt_record")
                .csv(paths)
                .groupBy(decoded(F.col("_metadata.file_name")).alias("file_name"))
                .agg(F.count(F.lit(1)).alias("n"), _corrupt_rows("_c0").alias("bad"))
            )
    empty = spark.createDataFrame([], "file_name string, n bigint, bad bigint")
    for part in counts:
        empty = empty.unionByName(part)
    reason = (
        F.when(~F.col("is_utf8"), "not valid UTF-8")
        .when(~fits, "header is too long")
        .when(F.col("width") == 0, "file is empty or has no header")
        .when(F.col("absent").isNotNull(), F.col("absent"))
        .when(F.col("bad") > 0, F.format_string("%d row(s) with a field count other than %d", "bad", "width"))
    )
    return shaped.join(empty, "file_name", "left").withColumn("reason", reason)


def _json_verdicts(files: DataFrame) -> DataFrame:
    spark = files.sparkSession
    # Asked for distinct names alone, Spark need not read the files; what isn't UTF-8 is read below and refused all the same.
    paths = sorted(r.path for r in files.filter("size_bytes > 0").select("path").distinct().collect())
    counts = spark.createDataFrame([], "file_name string, n bigint, bad bigint")
    if paths:
        counts = (
            spark.read.schema("_any string, _corrupt_record string")
            .options(columnNameOfCorruptRecord="_corrupt_record", **WHOLE)
            .json(paths)
            .groupBy(decoded(F.col("_metadata.file_name")).alias("file_name"))
            .agg(F.count(F.lit(1)).alias("n"), _corrupt_rows("_any").alias("bad"))
        )
    reason = (
        F.when(~F.col("is_utf8"), "not valid UTF-8")
        .when((F.col("bad") > 0) & (F.col("opens") == "[") & (F.col("closes") == "]"), "malformed JSON or an element that is not an object")
        .when((F.col("bad") > 0) | (F.col("opens") == "") | ~F.col("one_json"), "malformed JSON")
        .when(F.col("opens") != "[", "top level must be a JSON array of records")
        .when(F.col("closes") != "]", "malformed JSON")
    )
    return files.join(counts, "file_name", "left").withColumn("reason", reason)


def file_verdicts(files: DataFrame, kind: str, required: Sequence[str] = ()) -> DataFrame:
    """Per file: path, file_name, size_bytes, sha256, record_count and the ``reason`` it is refused
    for (NULL when it is well formed)."""
    judged = _csv_verdicts(files, required) if kind == "csv" else _json_verdicts(files)
    count = F.when(F.col("reason").isNull(), F.coalesce("n", F.lit(0))).cast("bigint")
    return judged.select("path", "file_name", "size_bytes", "sha256", count.alias("record_count"), "reason")


def read_text_rows(spark: SparkSession, paths: Sequence[str], kind: str, columns: Sequence[str] = ()) -> DataFrame:
    """Landed rows with every primitive as text. Malformed rows show in ``_corrupt_record``.

    JSON lines whose ``columns`` are known are read without a pass to find them out.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", "_corrupt_record")
    if kind == "jsonl" and columns:
        names = [*columns, "_corrupt_record"]
        return reader.schema(StructType([StructField(n, StringType()) for n in names])).json(list(paths))
    if kind == "jsonl":
        return reader.option("primitivesAsString", True).json(list(paths))
    if kind == "json":
        return reader.options(primitivesAsString=True, **WHOLE).json(list(paths))
    return reader.options(header=True, inferSchema=False, multiLine=True, escape='"').csv(list(paths))


def read_csv_rows(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """CSV files by their own headers: files that share a header are read together and the groups
    are put side by side by column name."""
    first = (
        spark.read.format("binaryFile").load(list(files))
        .select("path", header_record(_without_bom(F.col("content"))).alias("line"))
        .collect()
    )
    groups: dict[str, list[str]] = {}
    for row in first:
        groups.setdefault(row.line, []).append(row.path)
    rows = None
    for line in sorted(groups):
        part = read_text_rows(spark, sorted(groups[line]), "csv").select("*", decoded(F.col("_metadata.file_path")).alias("_path"))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows


def export_by_month(df: DataFrame, moment: str, path: str) -> None:
    """Rows as JSON, one folder per month of ``moment``."""
    monthly = df.withColumn("month", F.date_format(moment, "yyyy-MM"))
    monthly.write.mode("overwrite").partitionBy("month").json(path)
