import re
from datetime import datetime, timezone

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.functions import text
from stratalake.operators import incremental
from stratalake.sources import files, jdbc, pages, specs
from stratalake.sources.lake import Lake


def test_incremental_window(spark):
    rows = spark.createDataFrame([(i, datetime(2025, 1, i)) for i in (1, 2, 3)], "id int, updated_at timestamp")
    window = lambda since, upper: [r[0] for r in rows_of(incremental.incremental_window(rows, "updated_at", since, upper), "id")]
    assert window(None, "2025-01-03") == [1, 2, 3]
    assert window("2025-01-01", "2025-01-02") == [2]
    assert window("2025-01-03T00:00:00+00:00", "2025-01-09") == []
    assert incremental.window_upper(datetime(2025, 1, 1, 0, 0, 30), 30) == datetime(2025, 1, 1)


def test_naive_times_are_utc_and_the_bound_is_inclusive(spark):
    rows = spark.createDataFrame([(1, datetime(2025, 1, 1)), (2, datetime(2025, 1, 2))], "id int, updated_at timestamp")
    for since in ("2025-01-02T00:00:00", "2025-01-02T00:00:00+00:00", "2025-01-02T02:00:00+02:00", datetime(2025, 1, 2)):
        assert rows_of(incremental.updated_since(rows, since), "id") == [(2,)]
    fx = spark.createDataFrame([("EUR",), ("USD",)], "quote_currency string")
    assert rows_of(incremental.of_currency(fx, "eur"), "*") == [("EUR",)]


def test_the_window_reaches_the_scan(spark):
    df = incremental.incremental_window(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", "2024-01-05", "2024-01-09").select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "props" not in plan


def test_next_watermark(spark):
    rows = spark.createDataFrame([(datetime(2025, 1, 1),), (datetime(2025, 1, 3),)], "t timestamp")
    assert incremental.next_watermark(rows, "t", "2024-01-01").first()[0] == datetime(2025, 1, 3)
    assert incremental.next_watermark(rows.limit(0), "t", "2024-01-01").first()[0] == datetime(2024, 1, 1)
    assert incremental.next_watermark(rows.limit(0), "t").first()[0] is None


def test_pending_batches(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "batch_id string")
    assert rows_of(incremental.pending_batches(ids("a", "b", "b", "c"), ids("a"), ids("c")), "*") == [("b",)]
    assert incremental.pending_batches(ids("a", "a")).count() == 1


def test_page_envelopes(spark):
    good = '{"data":[{"rate":1.5,"updated_at":"2025-01-01","quote_currency":"EUR"}],"page":1,"has_more":false}'
    bad = ["<html>", "[1]", '{"rows":[]}', '{"data":{}}', '{"data":[1]}', '{"data":[{"rate":1}]}']
    df = spark.createDataFrame([(b,) for b in [good, '{"data":[]}', *bad]], "body string")
    rows, refused = pages.explode_pages(df, "updated_at", ["quote_currency", "rate", "absent"])
    assert rows_of(rows, "*") == [("EUR", "1.5", None)]
    assert {r.body for r in refused.collect()} == set(bad)


def test_every_row_is_on_exactly_one_page(spark):
    df = spark.range(1, 2001).select((F.col("id") * 7919 % 2003).alias("k"))
    seen, page, more = [], 1, True
    while more:
        rows = pages.page_slice(df, page, 700, ["k"]).collect()
        seen += [r.k for r in rows]
        more, page = rows[0].has_more, page + 1
        assert rows[0].total == 2000
    assert page == 4 and seen == sorted(seen) and len(set(seen)) == 2000
    with pytest.raises(ValueError):
        pages.page_slice(df, 0, 10, ["k"])


def write(folder, **contents):
    folder.mkdir(exist_ok=True)
    for name, content in contents.items():
        (folder / name.replace("__", ".")).write_bytes(content)


def test_csv_verdicts(spark, tmp_path):
    write(tmp_path / "in", ok__csv=b'\xef\xbb\xbfa,b\n1,2\n\n3,"x\ny, ""q"""\n', short__csv=b"a,b\n1,2\n3\n", long__csv=b"a,b\n1,2\n3,4,5\n",
          empty__csv=b"", bad__csv=b"a,b\n1,\xff\xfe\n", head__csv=b"a,b\r\n", wide__csv=b"b,c,a\n1,2,3\n", lacks__csv=b"a,c\n1,2\n", skip__txt=b"a,b\n")
    found = files.inspect_files(spark, str(tmp_path / "in"), "*.csv")
    got = {r.file_name: (r.record_count, r.reason) for r in files.file_verdicts(found, "csv", ["a", "b"]).collect()}
    assert got["ok.csv"] == (2, None) and got["head.csv"] == (0, None) and got["wide.csv"] == (1, None)
    assert got["empty.csv"] == (None, "file is empty or has no header")
    assert got["short.csv"] == got["long.csv"] == (None, "1 row(s) with a field count other than 2")
    assert got["bad.csv"] == (None, "not valid UTF-8")
    assert got["lacks.csv"] == (None, "missing required columns: ['b']")
    assert "skip.txt" not in got and len(got) == 8


def test_json_verdicts(spark, tmp_path):
    write(tmp_path / "in", ok__json=b'[{"a":1},{"a":2,"b":{"c":1}}]', bom__json=b'\xef\xbb\xbf[{"a":1}]', obj__json=b'{"a":1}', nums__json=b"[1,2]",
          mixed__json=b'[{"a":1},3]', null__json=b'[null,{"a":1}]', bad__json=b"not json", trail__json=b'[{"a":1}] xx', e__json=b"[]", empty__json=b"",
          latin__json=b'[{"a":"\xe9"}]', lines__json=b'[\n {"a": 1},\n {"a": "]"}\n]\n')
    found = files.inspect_files(spark, str(tmp_path / "in"), "*.json")
    got = {r.file_name: (r.record_count, r.reason) for r in files.file_verdicts(found, "json").collect()}
    assert {n for n, (_, reason) in got.items() if reason is None} == {"ok.json", "bom.json", "e.json", "lines.json"}
    assert [got[n][0] for n in ("ok.json", "bom.json", "e.json", "lines.json")] == [2, 1, 0, 2]
    assert got["obj.json"][1] == "top level must be a JSON array of records"
    assert got["latin.json"][1] == "not valid UTF-8"
    assert got["empty.json"][1] == got["bad.json"][1] == "malformed JSON"


def test_new_and_changed_files(spark, tmp_path):
    write(tmp_path / "in", a__csv=b"x\n1\n", b__csv=b"x\n2\n")
    found = lambda: files.inspect_files(spark, str(tmp_path / "in"), "*.csv")
    ledger = spark.createDataFrame(found().select("file_name", "sha256").collect())
    assert files.new_files(found(), ledger).count() == 0
    assert files.new_files(found(), ledger, full_refresh=True).count() == 2
    write(tmp_path / "in", b__csv=b"x\n3\n")
    assert rows_of(files.new_files(found(), ledger), "file_name") == [("b.csv",)]


def test_csv_files_with_different_headers(spark, tmp_path):
    write(tmp_path / "in", a__csv=b'zip,name\n007,"Rome, IT"\n', b__csv=b"name,zip\nOslo,\n")
    rows = files.read_csv_rows(spark, [str(tmp_path / "in" / "a.csv"), str(tmp_path / "in" / "b.csv")])
    assert rows_of(rows, "zip", "name") == [("007", "Rome, IT"), (None, "Oslo")]


CONFIG = {
    "ingestion": {"batch_size": 10, "max_rows_per_file": 100, "watermark_lag_seconds": 30, "api": {"page_size": 5}},
    "sources": {
        "postgres": {"tables": {"orders": {"primary_key": "order_id", "watermark_column": "updated_at"}}},
        "api": {"exchange_rates": {"watermark_field": "updated_at", "primary_key": ["rate_date", "quote_currency"]}},
        "files": {"countries": {"directory": "countries", "pattern": "*.csv", "format": "csv", "required_columns": ["iso3"]}},
    },
}


def test_config():
    config = specs.load_config(CONFIG)
    assert config.spec("orders") == specs.DatasetSpec("postgres", "orders", "jsonl", "updated_at", ("order_id",))
    assert config.spec("countries", "files").required_columns == ("iso3",)
    assert config.datasets["exchange_rates"].primary_key == ("rate_date", "quote_currency")
    for name, source in (("nope", None), ("orders", "kafka"), ("orders", "files")):
        with pytest.raises(specs.ConfigurationError):
            config.spec(name, source)


@pytest.mark.parametrize("path, value", [
    (("ingestion", "batch_size"), 0), (("sources", "files", "countries", "format"), "xml"),
    (("sources", "postgres", "tables", "orders"), {"primary_key": "order_id"}), (("ingestion", "api"), None), (("sources", "files"), None),
])
def test_bad_config(path, value):
    import copy

    raw = copy.deepcopy(CONFIG)
    at = raw
    for step in path[:-1]:
        at = at[step]
    at[path[-1]] = value
    with pytest.raises(specs.ConfigurationError):
        specs.load_config(raw)


def test_jdbc_window():
    upper, since = datetime(2025, 1, 2, tzinfo=timezone.utc), datetime(2025, 1, 1, tzinfo=timezone.utc)
    query = jdbc.window_query("sales", "or\"ders", "updated_at", since, upper)
    assert query == ('SELECT * FROM "sales"."or""ders" WHERE "updated_at" <= TIMESTAMPTZ \'2025-01-02T00:00:00+00:00\' '
                     'AND "updated_at" > TIMESTAMPTZ \'2025-01-01T00:00:00+00:00\'')
    assert " AND " not in jdbc.window_query("sales", "orders", "updated_at", None, upper)
    options = jdbc.jdbc_options(jdbc.jdbc_url("db", 5432, "shop"), query, 500, ("order_id", 1, 1000, 8))
    assert options["dbtable"] == f"({query}) AS src" and options["numPartitions"] == "8" and options["fetchsize"] == "500"


def test_edge_order(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1)], "w int, k int")
    assert [tuple(r) for r in jdbc.edge_order(df, "w", ["k"]).collect()] == [(1, 1), (1, 2), (2, 1)]


def test_layout():
    lake = Lake("s3a://bucket/prefix/")
    assert lake.table_path("silver", "orders") == "s3a://bucket/prefix/silver/orders"
    for layer, table in (("silver", ""), ("silver", "a/b"), ("copper", "orders")):
        with pytest.raises(ValueError):
            lake.table_path(layer, table)


def test_export_by_month(spark, tmp_path):
    df = spark.createDataFrame([("r1", datetime(2025, 1, 31)), ("r2", datetime(2025, 2, 1))], "review_id string, review_date timestamp")
    files.export_by_month(df, "review_date", str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("month=*")) == ["month=2025-01", "month=2025-02"]


def test_page_index_reads_any_page_without_sorting_again(spark, tmp_path):
    # a third of the rows share one value, and some rows are repeated whole
    rows = [(k if k % 3 else 0, f"r{k % 250}") for k in range(1000)] + [(None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "k bigint, v string")
    index = pages.PageIndex.build(df, ["k", "v"], str(tmp_path / "index"), parts=7)
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert index.total == len(rows) and len([n for n in index.counts if n]) > 4
    found = sorted((r.place, r.page, (r.k, r.v)) for r in index.paged(64).collect())
    assert [f[0] for f in found] == list(range(len(rows))) and [f[2] for f in found] == expected
    for page in (1, 2, 9, 16):
        got = index.page(page, 64)
        assert sorted(((r.k, r.v) for r in got.collect()), key=repr) == sorted(expected[64 * page - 64 : 64 * page], key=repr)
        assert "Sort" not in got._jdf.queryExecution().executedPlan().toString()
        assert {r.has_more for r in got.collect()} == {page < 16} and {r.total for r in got.collect()} == {1002}
    assert index.page(17, 64).count() == 0
    assert re.search(r"PartitionFilters: \[[^]]*_range#\d+ = 0\)", index.page(1, 64)._jdf.queryExecution().executedPlan().toString())


def test_page_index_of_nothing_and_of_clashing_names(spark, tmp_path):
    empty = pages.PageIndex.build(spark.createDataFrame([], "k bigint"), ["k"], str(tmp_path / "empty"), parts=3)
    assert empty.total == 0 and empty.page(1, 10).count() == 0 and empty.paged(10).count() == 0
    with pytest.raises(ValueError, match="index's own"):
        pages.PageIndex.build(spark.createDataFrame([(1,)], "_range bigint"), ["_range"], str(tmp_path / "clash"))
    with pytest.raises(ValueError, match="start at 1"):
        empty.page(0, 10)


def test_json_files_are_read_by_several_tasks_and_as_they_are_written(spark, tmp_path):
    """Columns are found out without one task that reads all files, and a number's text is kept to the digit."""
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(40):
        (folder / f"f{i}.json").write_text('[\n {"a": 1.10, "b": "x"},\n {"a": 12345678901234567890.50, "c": {"d": [1, 2.0]}}]\n')
    group = f"json-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "columns")
    rows = files.read_text_rows(spark, [str(folder)], "json")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages) > 1
    assert {(r.a, r.b) for r in rows.select("a", "b").collect()} == {("1.10", "x"), ("12345678901234567890.50", None)}
    assert rows.count() == 80


def test_json_verdicts_list_many_files_in_few_tasks(spark, tmp_path):
    for k in range(100):
        (tmp_path / f"{k:03}.json").write_bytes(b"\xff[{}]" if k == 7 else b'[{"a": 1}, {"a": 2}]')
    inspected = files.inspect_files(spark, str(tmp_path), "*.json")
    spark.sparkContext.setJobGroup("verdicts", "")
    try:
        judged = files.file_verdicts(inspected, "json").collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [(r.record_count, r.reason) for r in sorted(judged, key=lambda r: r.file_name)] == [(None, "not valid UTF-8") if k == 7 else (2, None) for k in range(100)]
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("verdicts") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 64


def test_paths_without_escapes_are_not_decoded(spark):
    """A row's path is decoded for every row, which took longer than reading the row."""
    paths = ["/a/b.json", "/a%20b/c+d.json", "/a+b/c", "/%25/%2B", "", None]
    found = spark.createDataFrame([(p,) for p in paths], "p string").select(text.decoded(F.col("p")).alias("d"))
    assert [r.d for r in found.collect()] == ["/a/b.json", "/a b/c+d.json", "/a+b/c", "/%/+", "", None]
    assert "CASE WHEN contains(" in found._jdf.queryExecution().optimizedPlan().toString().replace("Contains(", "contains(")
