"""Queries that go through files, tables on disk and streams, over the whole given tables.

Each run works in a folder of its own under ``spark.checkpoint.dir`` (shared on a cluster), or, where the
session names none, under its warehouse. Results are read from there lazily, so who runs a query
removes the folders.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queries.commerce import Commerce
from queries.registry import query
from stratalake.plans import bronze, daily, gold, gold_months, ingest, silver
from stratalake.plans.state import State
from stratalake.session import scratch_dir
from stratalake.sources import csv_splits, files, fs, landing, pages
from stratalake.sources import lake as tables
from stratalake.sources.lake import Lake
from stratalake.sources.specs import TYPED_SPECS, DatasetSpec, TypedSpec
from stratalake.streaming import microbatch

#: Rows of a CSV file that csv_verdicts writes.
CSV_ROWS = 50_000


def _scratch(c: Commerce) -> str:
    return f"{scratch_dir(c.spark).rstrip('/')}/stratalake-{uuid.uuid4().hex}"


def _spec(dataset: str, kind: str = "jsonl", source: str = "postgres", **more) -> DatasetSpec:
    return DatasetSpec(source, dataset, kind, **more)


def _extra() -> dict:
    return {"run_id": "load", "pipeline_name": "ingestion", "mode": "full_refresh", "extracted_at": "2024-02-01T00:00:00+00:00"}


def _items(c: Commerce) -> DataFrame:
    """Order lines whose update times tell all copies of a line apart."""
    return c.raw("lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as order_item_id", "l_orderkey as order_id", "l_partkey as product_id",
        "cast(l_quantity as int) as quantity", "cast(l_extendedprice as decimal(12,2)) as unit_price",
        "cast(cast(round(l_discount * 100) as int) as decimal(5,2)) as discount_pct",
        "timestamp_micros(unix_micros(cast(l_shipdate as timestamp)) + cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint)) as updated_at")


def _land_and_load(c: Commerce, lake: Lake) -> None:
    orders = c.orders().withColumn("updated_at", F.col("order_date"))
    tables = {
        "orders": orders, "order_items": _items(c),
        "products": c.products().withColumn("updated_at", F.lit("2024-01-01").cast("timestamp")),
        "exchange_rates": c.rates().withColumn("updated_at", F.col("rate_date").cast("timestamp")),
    }
    for name, rows in tables.items():
        spec = _spec(name)
        landing.land_rows(rows, lake.landing, spec, "20240201T000000Z-00000001", 100_000, _extra())
        bronze.load_bronze(c.spark, lake, spec)
        silver.load_silver(c.spark, lake, name)


@query("full_medallion_kpi", """
    select year(o.order_date)::int as year, month(o.order_date)::int as month, shipping_country, category,
      count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers,
      cast(sum(quantity) as bigint) as total_items_sold,
      cast(sum(cast(cast(cast(quantity * i.unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as decimal(24,6))
        * case when o.currency = 'USD' then cast(1 as decimal(12,6)) else coalesce(rate_to_usd, cast(1 as decimal(12,6))) end as decimal(14,2))) as decimal(16,2)) as total_revenue_usd
    from (select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
            cast(l_extendedprice as decimal(12,2)) as unit_price,
            cast(cast(round(l_discount * 100) as int) as decimal(5,2)) as discount_pct from lineitem
          qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_extendedprice desc) = 1) i
    join (select * from shop_orders where status in ('pending', 'paid', 'shipped', 'delivered', 'cancelled', 'returned')) o using (order_id)
    left join rates on rate_date = cast(o.order_date as date) and quote_currency = o.currency
    left join (select product_id, category from products where unit_price >= 0 and unit_cost >= 0) p using (product_id)
    group by 1, 2, 3, 4""", "shop_orders rates products")
def full_medallion_kpi(c: Commerce) -> DataFrame:
    """Landed files, bronze, silver with quarantine and upsert, gold: the KPIs at the end."""
    lake = Lake(_scratch(c), buckets=8)
    _land_and_load(c, lake)
    gold.build_gold(c.spark, lake)
    return gold.gold_table(c.spark, lake, "kpi_monthly_sales").drop("updated_at")


_EVENT_ROWS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _kinds(c: Commerce) -> list[str]:
    """The event types there are; rows without one are of type ``none``."""
    return [r.kind for r in c.raw("events").select(F.coalesce("event_type", F.lit("none")).alias("kind")).distinct().orderBy("kind").collect()]


def _land_events(c: Commerce, lake: Lake, dataset: str = "events", limit_rows: int = 100_000) -> DatasetSpec:
    """Events as landed batches, one per type."""
    spec = _spec(dataset)
    for kind in _kinds(c):
        rows = c.raw("events").filter(F.coalesce("event_type", F.lit("none")) == kind).select(*_EVENT_ROWS)
        landing.land_rows(rows, lake.landing, spec, f"b-{kind}", limit_rows, _extra())
    return spec


@query("checksum_verify", """
    select 'b-' || event_type as batch_id, count(*) as record_count, true as files_ok, true as rotated from events group by 1""")
def checksum_verify(c: Commerce) -> DataFrame:
    """Landed batches against their manifests; parts hold at most 10,000 rows."""
    lake = Lake(_scratch(c))
    spec = _land_events(c, lake, limit_rows=10_000)
    manifests = landing.landed_batches(c.spark, lake.landing, spec)
    folders = [landing.batch_path(lake.landing, spec, f"b-{k}") for k in _kinds(c)]
    verdicts = landing.checksum_report(c.spark, folders).groupBy("batch_id").agg(
        F.bool_and(F.col("verdict") == "ok").alias("files_ok"))
    rotated = landing.listed_files(c.spark, folders).groupBy("batch_id").agg((F.max("rows") <= 10_000).alias("rotated"))
    return manifests.select("batch_id", "record_count").join(rotated, "batch_id").join(verdicts, "batch_id")


@query("bronze_rows", """
    select cast(event_id as varchar) as event_id, event_type, props, cast(user_id as varchar) as user_id, cast(value as varchar) as value,
      case when microsecond(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') end as ts, 'postgres' as source_system,
      'b-' || event_type as batch_id, timestamp '2024-02-01' as ingestion_timestamp, cast(null as varchar) as file_name, 'load' as run_id
    from events""")
def bronze_rows(c: Commerce) -> DataFrame:
    """Landed rows as bronze keeps them: text and lineage. Loading again changes nothing."""
    lake = Lake(_scratch(c))
    spec = _land_events(c, lake)
    bronze.load_bronze(c.spark, lake, spec)
    bronze.load_bronze(c.spark, lake, spec)
    return bronze.bronze_table(c.spark, lake, spec.dataset)


@query("bronze_checks", """
    select 'events' as dataset, c as "check", true as passed from (values ('table_exists'), ('all_batches_loaded'),
      ('row_counts_match_manifest'), ('lineage_columns_populated'), ('source_system_consistent')) v(c)
    where (select count(*) from events) > 0""")
def bronze_checks(c: Commerce) -> DataFrame:
    lake = Lake(_scratch(c))
    spec = _land_events(c, lake)
    bronze.load_bronze(c.spark, lake, spec)
    return bronze.bronze_checks(c.spark, lake, spec).drop("detail")


@query("bronze_checks_after_loss", """
    select 'events' as dataset, c as "check", c in ('table_exists', 'source_system_consistent') as passed, d as detail
    from (select count(*) filter (where event_type = 'click' and value >= 20) as nulls from events),
      lateral (values ('table_exists', null), ('all_batches_loaded', '4/5 landed batches present; missing b-view'),
        ('row_counts_match_manifest', 'mismatches: b-click'), ('source_system_consistent', '0 rows with source_system other than ''postgres'''),
        ('lineage_columns_populated', 'nulls: ingestion_timestamp ' || nulls || ', source_system 0, batch_id 0')) v(c, d)""")
def bronze_checks_after_loss(c: Commerce) -> DataFrame:
    """A table without one batch, with rows lost from another and lineage blanked in it."""
    root = _scratch(c)
    lake = Lake(f"{root}/lake")
    spec = _land_events(c, lake)
    bronze.load_bronze(c.spark, lake, spec)
    path = lake.table_path("bronze", spec.dataset)
    fs.delete(c.spark, f"{path}/batch_id=b-view")
    clicks = bronze.bronze_table(c.spark, lake, spec.dataset).filter("batch_id = 'b-click' and cast(value as double) >= 20")
    clicks.withColumn("ingestion_timestamp", F.lit(None).cast("timestamp")).write.parquet(f"{root}/damaged")
    tables.write_batches(c.spark.read.parquet(f"{root}/damaged"), path)
    where = F.when(F.col("check") != "table_exists", F.col("detail"))
    return bronze.bronze_checks(c.spark, lake, spec).withColumn("detail", where)


@query("csv_files_to_bronze", """
    select cast(p_partkey as varchar) as p_partkey, p_name || ', "' || p_brand || '"' as label, 'files' as source_system, true as has_file
    from part""")
def csv_files_to_bronze(c: Commerce) -> DataFrame:
    """Parts written as quoted CSV files, judged, landed unchanged and loaded as text."""
    root = _scratch(c)
    lake = Lake(f"{root}/lake")
    labels = c.raw("part").selectExpr("p_partkey", "concat(p_name, ', \"', p_brand, '\"') as label")
    labels.write.options(header=True, escape='"').csv(f"{root}/raw/parts")
    spec = _spec("parts", "csv", "files", directory="parts", pattern="*.csv", required_columns=("p_partkey", "label"))
    state = State(c.spark, lake)
    ingest.ingest_files(c.spark, lake, state, spec, f"{root}/raw")
    ingest.ingest_files(c.spark, lake, state, spec, f"{root}/raw")
    bronze.load_bronze(c.spark, lake, spec)
    table = bronze.bronze_table(c.spark, lake, "parts")
    return table.select("p_partkey", "label", "source_system", F.col("file_name").isNotNull().alias("has_file"))


@query("json_files_to_bronze", """
    select k, count(*) as n from (select json_extract_string(props, '$.k') as k from events) group by 1""")
def json_files_to_bronze(c: Commerce) -> DataFrame:
    """Event properties as JSON-array files of at most 500 records, through judging and landing."""
    root = _scratch(c)
    lake = Lake(f"{root}/lake")
    arrays = c.raw("events").groupBy(F.expr("event_id div 500").alias("page")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("props"), ","), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/raw/props")
    spec = _spec("props", "json", "files", directory="props", pattern="*.txt")
    ingest.ingest_files(c.spark, lake, State(c.spark, lake), spec, f"{root}/raw")
    bronze.load_bronze(c.spark, lake, spec)
    return bronze.bronze_table(c.spark, lake, "props").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("csv_verdicts", """
    select kind, case kind when 'good' then n end as record_count, case kind when 'short row' then '1 row(s) with a field count other than 2'
        when 'no column' then 'missing required columns: [''label'']' when 'empty' then 'file is empty or has no header' end as reason
    from (select count(*) as n from part), (values ('good'), ('short row'), ('no column'), ('empty'), ('broken header')) k(kind)
    where kind <> 'broken header' union all select 'broken header', count(*), null from part""")
def csv_verdicts(c: Commerce) -> DataFrame:
    """Parts as CSV files of bounded size, one of them changed per way to be right or wrong; a line break inside a quoted header is right.

    A kind counts its rows if all of its files are right.
    """
    root = _scratch(c)
    kinds = {"good": lambda t: t, "short row": lambda t: t + "7\n", "no column": lambda t: t.replace("label", "name", 1), "empty": lambda t: "",
             "broken header": lambda t: t.replace("\n", ",\n").replace("label,", 'label,"no\nte"', 1)}
    found = []
    for kind, change in kinds.items():
        folder = f"{root}/{kind}"
        parts = c.raw("part").select("p_partkey", F.col("p_name").alias("label"))
        parts.write.options(header=True, escape='"', maxRecordsPerFile=CSV_ROWS).csv(folder)
        path = next(p for p, _, size in fs.glob(c.spark, f"{folder}/*.csv") if size)
        if kind != "good":
            # at most CSV_ROWS rows
            fs.write_text(c.spark, path, change(c.spark.read.text(path, wholetext=True).first().value))
        verdicts = files.file_verdicts(files.inspect_files(c.spark, folder, "*.csv"), "csv", ("p_partkey", "label"))
        count = F.when(F.count("reason") == 0, F.sum("record_count")).alias("record_count")
        found.append(verdicts.agg(count, F.max("reason").alias("reason")).select(F.lit(kind).alias("kind"), "record_count", "reason"))
    return tables.union_all(found)


@query("csv_split_verdicts", """
    select * from (values ('lacks', null, 'missing required columns: [''props'']'), ('never closed', null, '1 row(s) with a field count other than 3'),
        ('no header', null, 'file is empty or has no header'), ('short', null, '1 row(s) with a field count other than 3'), ('two lines', 1, null)) k(kind, record_count, reason)
    union all select 'events', count(*), null from events""")
def csv_split_verdicts(c: Commerce) -> DataFrame:
    """Events as CSV files with quotes, commas and line breaks in their fields, and a few small files wrong in a way of their own; judged by splits."""
    folder = f"{_scratch(c)}/events"
    note = F.concat_ws("\n", F.col("event_type"), F.col("user_id").cast("string"))
    c.raw("events").select("event_id", "props", note.alias("note")).write.options(header=True, escape='"').csv(folder)
    head = "event_id,props,note\n"
    for kind, text in (("lacks", "event_id,note\n1,2\n"), ("never closed", head + '1,"x\n2,3,4\n'), ("no header", "\n1,2,3\n"),
                       ("short", head + "1,2,3\n1,2\n"), ("two lines", head + '1,2,"a\nb"\n')):
        fs.write_text(c.spark, f"{folder}/{kind}.csv", text)
    judged = csv_splits.csv_verdicts(c.spark, folder, "*.csv", ("event_id", "props", "note"))
    kind = F.when(F.col("file_name").startswith("part-"), "events").otherwise(F.replace("file_name", F.lit(".csv"), F.lit("")))
    count = F.when(F.count("reason") == 0, F.sum("record_count")).alias("record_count")
    return judged.groupBy(kind.alias("kind")).agg(count, F.max("reason").alias("reason"))


#: Events of a JSON file that json_verdicts writes.
JSON_ROWS = 2_000


@query("json_verdicts", """
    select kind, case kind when 'good' then n end as record_count, case kind when 'two arrays' then 'malformed JSON' when 'object' then 'top level must be a JSON array of records'
        when 'cut' then 'malformed JSON' when 'numbers' then 'malformed JSON or an element that is not an object' when 'empty' then 'malformed JSON' end as reason
    from (select count(*) as n from events), (values ('good'), ('two arrays'), ('object'), ('cut'), ('numbers'), ('empty')) k(kind)""")
def json_verdicts(c: Commerce) -> DataFrame:
    """Events as files of one JSON array each, the first of them changed per way to be right or wrong; a kind counts its rows if all files are right."""
    root = _scratch(c)
    row = F.to_json(F.struct("event_id", "event_type", "props"))
    body = c.raw("events").groupBy(F.expr(f"event_id div {JSON_ROWS}").alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(row), ","), F.lit("]")).alias("rows"))
    body.write.parquet(f"{root}/body")  # gathered once, not once a kind
    body = c.spark.read.parquet(f"{root}/body")
    texts = {"good": "rows", "two arrays": "concat(rows, rows)", "object": "concat('{\"a\":', rows, '}')", "cut": "substr(rows, 1, length(rows) - 3)",
             "numbers": "concat(substr(rows, 1, length(rows) - 1), ',1]')", "empty": "''"}
    found = []
    for kind, text in texts.items():
        changed = body.selectExpr(f"if(file = 0, {text}, rows) as value")
        changed.write.option("maxRecordsPerFile", 1).text(f"{root}/{kind}")
        verdicts = files.file_verdicts(files.inspect_files(c.spark, f"{root}/{kind}", "*.txt"), "json")
        count = F.when(F.count("reason") == 0, F.sum("record_count")).alias("record_count")
        found.append(verdicts.agg(count, F.max("reason").alias("reason")).select(F.lit(kind).alias("kind"), "record_count", "reason"))
    return tables.union_all(found)


@query("file_ledger", """
    select cast(count(*) as bigint) as record_count, true as all_known from part""")
def file_ledger(c: Commerce) -> DataFrame:
    """Files recorded as processed, and whether a second look finds any of them new."""
    root = _scratch(c)
    lake = Lake(f"{root}/lake")
    c.raw("part").select("p_partkey", "p_name").write.option("header", True).csv(f"{root}/raw/parts")
    spec = _spec("parts", "csv", "files", directory="parts", pattern="*.csv", required_columns=("p_partkey",))
    state = State(c.spark, lake)
    ingest.ingest_files(c.spark, lake, state, spec, f"{root}/raw")
    known = state.processed_files("files", "parts")
    fresh = files.new_files(files.inspect_files(c.spark, f"{root}/raw/parts", "*.csv"), known)
    return known.agg(F.sum("record_count").alias("record_count")).withColumn("all_known", F.lit(fresh.isEmpty()))


_SILVER_PAYMENTS = """(select payment_id, order_id, payment_status, amount, concat_ws('; ',
        case when amount < 0 then 'Negative payment amount' end,
        case when payment_status not in ('pending', 'completed', 'failed', 'refunded') then 'Invalid payment status' end,
        case when payment_status = 'completed' and paid_at is null then 'Completed payment without paid_at' end,
        case when payment_method not in ('card', 'paypal', 'bank_transfer', 'apple_pay', 'gift_card') then 'Invalid payment method' end) as reason
      from payments)"""


def _load_payments(c: Commerce) -> Lake:
    """Payments as two batches, the second repeating the completed ones of the first."""
    lake = Lake(_scratch(c), buckets=8)
    spec = _spec("payments")
    rows = c.payments().withColumn("updated_at", F.col("created_at"))
    for batch_id, part in (("b1", rows), ("b2", rows.filter("payment_status = 'completed'"))):
        landing.land_rows(part, lake.landing, spec, batch_id, 100_000, _extra())
        bronze.load_bronze(c.spark, lake, spec)
        silver.load_silver(c.spark, lake, "payments", with_source_rules=True)
    return lake


@query("silver_payments", f"select payment_id, order_id, payment_status, amount from {_SILVER_PAYMENTS} where reason = ''", "payments")
def silver_payments(c: Commerce) -> DataFrame:
    table = silver.silver_table(c.spark, _load_payments(c), "payments")
    return table.select("payment_id", "order_id", "payment_status", "amount")


@query("silver_quarantine", f"""
    select payment_id, reason as quarantine_reason, batch_id from {_SILVER_PAYMENTS}, (values ('b1'), ('b2')) b(batch_id)
    where reason <> '' and (batch_id = 'b1' or payment_status = 'completed')""", "payments")
def silver_quarantine(c: Commerce) -> DataFrame:
    return silver.quarantine_table(c.spark, _load_payments(c), "payments").select("payment_id", "quarantine_reason", "batch_id")


@query("stream_silver_payments", f"select payment_id, order_id, payment_status, amount from {_SILVER_PAYMENTS} where reason = ''", "payments")
def stream_silver_payments(c: Commerce) -> DataFrame:
    """Landed payments through a bronze and a silver stream: typed, judged, upserted; a second run changes nothing."""
    root = _scratch(c)
    lake, spec = Lake(f"{root}/lake", buckets=8), _spec("payments")
    landing.land_rows(c.payments().withColumn("updated_at", F.col("created_at")), lake.landing, spec, "b1", 100_000, _extra())
    for _ in range(2):
        microbatch.bronze_stream(c.spark, lake, spec, f"{root}/bronze").awaitTermination()
        microbatch.silver_stream(c.spark, lake, "payments", f"{root}/silver", with_source_rules=True).awaitTermination()
    table = silver.silver_table(c.spark, lake, "payments")
    return table.select("payment_id", "order_id", "payment_status", "amount")


_SECOND = "(select count(*) from events where event_id % 3 = 1)"


@query("bronze_refusals", f"""
    select kind, batch, status, fault from (values
      ('count', 'b-1', 'success', null), ('count', 'b-2', 'failed', '[b-2] read ' || {_SECOND} || ' rows but the manifest says ' || ({_SECOND} + 1)),
      ('lineage', 'b-1', 'success', null), ('lineage', 'b-2', 'failed', '[b-2] source columns collide with lineage columns: [''run_id'']'),
      ('tampered', 'b-1', 'success', null), ('tampered', 'b-2', 'failed', 'checksum mismatch'),
      ('missing', 'b-1', 'success', null), ('missing', 'b-2', 'failed', 'landed file missing')) v(kind, batch, status, fault)""")
def bronze_refusals(c: Commerce) -> DataFrame:
    """Events landed in three batches: loading stops at the second one, and the third waits."""
    out = []
    for kind in ("count", "lineage", "tampered", "missing"):
        lake = Lake(_scratch(c))
        state, spec = State(c.spark, lake), _spec("events")
        for third, batch in enumerate(("b-1", "b-2", "b-3")):
            rows = c.raw("events").select(*_EVENT_ROWS).filter(F.col("event_id") % 3 == third)
            clash = kind == "lineage" and batch == "b-2"
            landing.land_rows(rows.withColumn("run_id", F.lit("own")) if clash else rows, lake.landing, spec, batch, 100_000, _extra())
        folder = landing.batch_path(lake.landing, spec, "b-2")
        part = next(p for p, name, size in fs.glob(c.spark, f"{folder}/files/part-*") if size)
        if kind == "count":
            text = c.spark.read.text(f"{folder}/manifest.json", wholetext=True).first().value
            fs.write_text(c.spark, f"{folder}/manifest.json", json.dumps({**json.loads(text), "record_count": json.loads(text)["record_count"] + 1}))
        elif kind == "tampered":
            fs.write_text(c.spark, part, "{}")
        elif kind == "missing":
            fs.delete(c.spark, part)
        try:
            bronze.load_bronze(c.spark, lake, spec, state)
        except bronze.BronzeLoadError:
            pass
        fault = F.when(F.col("error_message").contains("checksum mismatch"), "checksum mismatch").when(
            F.col("error_message").contains("landed file missing"), "landed file missing").otherwise(F.col("error_message"))
        out.append(state.runs().select(F.lit(kind).alias("kind"), F.col("batch_id").alias("batch"), "status", fault.alias("fault")))
    return tables.union_all(out)


@query("reviews_by_month", """
    select strftime(review_date, '%Y-%m') as month, count(*) as n, count(distinct review_id) as ids from reviews group by 1""", "reviews")
def reviews_by_month(c: Commerce) -> DataFrame:
    """Reviews exported as monthly JSON and read back."""
    path = f"{_scratch(c)}/reviews"
    files.export_by_month(c.reviews(), "review_date", path)
    back = c.spark.read.schema("review_id string, event_id bigint, month string").json(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("review_id").alias("ids"))


@query("ingest_two_windows", """
    select 'b1' as run, count(*) as "rows" from events where ts <= timestamp '2024-01-10'
    union all select 'b2', count(*) from events where ts > timestamp '2024-01-10' and ts <= timestamp '2024-01-31'
    union all select 'bronze', count(*) from events where ts <= timestamp '2024-01-31'""")
def ingest_two_windows(c: Commerce) -> DataFrame:
    """Two incremental runs, the second from the watermark the first left."""
    lake = Lake(_scratch(c))
    state = State(c.spark, lake)
    spec = _spec("events", watermark_col="ts", primary_key=("event_id",))
    runs = []
    for name, now in (("b1", datetime(2024, 1, 10, tzinfo=timezone.utc)), ("b2", datetime(2024, 1, 31, tzinfo=timezone.utc))):
        done = ingest.ingest_table(c.spark, lake, state, spec, c.raw("events"), now=now, max_rows_per_file=1_000_000)
        runs.append((name, done.records))
    bronze.load_bronze(c.spark, lake, spec, state)
    landed = c.spark.createDataFrame(runs, "run string, rows bigint")
    loaded = bronze.bronze_table(c.spark, lake, "events").agg(F.lit("bronze").alias("run"), F.count(F.lit(1)).alias("rows"))
    return landed.unionByName(loaded)


@query("stream_bronze", "select 'b-' || event_type as batch_id, count(*) as n from events group by 1")
def stream_bronze(c: Commerce) -> DataFrame:
    """Landed batches followed by an available-now stream; a second run finds nothing new."""
    root = _scratch(c)
    lake = Lake(f"{root}/lake")
    spec = _land_events(c, lake)
    for _ in range(2):
        microbatch.bronze_stream(c.spark, lake, spec, f"{root}/checkpoint").awaitTermination()
    return bronze.bronze_table(c.spark, lake, spec.dataset).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("stream_silver_upsert", """
    select user_id, event_id, ts, event_type, value, props from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def stream_silver_upsert(c: Commerce) -> DataFrame:
    """Newest event per user, kept by micro-batches over files."""
    root = _scratch(c)
    c.raw("events").write.option("maxRecordsPerFile", 1_000_000).parquet(f"{root}/arrivals")
    stream = c.spark.readStream.schema(c.raw("events").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arrivals")
    lake, spec = Lake(f"{root}/lake", buckets=8), TypedSpec("newest_events", ("user_id",), "ts", "user_id bigint")
    microbatch.upsert_stream(c.spark, lake, stream, spec, f"{root}/checkpoint", ("event_id",)).awaitTermination()
    return silver.silver_table(c.spark, lake, spec.dataset)


# ------------------------------------------------------------- gold by touched months

#: Days before the last order's within which orders and their lines change between two loads.
CHANGED_DAYS = 75


def _silver(c: Commerce, lake: Lake, dataset: str, rows: DataFrame, load: int) -> None:
    spec = TYPED_SPECS[dataset]
    typed = {f.name: f.dataType for f in spec.schema.fields}
    own = F.col("updated_at") if "updated_at" in rows.columns else F.timestamp_seconds(F.lit(0))
    # Days, not years: a century on, 29 February 2000 would be 28 February and no longer newer than that day.
    full = rows.withColumn("updated_at", own + F.make_dt_interval(days=F.lit(36_525 * load)))
    silver.upsert_rows(c.spark, lake, spec, full.select(*[F.col(n).cast(typed[n]) for n in full.columns]), f"load-{load}")


def _recent(orders: DataFrame) -> Column:
    """Orders that change: a quarter of those of the last ``CHANGED_DAYS`` days."""
    last = orders.agg(F.max("order_date")).scalar()
    return (F.col("order_date") >= F.date_sub(last.cast("date"), CHANGED_DAYS).cast("timestamp")) & (F.col("order_id") % 4 == 0)


def _two_gold_loads(c: Commerce) -> tuple[Lake, DataFrame]:
    """Silver twice, gold after each: recent orders are late, or cancelled and moved, and their second lines grow."""
    lake = Lake(_scratch(c), buckets=4)
    orders = c.orders()
    recent = _recent(orders)
    late = recent & (F.col("order_id") % 8 == 0)
    _silver(c, lake, "orders", orders.filter(~late), 1)
    _silver(c, lake, "order_items", _items(c), 1)
    _silver(c, lake, "products", c.products(), 1)
    _silver(c, lake, "exchange_rates", c.rates(), 1)
    gold_months.build_months(c.spark, lake)
    moved = orders.filter(recent & ~late).withColumns({"status": F.lit("cancelled"), "order_date": F.col("order_date") - F.expr("interval 40 days")})
    _silver(c, lake, "orders", moved.unionByName(orders.filter(late)), 2)
    grown = _items(c).filter("order_item_id % 10 = 2").join(orders.filter(recent).select("order_id"), "order_id", "left_semi")
    _silver(c, lake, "order_items", grown.withColumn("quantity", F.col("quantity") + 1), 2)
    return lake, gold_months.build_months(c.spark, lake)


_LINES = """lines as (select l_orderkey * 10 + l_linenumber as order_item_id, l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
      cast(l_extendedprice as decimal(12,2)) as unit_price, cast(cast(round(l_discount * 100) as int) as decimal(5,2)) as discount_pct from lineitem
      qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_extendedprice desc) = 1)"""

_CHANGED_FACT = f"""
    {_LINES},
    marks as (select max(order_date) as last from shop_orders),
    chosen as (select o.*, order_date >= cast(last as date) - {CHANGED_DAYS} and order_id % 4 = 0 as recent from shop_orders o, marks),
    orders2 as (select order_id, customer_id, currency, shipping_country, recent, order_date as first_date,
        case when recent and order_id % 8 <> 0 then order_date - interval 40 day else order_date end as order_date from chosen),
    lines2 as (select i.* replace (case when recent and order_item_id % 10 = 2 then quantity + 1 else quantity end as quantity) from lines i join orders2 using (order_id)),
    fact2 as (select o.*, i.product_id, i.quantity, i.order_item_id,
        cast(cast(cast(quantity * unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as decimal(24,6))
          * case when currency = 'USD' then cast(1 as decimal(12,6)) else coalesce(rate_to_usd, cast(1 as decimal(12,6))) end as decimal(14,2)) as usd
      from lines2 i join orders2 o using (order_id) left join rates on rate_date = cast(order_date as date) and quote_currency = currency)"""


@query("gold_increment", f"""
    , {_CHANGED_FACT.strip()},
    touched as (select distinct year(d) * 100 + month(d) as m from (select unnest([first_date, order_date]) as d from orders2 where recent))
    select cast(year(order_date) as int) as year, cast(month(order_date) as int) as month, shipping_country, category, count(distinct order_id) as total_orders,
      count(distinct customer_id) as unique_customers, cast(sum(quantity) as bigint) as total_items_sold, cast(sum(usd) as decimal(16,2)) as total_revenue_usd,
      year(order_date) * 100 + month(order_date) in (select m from touched) as made_anew
    from fact2 left join products using (product_id) group by all""", "shop_orders rates products")
def gold_increment(c: Commerce) -> DataFrame:
    """KPIs after two loads, and whether the second one made their month anew."""
    lake, anew = _two_gold_loads(c)
    anew = anew.filter(F.col("table_name") == gold_months.KPI).select(F.col("month").alias("order_month"), F.lit(True).alias("anew"))
    kpi = gold_months.kpi_by_month(c.spark, lake).drop("updated_at").withColumn("order_month", F.col("year") * 100 + F.col("month"))
    return kpi.join(anew, "order_month", "left").withColumn("made_anew", F.coalesce("anew", F.lit(False))).drop("anew", "order_month")


@query("fx_restated_fact", f"""
    , {_LINES},
    last as (select cast(max(order_date) as date) as day from shop_orders),
    final as (select rate_date, quote_currency, cast(case
        when rate_date > day - 20 then rate_to_usd * 3 when rate_date > day - 50 and quote_currency < 'K' then rate_to_usd * 2 else rate_to_usd end as decimal(18,10)) as rate
      from rates, last)
    select order_id || '_' || order_item_id as sales_fact_key, cast(strftime(order_date, '%Y%m%d') as int) as order_date_key, currency,
      cast(case when currency = 'USD' then 1 else coalesce(rate, 1) end as decimal(12,6)) as exchange_rate_to_usd,
      cast(cast(cast(quantity * unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as decimal(20,4))
        * case when currency = 'USD' then cast(1 as decimal(12,6)) else coalesce(cast(rate as decimal(12,6)), cast(1 as decimal(12,6))) end as decimal(14,2)) as line_total_usd
    from lines join shop_orders using (order_id) left join final on rate_date = cast(order_date as date) and quote_currency = currency""", "shop_orders rates")
def fx_restated_fact(c: Commerce) -> DataFrame:
    """The fact after rates of the last weeks were restated once and, of the last days, once more; gold follows each time."""
    lake = Lake(_scratch(c), buckets=4)
    orders = c.orders()
    _silver(c, lake, "orders", orders, 1)
    _silver(c, lake, "order_items", _items(c), 1)
    last = orders.agg(F.max("order_date").cast("date")).scalar()
    for load, days, times in ((1, None, 1), (2, 50, 2), (3, 20, 3)):
        rates = c.rates()
        if days:
            rates = rates.filter((F.col("rate_date") > F.date_sub(last, days)) & ((F.col("quote_currency") < "K") | F.lit(load == 3)))
        _silver(c, lake, "exchange_rates", rates.withColumn("rate_to_usd", F.col("rate_to_usd") * times), load)
        gold_months.build_months(c.spark, lake)
    return gold_months.fact_by_month(c.spark, lake).select("sales_fact_key", "order_date_key", "currency", "exchange_rate_to_usd", "line_total_usd")


@query("daily_chain", f"""
    , {_LINES},
    parts as (select * from products where unit_price >= 0 and unit_cost >= 0),
    sold as (select * from shop_orders where status in ('pending', 'paid', 'shipped', 'delivered', 'cancelled', 'returned'))
    select cast(year(order_date) as int) as year, cast(month(order_date) as int) as month, shipping_country, category, count(distinct order_id) as total_orders,
      count(distinct customer_id) as unique_customers, cast(sum(quantity) as bigint) as total_items_sold,
      cast(sum(cast(cast(cast(quantity * i.unit_price as decimal(16,2)) * (100 - discount_pct) * cast(0.01 as decimal(3,2)) as decimal(24,6))
        * case when o.currency = 'USD' then cast(1 as decimal(12,6)) else coalesce(rate_to_usd, cast(1 as decimal(12,6))) end as decimal(14,2))) as decimal(16,2)) as total_revenue_usd
    from lines i join sold o using (order_id) left join rates on rate_date = cast(order_date as date) and quote_currency = o.currency
    left join (select product_id, category from parts) p using (product_id) group by 1, 2, 3, 4""", "shop_orders rates products")
def daily_chain(c: Commerce) -> DataFrame:
    """Two days of the whole chain: ingest, bronze and its checks, silver and its quality, gold by months and its quality.

    The second day brings a third of the orders, whose lines and rates are there since the first.
    """
    lake = Lake(_scratch(c), buckets=4)
    state = State(c.spark, lake)
    orders = c.orders().withColumn("updated_at", F.col("order_date"))
    given = {
        "orders": orders, "order_items": _items(c),
        "products": c.products().withColumn("updated_at", F.lit("2024-01-01").cast("timestamp")),
        "exchange_rates": c.rates().withColumn("updated_at", F.col("rate_date").cast("timestamp")),
    }
    specs = [_spec(n) for n in given]

    def ingested(day: int) -> dict:
        rows = given if day == 1 else {"orders": orders}
        part = {"orders": orders.filter((F.col("order_id") % 3 == 0) == F.lit(day == 2))}
        return {n: lambda n=n: landing.land_rows(part.get(n, given[n]), lake.landing, _spec(n), f"2024020{day}T000000Z-00000001", 100_000, _extra()) for n in rows}

    for day in (1, 2):
        daily.run_daily(c.spark, lake, state, specs, ingested(day), by_month=True)
    return gold_months.kpi_by_month(c.spark, lake).drop("updated_at")


@query("pages_in_order", """
    select page, count(*) as n_rows, min(place) as first_place, min_by(event_id, place) as first_id, max_by(event_id, place) as last_id
    from (select event_id, place, place // 500 + 1 as page from (select event_id, row_number() over (order by ts, event_id) - 1 as place from events)) group by 1""")
def pages_in_order(c: Commerce) -> DataFrame:
    """Every page of the sorted events, from one sort."""
    index = pages.PageIndex.build(c.raw("events").select("event_id", "ts"), ["ts", "event_id"], f"{_scratch(c)}/pages", parts=64)
    return index.paged(500).groupBy("page").agg(
        F.count("*").alias("n_rows"), F.min("place").alias("first_place"),
        F.min_by("event_id", "place").alias("first_id"), F.max_by("event_id", "place").alias("last_id"))


@query("last_page", """
    select event_id, ts, (select count(*) from events) as total, false as has_more from events
    qualify (row_number() over (order by ts, event_id) - 1) // 500 = ((select count(*) from events) - 1) // 500""")
def last_page(c: Commerce) -> DataFrame:
    """The deepest page of the sorted events, read by its ranges alone."""
    index = pages.PageIndex.build(c.raw("events").select("event_id", "ts"), ["ts", "event_id"], f"{_scratch(c)}/pages", parts=64)
    return index.page(-(-index.total // 500) or 1, 500)
