"""Queries of staging and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelens.contracts import ORDERS as ORDER_CONTRACT
from tapelens.operators import coverage, gates
from tapelens.operators import staging as op
from tapelens.plans.adapters import RAW_ORDERS, raw_orders, read
from tapelens.sources.files import scratch, tree
from tapelens.streaming import ingest
from tapelens.streaming.incremental import open_tasks

_TEXT = ["SeqNum", "OrderId", "OrderType", "Time", "Price", "Volume", "SendTime"]


def _staged(spark, sf_dir):
    return op.with_reasons(op.typed(raw_orders(spark, sf_dir), ORDER_CONTRACT, _TEXT), ORDER_CONTRACT)


def typed(spark, sf_dir):
    """All rows as typed, whether kept or not."""
    return op.typed(raw_orders(spark, sf_dir), ORDER_CONTRACT, _TEXT).select("date", "row_num_in_file", "source_file", "SeqNum", "OrderId", F.col("OrderType").cast("int").alias("OrderType"), "Time", "Price", "Volume", "SendTimeRaw", "SendTimeNs", "SendTime", F.col("Level").isNull().alias("level_absent"))


def accepted(spark, sf_dir):
    return op.accepted(_staged(spark, sf_dir)).select("date", "table_name", "row_num_in_file", "OrderId", "Time", "Price")


def quarantine(spark, sf_dir):
    return op.quarantine(_staged(spark, sf_dir)).select("row_num_in_file", F.array_join("reasons", ",").alias("reasons"))


def rejections(spark, sf_dir):
    return op.rejection_counts(_staged(spark, sf_dir))


def nulls(spark, sf_dir):
    return op.null_counts(_staged(spark, sf_dir), ORDER_CONTRACT)


def manifest(spark, sf_dir):
    return op.partition_manifest(_staged(spark, sf_dir))


def _zip_rows(spark, sf_dir):
    """Rows as the zip source has them, two years later; every user who signed up on a day has a broken member there."""
    later = lambda day: F.add_months(day, 24)
    head = F.array(*map(F.lit, _TEXT))
    raw = raw_orders(spark, sf_dir).withColumns({"trade_date": later("date"), "raw_group": F.lit("order"), "header": head, "error": F.lit(None).cast("string")}).drop("date")
    broken = read(spark, sf_dir, "events").where("event_type = 'signup'").select(later(F.to_date("ts")).alias("trade_date"), F.concat(F.lit("order/signup"), F.lpad(F.col("user_id").cast("string"), 5, "0"), F.lit(".csv")).alias("source_file")).distinct()
    rows = raw.unionByName(broken.withColumns({"raw_group": F.lit("order"), "error": F.lit("broken")}), allowMissingColumns=True)
    return rows.withColumns({c: F.lit(None).cast("string") for c in op.text_columns(ORDER_CONTRACT) if c not in rows.columns})


def ingest_manifest(spark, sf_dir):
    """What the manifest says of a written batch."""
    made = ingest.write_batch(_zip_rows(spark, sf_dir), ORDER_CONTRACT, scratch(spark, "stage"), 1, "v1")
    pairs = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    files = F.array_join(F.transform("failed_member_examples", lambda e: e["source_file"]), ",")
    out = made.withColumns({"required_null_counts": pairs("required_null_counts"), "rejection_reason_counts": pairs("rejection_reason_counts"), "failed_member_examples": files, "has_bytes": (F.col("output_bytes") > 0) & (F.col("output_files") > 0)})
    return out.drop("output_files", "output_bytes", "generated_at", "error")


def ingest_quarantine(spark, sf_dir):
    """Rejected rows as the stage's quarantine keeps them, with one cell of their raw text."""
    root = scratch(spark, "stage")
    ingest.write_batch(_zip_rows(spark, sf_dir), ORDER_CONTRACT, root, 1, "v1")
    return ingest.quarantine_table(spark, root, ORDER_CONTRACT).select("date", "row_num_in_file", F.array_join("reasons", ",").alias("reasons"), F.get_json_object("raw", "$.Time").alias("raw_time"))


def _members(spark, sf_dir):
    """Raw members of parts: a group folder each, of which some feed no table; small parts lie outside any group folder."""
    n = F.col("p_partkey")
    year = F.when(n % 2 == 0, 2025).otherwise(2026)
    groups = F.when(n % 10 == 0, "OrderAdd").when(n % 10 == 2, "TradeResumes").when(n % 10 == 4, "Index").when(n % 10 < 6, "order").otherwise("trade")
    file = F.concat(F.when(n % 2 == 0, F.lit("20250218\\")).otherwise(""), F.when(F.col("p_size") > 4, F.concat(groups, F.lit("/"))).otherwise(""), F.lpad(n.cast("string"), 7, "0"), F.lit(".csv"))
    rows = read(spark, sf_dir, "part").select(year.alias("year"), F.date_add(F.lit("2025-02-01").cast("date"), (n % 5).cast("int")).alias("date"), F.regexp_replace(file, r"\\", "/").alias("source_file"))
    return rows.withColumn("raw_group", op.raw_group(F.col("source_file"), F.col("year")))


def inventory(spark, sf_dir):
    members = _members(spark, sf_dir)
    out = op.source_inventory(members, op.group_map(members))
    return out.withColumn("mapped_tables", F.array_join("mapped_tables", ","))


def unmapped(spark, sf_dir):
    members = _members(spark, sf_dir)
    return op.unmapped_members(members, op.group_map(members)).select("year", "date", "source_file", "raw_group")


def routed(spark, sf_dir):
    members = _members(spark, sf_dir)
    return op.route(members, op.group_map(members)).groupBy("year", "raw_group", "table_name").agg(F.count("*").alias("members"))


def flattened(spark, sf_dir):
    members = _members(spark, sf_dir)
    return coverage.flatten_groups(op.source_inventory(members, op.group_map(members)))


def _large(spark, sf_dir, kind, least):
    """Events of a type with at least such a value, by day and member."""
    file = F.concat(F.lit("order/"), F.lpad(F.col("user_id").cast("string"), 5, "0"), F.lit(".csv"))
    return read(spark, sf_dir, "events").where((F.col("event_type") == kind) & (F.col("value") >= least)).select(F.to_date("ts").alias("date"), file.alias("source_file"))


def reconciliation(spark, sf_dir):
    """Signups with large values as failed members, purchases as failed tasks, views as members without a table."""
    failed = _large(spark, sf_dir, "signup", 200).groupBy("date").agg(F.count("*").alias("failed_member_count"))
    parts = manifest(spark, sf_dir).join(failed, "date", "left").withColumns({"year": F.year("date"), "failed_member_count": F.coalesce("failed_member_count", F.lit(0))})
    tasks = _large(spark, sf_dir, "purchase", 220).select(F.year("date").alias("year"), "date", F.lit("orders").alias("table_name"))
    return coverage.reconcile(parts, tasks, _large(spark, sf_dir, "view", 210).select("date"))


def ledger(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    parse = op.partition_manifest(staged).select("date", "table_name", F.col("send_time_parse_failure_count").alias("n"))
    member = _large(spark, sf_dir, "signup", 150).select("date", F.lit("orders").alias("table_name"), "source_file", F.lit("broken").alias("error"))
    task = _large(spark, sf_dir, "purchase", 200).select("date", F.lit("orders").alias("table_name"), F.lit("lost").alias("error"))
    unmapped_rows = _large(spark, sf_dir, "view", 100).select("date", "source_file", F.lit("Index").alias("raw_group"))
    out = coverage.failure_ledger(op.rejection_counts(staged), parse, member, task, unmapped_rows)
    return out.groupBy("date", "failure_type").agg(F.sum("failure_count").alias("failures"), F.count("*").alias("entries"), F.count("source_file").alias("with_file"))


def audit(spark, sf_dir):
    members = _members(spark, sf_dir)
    groups = op.source_inventory(members, op.group_map(members))
    parts = members.select("date").distinct().select("date", F.explode(F.array(F.lit("orders"), F.lit("trades"))).alias("table_name"))
    return coverage.partition_audit(parts, groups).withColumn("source_groups", F.array_join("source_groups", ","))


def _raw_listing(spark, sf_dir):
    n = F.col("p_partkey")
    day = F.date_add(F.lit("2025-01-01").cast("date"), (n % 40).cast("int"))
    name = F.when(n % 11 == 0, "readme.txt").when(n % 11 == 1, F.concat(F.lit("99999999/"), n.cast("string"), F.lit(".zip"))).when(n % 2 == 0, F.concat(F.date_format(day, "yyyyMMdd"), F.lit(".zip"))).otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("/a.csv")))
    listing = read(spark, sf_dir, "part").select(F.concat(F.lit("raw/"), name).alias("path"), F.when(n % 17 == 0, 0).otherwise(F.col("p_size") * 1000).cast("bigint").alias("length"), F.lit("2025-03-01").cast("timestamp").alias("modificationTime"))
    return coverage.file_inventory(listing)


def raw_files(spark, sf_dir):
    """An inventory of files named after parts, some of them dated and some empty."""
    return coverage.inventory_rollup(_raw_listing(spark, sf_dir))


def raw_summary(spark, sf_dir):
    """The same files in one row; suffixes as text."""
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("suffix_counts")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return coverage.inventory_summary(_raw_listing(spark, sf_dir)).withColumn("suffix_counts", counts)


def own_files(spark, sf_dir):
    """The tables' own files, listed in tasks, by suffix; DuckDB has no view of files, so there is no SQL."""
    found = coverage.file_inventory(tree(spark, sf_dir))
    return found.groupBy("suffix").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes"), F.count_if(F.col("size_bytes") == 0).alias("zero_byte_files"))


def _profiles(spark, sf_dir):
    """Members of suppliers: one header for orders, one for trades, one for neither."""
    n = F.col("s_suppkey")
    head = lambda *c: F.array(*map(F.lit, c))
    columns = F.when(n % 3 == 0, head("SeqNum", "OrderId", "OrderType", "Time", "Level")).when(n % 3 == 1, head("TickID", "Dir", "Time", "BidOrderID")).otherwise(head("Code", "Price"))
    rows = read(spark, sf_dir, "supplier").select(F.concat(F.lit("g"), (F.col("s_nationkey") % 4).cast("string")).alias("raw_group"), F.concat(F.lit("m"), F.lpad(n.cast("string"), 6, "0")).alias("source_file"), columns.alias("columns"), (n % 13).alias("row_count"), F.lpad((n % 24).cast("string"), 2, "0").alias("min_time"), F.lpad((n * 7 % 24).cast("string"), 2, "0").alias("max_time"))
    return coverage.member_profile(rows)


def member_groups(spark, sf_dir):
    return coverage.group_profile(_profiles(spark, sf_dir), ["raw_group"]).withColumn("examples", F.array_join("examples", ","))


def schema_totals(spark, sf_dir):
    return coverage.schema_totals(_profiles(spark, sf_dir))


def manifest_states(spark, sf_dir):
    """Customers as tasks; a manifest row for each of their finished orders, an output of the orders that are not pending, empty where their number is even."""
    tasks = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("task"))
    sold = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("task"), F.col("o_orderstatus").alias("s"))
    rows = sold.where("s = 'F'").select("task", F.lit(1).alias("row_count"))
    outputs = sold.where("s <> 'P'").groupBy("task").agg((F.count("*") % 2).cast("int").alias("row_count"))
    return gates.manifest_state(tasks, rows, outputs, ["task"]).select("task", "is_task", "state")


def open_dates(spark, sf_dir):
    """Partitions that a manifest of the even days has not finished."""
    tasks = raw_orders(spark, sf_dir).select("date").distinct()
    done = tasks.where(F.dayofmonth("date") % 2 == 0).withColumn("status", F.lit("completed"))
    return open_tasks(tasks, done, ["date"])


_WITH = f"WITH {RAW_ORDERS}"
_MANIFEST = """man AS (SELECT date, 'orders' AS table_name, count(*) AS raw_row_count, count(*) FILTER (WHERE len(reasons) = 0) AS row_count, count(*) FILTER (WHERE len(reasons) > 0) AS rejected_row_count,
   count(DISTINCT source_file) AS member_count, min(Time) FILTER (WHERE len(reasons) = 0) AS min_time, max(Time) FILTER (WHERE len(reasons) = 0) AS max_time, min(SendTime) FILTER (WHERE len(reasons) = 0) AS min_sendtime,
   max(SendTime) FILTER (WHERE len(reasons) = 0) AS max_sendtime, count(*) FILTER (WHERE SendTime IS NULL) AS send_time_parse_failure_count,
   CASE WHEN count(*) FILTER (WHERE len(reasons) = 0) > 0 THEN 'completed' ELSE 'empty' END AS status FROM judged GROUP BY date)"""
_MEMBERS = """mem0 AS (SELECT p_partkey AS n, CASE WHEN p_partkey % 2 = 0 THEN 2025 ELSE 2026 END AS year, DATE '2025-02-01' + CAST(p_partkey % 5 AS INT) AS date,
    CASE WHEN p_size <= 4 THEN NULL WHEN p_partkey % 10 = 0 THEN 'OrderAdd' WHEN p_partkey % 10 = 2 THEN 'TradeResumes' WHEN p_partkey % 10 = 4 THEN 'Index' WHEN p_partkey % 10 < 6 THEN 'order' ELSE 'trade' END AS raw_group FROM part),
 mem AS (SELECT *, CASE WHEN n % 2 = 0 THEN '20250218/' ELSE '' END || coalesce(raw_group || '/', '') || lpad(CAST(n AS VARCHAR), 7, '0') || '.csv' AS source_file FROM mem0),
 gm AS (SELECT * FROM (VALUES (2025, 'TradeResumes', 'trades'), (2026, 'trade', 'trades'), (2025, 'OrderAdd', 'orders'), (2025, 'OrderModifyDelete', 'orders'), (2026, 'order', 'orders')) t(year, raw_group, table_name)),
 inv AS (SELECT mem.year, date, mem.raw_group, count(*) AS csv_member_count, min(source_file) AS example_member, max(table_name) AS table_name FROM mem LEFT JOIN gm ON mem.year = gm.year AND mem.raw_group = gm.raw_group GROUP BY ALL)"""
_KINDS = "CASE WHEN reason LIKE 'missing_required_column:%' OR reason LIKE 'null_required_input:%' THEN 'required_missing' ELSE 'cast_failed' END"

QUERIES = {
    "stage_typed": (typed, f"{_WITH} SELECT date, row_num_in_file, source_file, SeqNum, OrderId, CAST(OrderType AS INT) AS OrderType, Time, Price, Volume, SendTimeRaw, SendTimeNs, SendTime, true AS level_absent FROM judged"),
    "stage_accepted": (accepted, f"{_WITH} SELECT date, 'orders' AS table_name, row_num_in_file, OrderId, Time, Price FROM judged WHERE len(reasons) = 0"),
    "stage_quarantine": (quarantine, f"{_WITH} SELECT row_num_in_file, array_to_string(reasons, ',') AS reasons FROM judged WHERE len(reasons) > 0"),
    "stage_rejections": (rejections, f"{_WITH} SELECT date, 'orders' AS table_name, reason, count(*) AS n FROM (SELECT date, unnest(reasons) AS reason FROM judged) GROUP BY ALL"),
    "stage_null_counts": (nulls, f"{_WITH} " + " UNION ALL ".join(f"SELECT date, 'orders' AS table_name, '{c}' AS field, count(*) - count({c}) AS n_null FROM judged GROUP BY date" for c in ORDER_CONTRACT.required)),
    "stage_manifest": (manifest, f"{_WITH}, {_MANIFEST} SELECT * FROM man"),
    "ingest_manifest": (
        ingest_manifest,
        f"""{_WITH}, f AS (SELECT DISTINCT CAST(ts AS DATE) AS date, 'order/signup' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '.csv' AS file FROM events WHERE event_type = 'signup'),
            g AS (SELECT date, count(*) AS k, array_to_string(list_slice(list(file ORDER BY file), 1, 10), ',') AS files FROM f GROUP BY date),
            w AS (SELECT date, string_agg(reason || '=' || n, ',' ORDER BY reason) AS whys FROM (SELECT date, reason, count(*) AS n FROM (SELECT date, unnest(reasons) AS reason FROM judged) GROUP BY ALL) GROUP BY date),
            m AS (SELECT date, count(*) AS n, count(*) FILTER (WHERE len(reasons) = 0) AS kept, count(DISTINCT source_file) AS members, count(*) FILTER (WHERE SendTime IS NULL) AS bad_time,
              min(SendTime) FILTER (WHERE len(reasons) = 0) AS s0, max(SendTime) FILTER (WHERE len(reasons) = 0) AS s1, min(Time) FILTER (WHERE len(reasons) = 0) AS t0, max(Time) FILTER (WHERE len(reasons) = 0) AS t1,
              'OrderId=' || count(*) FILTER (WHERE OrderId IS NULL) || ',Price=' || count(*) FILTER (WHERE Price IS NULL) || ',SeqNum=' || count(*) FILTER (WHERE SeqNum IS NULL) || ',Time=' || count(*) FILTER (WHERE Time IS NULL) || ',Volume=0' AS nulls FROM judged GROUP BY date)
            SELECT CAST(year(date) + 2 AS INT) AS year, CAST(date + INTERVAL 2 YEAR AS DATE) AS date, 'orders' AS table_name, CAST(1 AS BIGINT) AS batch, false AS replaces,
              CASE WHEN k > 0 THEN 'completed_with_member_errors' ELSE 'completed' END AS status, n AS raw_row_count, kept AS row_count, n - kept AS rejected_row_count, members AS source_member_count,
              coalesce(k, 0) AS failed_member_count, coalesce(files, '') AS failed_member_examples, nulls AS required_null_counts, coalesce(whys, '') AS rejection_reason_counts, bad_time AS send_time_parse_failure_count,
              s0 AS min_send_time, s1 AS max_send_time, t0 AS min_time, t1 AS max_time, 'v1' AS version, true AS has_bytes FROM m LEFT JOIN g USING (date) LEFT JOIN w USING (date)""",
    ),
    "ingest_quarantine": (ingest_quarantine, f"{_WITH} SELECT CAST(date + INTERVAL 2 YEAR AS DATE) AS date, row_num_in_file, array_to_string(reasons, ',') AS reasons, judged.Time0 AS raw_time FROM (SELECT judged.*, raw.Time AS Time0 FROM judged JOIN raw USING (row_num_in_file)) judged WHERE len(reasons) > 0"),
    "source_inventory": (inventory, f"WITH {_MEMBERS} SELECT year, date, raw_group, csv_member_count, example_member, coalesce(table_name, '') AS mapped_tables, CASE WHEN table_name IS NULL THEN 'unmapped_source_group' END AS skip_reason FROM inv"),
    "source_unmapped": (unmapped, f"WITH {_MEMBERS} SELECT year, date, source_file, raw_group FROM mem ANTI JOIN gm ON mem.year = gm.year AND mem.raw_group = gm.raw_group"),
    "source_routing": (routed, f"WITH {_MEMBERS} SELECT mem.year, mem.raw_group, table_name, count(*) AS members FROM mem LEFT JOIN gm ON mem.year = gm.year AND mem.raw_group = gm.raw_group GROUP BY ALL"),
    "coverage_groups": (flattened, f"WITH {_MEMBERS} SELECT year, date, table_name, raw_group AS source_group, csv_member_count AS member_count, CASE WHEN table_name IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapped_status, example_member, CASE WHEN table_name IS NULL THEN 'unmapped_source_group' END AS skip_reason FROM inv"),
    "coverage_partition_audit": (audit, f"WITH {_MEMBERS} SELECT d.date, t.table_name, string_agg(DISTINCT inv.raw_group, ',' ORDER BY inv.raw_group) AS source_groups FROM (SELECT DISTINCT date FROM mem) d CROSS JOIN (VALUES ('orders'), ('trades')) t(table_name) LEFT JOIN inv ON inv.date = d.date AND inv.table_name = t.table_name GROUP BY ALL"),
    "coverage_reconciliation": (
        reconciliation,
        f"""{_WITH}, {_MANIFEST}, e AS (SELECT CAST(ts AS DATE) AS date, count(*) FILTER (WHERE event_type = 'view' AND value >= 210) AS k, count(*) FILTER (WHERE event_type = 'signup' AND value >= 200) AS m,
                count(*) FILTER (WHERE event_type = 'purchase' AND value >= 220) AS t FROM events GROUP BY 1),
            x AS (SELECT CAST(year(date) AS INT) AS year, man.date, table_name, raw_row_count AS raw_rows_total, row_count AS stage_rows_total, rejected_row_count AS rejected_rows_total,
                    m + t AS failed_member_count, k AS unmapped_member_count FROM man JOIN e USING (date))
            SELECT *, raw_rows_total - stage_rows_total - rejected_rows_total AS row_diff, CASE WHEN unmapped_member_count > 0 THEN 'date_level' END AS unmapped_scope,
              CASE WHEN raw_rows_total <> stage_rows_total + rejected_rows_total OR failed_member_count > 0 OR unmapped_member_count > 0 THEN 'fail' WHEN rejected_rows_total > 0 THEN 'warn' ELSE 'pass' END AS reconciliation_status FROM x""",
    ),
    "coverage_failure_ledger": (
        ledger,
        f"""{_WITH}, {_MANIFEST}, x AS (
              SELECT date, {_KINDS} AS failure_type, n, NULL AS f FROM (SELECT date, reason, count(*) AS n FROM (SELECT date, unnest(reasons) AS reason FROM judged) GROUP BY ALL)
              UNION ALL SELECT date, 'sendtime_parse_failed', send_time_parse_failure_count, NULL FROM man WHERE send_time_parse_failure_count > 0
              UNION ALL SELECT CAST(ts AS DATE), 'member_failed', 1, 'order/' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '.csv' FROM events WHERE event_type = 'signup' AND value >= 150
              UNION ALL SELECT CAST(ts AS DATE), 'task_failed', 1, NULL FROM events WHERE event_type = 'purchase' AND value >= 200
              UNION ALL SELECT CAST(ts AS DATE), 'unmapped_source_member', 1, 'order/' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '.csv' FROM events WHERE event_type = 'view' AND value >= 100)
            SELECT date, failure_type, CAST(sum(n) AS BIGINT) AS failures, count(*) AS entries, count(f) AS with_file FROM x GROUP BY ALL""",
    ),
    "inventory_raw_files": (
        raw_files,
        """WITH f AS (SELECT 'raw/' || CASE WHEN n % 11 = 0 THEN 'readme.txt' WHEN n % 11 = 1 THEN '99999999/' || n || '.zip' WHEN n % 2 = 0 THEN strftime(d, '%Y%m%d') || '.zip' ELSE strftime(d, '%Y-%m-%d') || '/a.csv' END AS path,
              CASE WHEN n % 11 > 1 THEN d END AS trade_date, CASE WHEN n % 17 = 0 THEN 0 ELSE p_size * 1000 END AS bytes
              FROM (SELECT p_partkey AS n, p_size, DATE '2025-01-01' + CAST(p_partkey % 40 AS INT) AS d FROM part))
           SELECT trade_date, grouping(trade_date) = 1 AS is_total, count(*) AS file_count, CAST(sum(bytes) AS BIGINT) AS total_bytes, count(*) FILTER (WHERE bytes = 0) AS zero_byte_files,
              count(*) - count(trade_date) AS undated_files, count(DISTINCT regexp_extract(path, '[.][^./]+$')) AS suffixes FROM f GROUP BY ROLLUP (trade_date)""",
    ),
    "inventory_summary": (
        raw_summary,
        """WITH f AS (SELECT 'raw/' || CASE WHEN n % 11 = 0 THEN 'readme.txt' WHEN n % 11 = 1 THEN '99999999/' || n || '.zip' WHEN n % 2 = 0 THEN strftime(d, '%Y%m%d') || '.zip' ELSE strftime(d, '%Y-%m-%d') || '/a.csv' END AS path,
              CASE WHEN n % 11 > 1 THEN d END AS trade_date, CASE WHEN n % 17 = 0 THEN 0 ELSE p_size * 1000 END AS bytes
              FROM (SELECT p_partkey AS n, p_size, DATE '2025-01-01' + CAST(p_partkey % 40 AS INT) AS d FROM part)),
            s AS (SELECT string_agg(suffix || '=' || k, ',' ORDER BY suffix) AS suffix_counts FROM (SELECT regexp_extract(path, '[.][^./]+$') AS suffix, count(*) AS k FROM f GROUP BY 1))
           SELECT count(*) AS files_scanned, CAST(sum(bytes) AS BIGINT) AS bytes_scanned, count(*) FILTER (WHERE bytes = 0) AS zero_byte_files, count(*) - count(trade_date) AS unknown_date_files,
              min(trade_date) AS date_coverage_start, max(trade_date) AS date_coverage_end, count(DISTINCT trade_date) AS distinct_trade_dates, (SELECT suffix_counts FROM s) AS suffix_counts FROM f""",
    ),
    "inventory_own_files": (own_files, None),
    "source_member_groups": (
        member_groups,
        """SELECT 'g' || s_nationkey % 4 AS raw_group, count(*) AS member_count, CAST(sum(s_suppkey % 13) AS BIGINT) AS row_count, count(DISTINCT s_suppkey % 3) AS schema_count,
              string_agg(DISTINCT CASE s_suppkey % 3 WHEN 0 THEN 'orders' WHEN 1 THEN 'trades' ELSE 'unknown' END, ',' ORDER BY CASE s_suppkey % 3 WHEN 0 THEN 'orders' WHEN 1 THEN 'trades' ELSE 'unknown' END) AS table_hints,
              min(lpad(CAST(s_suppkey % 24 AS VARCHAR), 2, '0')) AS min_time, max(lpad(CAST(s_suppkey * 7 % 24 AS VARCHAR), 2, '0')) AS max_time,
              array_to_string(list_slice(list_sort(list(DISTINCT 'm' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0'))), 1, 10), ',') AS examples FROM supplier GROUP BY 1""",
    ),
    "source_schema_totals": (
        schema_totals,
        """SELECT CASE s_suppkey % 3 WHEN 0 THEN 'orders' WHEN 1 THEN 'trades' ELSE 'unknown' END AS table_hint, CAST(CASE s_suppkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 4 ELSE 2 END AS INT) AS column_count,
              sha1(CASE s_suppkey % 3 WHEN 0 THEN 'SeqNum,OrderId,OrderType,Time,Level' WHEN 1 THEN 'TickID,Dir,Time,BidOrderID' ELSE 'Code,Price' END) AS schema_hash,
              count(*) AS member_count, CAST(sum(s_suppkey % 13) AS BIGINT) AS row_count, count(DISTINCT s_nationkey % 4) AS group_count FROM supplier GROUP BY 1, 2, 3""",
    ),
    "manifest_states": (
        manifest_states,
        """WITH t AS (SELECT c_custkey AS task FROM customer), m AS (SELECT o_custkey AS task, count(*) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
              o AS (SELECT o_custkey AS task, CAST(count(*) % 2 AS INT) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
           SELECT coalesce(t.task, m.task, o.task) AS task, t.task IS NOT NULL AS is_task, CASE WHEN k > 1 THEN 'duplicate' WHEN k IS NULL AND n IS NOT NULL THEN 'orphan' WHEN k IS NOT NULL AND (n IS NULL OR n <> 1) THEN 'stale' WHEN k IS NULL THEN 'todo' ELSE 'done' END AS state
           FROM t FULL JOIN m ON t.task = m.task FULL JOIN o ON coalesce(t.task, m.task) = o.task""",
    ),
    "incremental_open_tasks": (open_dates, "SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE day(ts) % 2 = 1"),
}
