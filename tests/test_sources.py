import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from tapelens.contracts import ORDERS, TRADES
from tapelens.operators import coverage, profile, staging
from tapelens.sources import files, zip_csv
from tapelens.streaming import incremental

ORDER_HEAD = "SeqNum,OrderId,OrderType,Ext,Time,Price,Volume,Level,BrokerNo,VolumePre"
TRADE_HEAD = "Time,Price,Volume,Dir,Type,BrokerNo,TickID,BidOrderID,BidVolume,AskOrderID,AskVolume"


@pytest.fixture
def archive(tmp_path):
    with zipfile.ZipFile(tmp_path / "20250218.zip", "w") as z:
        z.writestr("20250218\\OrderAdd\\00001.csv", f"{ORDER_HEAD}\n1,1001,1,000,92048,10.5,100,1,0746,0\n2,1002,x,110,bad,NULL,5,,0,\n")
        z.writestr("20250218\\OrderModifyDelete\\00001.csv", f"{ORDER_HEAD}\n3,1001,3,110,93000,10.6,0,2,0746,1\n")
        z.writestr("20250218\\TradeResumes\\00001.csv", f"{TRADE_HEAD}\n92049,10.5,100,2,,0746,7,1001,100,0,0\n")
        z.writestr("20250218\\TradeResumes\\broken.csv", b"\xff\xfe\x00bad")
        z.writestr("20250218\\Index\\a.csv", "x\n1\n")
        z.writestr("20250218\\readme.txt", "no rows")
    return tmp_path


def read(spark, folder):
    zip_csv.register(spark)
    return spark.read.format("zipcsv").option("slices_per_archive", 3).load(str(folder))


def test_zip_members_as_rows(spark, archive):
    rows = read(spark, archive).collect()
    good = {(r.source_file, r.row_num_in_file) for r in rows if r.error is None}
    assert good == {("20250218/OrderAdd/00001.csv", 1), ("20250218/OrderAdd/00001.csv", 2), ("20250218/OrderModifyDelete/00001.csv", 1), ("20250218/TradeResumes/00001.csv", 1), ("20250218/Index/a.csv", 1)}
    assert [r.source_file for r in rows if r.error] == ["20250218/TradeResumes/broken.csv"]
    assert {r.raw_group for r in rows} == {"OrderAdd", "OrderModifyDelete", "TradeResumes", "Index"} and {r.trade_date for r in rows} == {dt.date(2025, 2, 18)}


def test_zip_members_in_batches(spark, tmp_path):
    """Each member whole and once, however many slices and batches, by a URI too; a late error takes all of its member."""
    n = zip_csv.BATCH_ROWS + 5
    (tmp_path / "below").mkdir()
    with zipfile.ZipFile(tmp_path / "below" / "20240102.zip", "w") as z:
        z.writestr("G/long.csv", "a,b\n" + "".join(f"{i},\n" for i in range(n)))
        z.writestr("G/late.csv", "a\n" + "1\n" * n + "1,2\n")
        z.writestr("G/short.CSV", "a,b\n1\n")
        z.writestr("G/empty.csv", "")
        z.writestr("G/head.csv", "a,b\n")
    zipfile.ZipFile(tmp_path / "20240103.zip", "w").close()
    zip_csv.register(spark)
    for path in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}/below/20240102.zip"):
        rows = spark.read.format("zipcsv").load(path)
        got = {(r.source_file, r.error): (r.n, r.least, r.most, r.total) for r in rows.groupBy("source_file", "error").agg(F.count("*").alias("n"), F.min("row_num_in_file").alias("least"), F.max("row_num_in_file").alias("most"), F.sum(F.col("cells")["a"]).alias("total")).collect()}
        assert got == {("G/long.csv", None): (n, 1, n, n * (n - 1) / 2), ("G/late.csv", f"ValueError: row {n + 1} has more cells than the header"): (1, None, None, None), ("G/short.CSV", None): (1, 1, 1, 1.0)}
        assert rows.where("source_file = 'G/short.CSV'").first().cells == {"a": "1", "b": None}


def staged(spark, folder, contract, names):
    rows = read(spark, folder).where(F.col("error").isNull() & F.col("raw_group").isin(list(contract.groups["2025"])))
    text = rows.select(F.col("trade_date").alias("date"), "source_file", "row_num_in_file", *[F.col("cells")[n].alias(n) for n in names])
    return staging.with_reasons(staging.typed(text, contract, names), contract)


def test_staging_of_a_day(spark, archive):
    orders = staged(spark, archive, ORDERS, ORDER_HEAD.split(","))
    kept = staging.accepted(orders)
    assert kept.columns == ORDERS.schema.names and [f.dataType for f in kept.schema] == [f.dataType for f in ORDERS.schema]
    assert sorted((r.OrderId, r.Time, r.Ext, r.BrokerNo, r.SendTime) for r in kept.collect()) == [(1001, "092048", "000", "0746", None), (1001, "093000", "110", "0746", None)]
    assert {(r.reason, r.n) for r in staging.rejection_counts(orders).collect()} == {("invalid_required_format:Time", 1), ("null_required_input:Price", 1)}
    trades = staged(spark, archive, TRADES, TRADE_HEAD.split(","))
    m = staging.partition_manifest(trades).first()
    assert (m.raw_row_count, m.row_count, m.rejected_row_count, m.min_time, m.status) == (1, 1, 0, "092049", "completed")
    missing = staged(spark, archive, TRADES, [n for n in TRADE_HEAD.split(",") if n != "Price"])
    assert [r.reason for r in staging.rejection_counts(missing).collect()] == ["missing_required_column:Price"]


def test_inventory_of_members(spark, archive):
    members = read(spark, archive).select(F.year("trade_date").alias("year"), F.col("trade_date").alias("date"), "source_file", "raw_group").distinct()
    groups = staging.group_map(members)
    found = {r.raw_group: (r.csv_member_count, list(r.mapped_tables), r.skip_reason) for r in staging.source_inventory(members, groups).collect()}
    assert found == {"OrderAdd": (1, ["orders"], None), "OrderModifyDelete": (1, ["orders"], None), "TradeResumes": (2, ["trades"], None), "Index": (1, [], "unmapped_source_group")}
    assert [r.source_file for r in staging.unmapped_members(members, groups).collect()] == ["20250218/Index/a.csv"]


def test_member_profiles(spark, archive):
    profiles = coverage.member_profile(coverage.members_of(read(spark, archive)))
    got = {r.raw_group: (r.table_hints, r.member_count, r.row_count, r.schema_count) for r in coverage.group_profile(profiles, ["raw_group"]).collect()}
    assert got == {"OrderAdd": ("orders", 1, 2, 1), "OrderModifyDelete": ("orders", 1, 1, 1), "TradeResumes": ("trades", 1, 1, 1), "Index": ("unknown", 1, 1, 1)}


def test_manifest_as_parquet(spark, tmp_path):
    files.append_manifest(spark.createDataFrame([("a", 1)], "k string, n int"), str(tmp_path / "log"))
    files.manifest_to_parquet(spark, str(tmp_path / "log"), "k string, n int", str(tmp_path / "table"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "table")).collect()] == [("a", 1)]


def test_listing_and_seeds(spark, archive):
    (archive / "empty.bin").write_bytes(b"")
    total = coverage.inventory_rollup(coverage.file_inventory(files.listing(spark, str(archive)))).where("is_total").first()
    assert (total.file_count, total.zero_byte_files, total.undated_files) == (2, 1, 1)
    (archive / "seed.csv").write_text("a,b\nN/A, x \nNULL,\n")
    assert [tuple(r) for r in files.text_csv(spark, str(archive / "seed.csv")).collect()] == [(None, "x"), (None, None)]
    (archive / "codes.txt").write_text("12,A\n0012,B\nAB,C\n\n")
    assert sorted(r.code for r in files.code_list(spark.read.text(str(archive / "codes.txt"))).collect()) == ["0012", "AB"]


def test_tree_in_tasks(spark, tmp_path, monkeypatch):
    """A real tree: nested, empty and undated files; the driver asks for one level only."""
    for name, size in (("20250102.zip", 3), ("empty.txt", 0), ("2025/20250103/a.csv", 5), ("2025/20250104/deep/b.csv", 7), ("2026/readme", 0), ("none/below/.keep", 1)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    (tmp_path / "bare").mkdir()
    asked = []
    selector = files.fs.FileSelector
    monkeypatch.setattr(files.fs, "FileSelector", lambda path, **k: asked.append((path, k)) or selector(path, **k))
    for root in (str(tmp_path), f"{tmp_path}/", tmp_path.as_uri()):
        asked.clear()
        found = files.tree(spark, root)
        assert asked == [(str(tmp_path), {})] or asked == [(f"{tmp_path}/", {})]
        got = {(r.path.removeprefix(root.rstrip("/")), r.length) for r in found.collect()}
        assert got == {("/20250102.zip", 3), ("/empty.txt", 0), ("/2025/20250103/a.csv", 5), ("/2025/20250104/deep/b.csv", 7), ("/2026/readme", 0), ("/none/below/.keep", 1)}
    r = coverage.inventory_summary(coverage.file_inventory(found)).first()
    assert (r.files_scanned, r.bytes_scanned, r.zero_byte_files, r.unknown_date_files, r.distinct_trade_dates) == (6, 16, 2, 3, 3)
    assert (r.date_coverage_start, r.date_coverage_end) == (dt.date(2025, 1, 2), dt.date(2025, 1, 4)) and r.suffix_counts == {"": 1, ".csv": 2, ".keep": 1, ".txt": 1, ".zip": 1}
    assert found.where("path LIKE '%deep%'").first().modificationTime is not None
    none = coverage.inventory_summary(coverage.file_inventory(found).limit(0)).first()
    assert (none.files_scanned, none.bytes_scanned, none.date_coverage_start, none.suffix_counts) == (0, 0, None, {})
    with pytest.raises(Exception, match="missing|not exist|Cannot list"):
        files.tree(spark, str(tmp_path / "nowhere"))


def test_date_selection(spark):
    days = spark.createDataFrame([(dt.date(2025, 1, d),) for d in (2, 5, 6, 7, 8, 9)], "date date")
    pick = lambda **k: sorted(r.date.day for r in files.select_dates(days, **k).collect())
    assert pick(between=("2025-01-05", "2025-01-09"), batch=(2, 2)) == [7, 8]
    assert pick(dates=["2025-01-02", "2025-01-03"]) == [2] and pick(first=2) == [2, 5] and pick(latest=2) == [8, 9]
    assert files.select_dates(days.unionByName(days.select(F.lit(None).cast("date").alias("date"))), first=99).count() == 6


def test_dates_prune_partitions(spark, tmp_path):
    """Of a table partitioned by date, only the chosen dates' files are opened."""
    days = [dt.date(2025, 1, d) for d in (2, 5, 6)]
    files.write_partitions(spark.createDataFrame([(d, i) for d in days for i in range(5)], "date date, i int"), str(tmp_path), ["date"])
    chosen = files.select_dates(spark.read.parquet(str(tmp_path)), latest=1)
    for old in tmp_path.glob("date=2025-01-0[25]/*.parquet"):
        old.write_bytes(b"not opened")
    assert chosen.count() == 5 and {r.date for r in chosen.collect()} == {days[2]}
    scan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in scan or "PartitionFilters: [(date" in scan or "PartitionFilters: [date" in scan


def test_incremental_batches(spark, tmp_path):
    rows = spark.createDataFrame([(d, v) for d in ("a", "b", "c") for v in range(3)], "date string, v int")
    data, log, form = str(tmp_path / "data"), str(tmp_path / "log"), "date string, row_count bigint, status string, version string"
    assert incremental.stage_batch(rows.where("date < 'c'"), None, data, log, ["date"], "1") == 2
    assert incremental.stage_batch(rows, files.read_manifest(spark, log, form), data, log, ["date"], "1") == 1
    assert incremental.stage_batch(rows, files.read_manifest(spark, log, form), data, log, ["date"], "1") == 0
    assert spark.read.parquet(data).count() == 9
    tasks, manifest = rows.select("date").distinct(), files.read_manifest(spark, log, form)
    incremental.refuse_mismatch(tasks, manifest, ["date"], "1")
    with pytest.raises(ValueError, match="version"):
        incremental.refuse_mismatch(tasks, manifest, ["date"], "2")
    incremental.refuse_mismatch(tasks.where("date = 'a'"), manifest, ["date"], "1")  # finished: others may follow
    with pytest.raises(ValueError, match="not selected"):
        incremental.refuse_mismatch(tasks.where("date = 'a'"), manifest.withColumn("status", F.lit("running")), ["date"], "1")


def test_incremental_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("date", F.to_date("ts"))
    source, data, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    form = events.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    run = lambda: incremental.stage_stream(spark, source, form, lambda df: df.where("value IS NOT NULL"), data, state, ["date"])
    events.where("event_id % 2 = 0").coalesce(1).write.parquet(source)
    run()
    events.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert spark.read.parquet(data).count() == events.where("value IS NOT NULL").count()


def test_schema_fingerprints(spark, tmp_path):
    from tapelens.contracts import Contract

    spark.range(3).selectExpr("id", "cast(id AS string) AS s").coalesce(1).write.parquet(str(tmp_path / "p/a"))
    spark.range(3).selectExpr("cast(id AS int) AS id", "'x' AS t").coalesce(1).write.parquet(str(tmp_path / "p/b"))
    listed = files.listing(spark, str(tmp_path / "p")).where("path LIKE '%.parquet'")
    prints = profile.schema_fingerprints(spark, listed).withColumn("part", F.regexp_extract("path", "p/([ab])/", 1))
    contract = Contract("x", (("id", "bigint"), ("s", "string")), ("id",), {})
    got = {r.part: (r.n_variants, r.missing_columns, r.extra_columns, r.mismatched_columns, r.status) for r in profile.schema_drift(prints, contract, "part").collect()}
    assert got == {"a": (1, [], [], [], "pass"), "b": (1, ["s"], ["t"], ["id:int32"], "fail")}
