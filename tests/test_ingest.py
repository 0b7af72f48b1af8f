"""Staging of archives with a manifest: statuses, appended and repeated runs, orphans, stale rows, streams."""

import datetime as dt
import shutil
import zipfile

import pytest
from pyspark.sql.types import StructType

from tapelens.contracts import ORDERS, STAGE_MANIFEST, STAGE_RUNS
from tapelens.streaming import ingest

HEAD = "SeqNum,OrderId,OrderType,Ext,Time,Price,Volume,Level,BrokerNo,VolumePre,SendTime"
GOOD = f"{HEAD}\n1,1001,1,000,92048,10.5,100,1,0746,0,1767600000000000000\n2,1002,x,110,93000,11,5,,0,,bad\n3,,1,000,bad,NULL,5,,0,,\n"
D2, D5, D6 = (dt.date(2026, 1, d) for d in (2, 5, 6))


def archive(folder, day, members):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / f"{day:%Y%m%d}.zip", "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "raw"
    archive(folder, D2, {"order/00001.csv": GOOD, "order/00002.csv": GOOD, "trade/1.csv": "x\n1\n"})
    archive(folder, D5, {"order/00001.csv": GOOD, "order/bad1.csv": b"\xff\xfe", "order/bad2.csv": "a\n1,2\n", "order/lacks.csv": "SeqNum,OrderId,Time,Volume\n1,2,92000,3\n"})
    return folder


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_manifest_of_what_was_written(spark, source, tmp_path):
    archive(source, D6, {"order/bad.csv": b"\xff", "trade/1.csv": "x\n1\n"})
    archive(source, dt.date(2026, 1, 7), {"trade/1.csv": "x\n1\n"})
    root = str(tmp_path / "stage")
    made = {r.date.day: r for r in ingest.stage_dates(spark, str(source), ORDERS, root, "v1").collect()}
    assert [(f.name, f.dataType) for f in ingest.read_manifest(spark, root).schema] == [(f.name, f.dataType) for f in StructType.fromDDL(STAGE_MANIFEST)]
    two, five = made[2], made[5]
    assert (two.status, two.raw_row_count, two.row_count, two.rejected_row_count, two.source_member_count, two.failed_member_count) == ("completed", 6, 4, 2, 2, 0)
    assert two.required_null_counts == {"SeqNum": 0, "OrderId": 2, "Time": 2, "Price": 2, "Volume": 0}
    assert two.rejection_reason_counts == {"null_required_input:OrderId": 2, "invalid_required_format:Time": 2, "null_required_input:Price": 2}
    assert (two.send_time_parse_failure_count, two.min_time, two.max_time, two.year, two.version) == (2, "092048", "093000", 2026, "v1")
    sizes = sum(f.stat().st_size for f in (tmp_path / "stage/orders").glob("outcome=*/date=2026-01-02/batch=1/*.parquet"))
    assert two.output_bytes == sizes > 0 and two.output_files == 2
    assert (five.status, five.failed_member_count, [x.source_file for x in five.failed_member_examples]) == ("completed_with_member_errors", 2, ["order/bad1.csv", "order/bad2.csv"])
    assert five.rejection_reason_counts["missing_required_column:Price"] == 1 and "more cells" in five.failed_member_examples[1].error
    assert made[6].status == "failed" and made[6].error.startswith("all source members failed; first: UnicodeDecodeError")
    assert (made[7].status, made[7].error) == ("failed", "no source members")
    table = ingest.stage_table(spark, root, ORDERS)
    assert table.columns == ORDERS.schema.names and table.count() == 6
    assert rows(ingest.quarantine_table(spark, root, ORDERS).where("date = '2026-01-02'"), "source_file", "row_num_in_file") == [("order/00001.csv", 3), ("order/00002.csv", 3)]
    assert '"Time":"bad"' in ingest.quarantine_table(spark, root, ORDERS).where("source_file = 'order/00001.csv'").first().raw
    # Failed dates stay open and are staged again; finished ones are not.
    archive(source, D6, {"order/bad.csv": GOOD})
    again = ingest.stage_dates(spark, str(source), ORDERS, root, "v1")
    assert rows(again, "date", "status") == [(D6, "completed"), (dt.date(2026, 1, 7), "failed")]
    assert ingest.stage_table(spark, root, ORDERS).count() == 8


def test_reads_prune_partitions_when_they_run(spark, source, tmp_path):
    root = str(tmp_path / "stage")
    ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2])
    ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2], overwrite=True)
    for old in (tmp_path / "stage/orders/outcome=kept").glob("date=*/batch=1/*.parquet"):
        old.write_bytes(b"no longer read")
    table = ingest.stage_table(spark, root, ORDERS)
    assert "dynamicpruning" in table._jdf.queryExecution().executedPlan().toString()
    assert len(table.collect()) == 4
    with pytest.raises(Exception, match="not a Parquet file|checksum|Checksum"):
        ingest.stored(spark, root, ORDERS).collect()
    shutil.rmtree(tmp_path / "stage/orders/outcome=kept/date=2026-01-02/batch=1")
    assert rows(ingest.partition_states(spark, root, ORDERS), "batch", "state") == [(1, "replaced"), (2, "named")]


def test_other_dates_after_a_finished_run(spark, source, tmp_path):
    root = str(tmp_path / "stage")
    assert rows(ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2]), "date", "batch") == [(D2, 1)]
    assert rows(ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D5]), "date", "batch") == [(D5, 2)]
    assert ingest.stage_dates(spark, str(source), ORDERS, root, "v1").count() == 0
    assert rows(ingest.day_states(ingest.read_manifest(spark, root)), "date", "status", "row_count") == [(D2, "completed", 4), (D5, "completed_with_member_errors", 2)]
    with pytest.raises(ValueError, match="version v1"):
        ingest.stage_dates(spark, str(source), ORDERS, root, "v2")
    with pytest.raises(ValueError, match="no archive for 2026-01-09"):
        ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [dt.date(2026, 1, 9)])


def test_runs_that_did_not_finish(spark, source, tmp_path, monkeypatch):
    root = str(tmp_path / "stage")
    with monkeypatch.context() as m:
        m.setattr(ingest, "counts_of", lambda *a: 1 / 0)  # killed after the data, before the manifest
        with pytest.raises(ZeroDivisionError):
            ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2])
    assert ingest.stage_table(spark, root, ORDERS).count() == 0
    with pytest.raises(ValueError, match="other dates did not finish"):
        ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D5])
    assert rows(ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2]), "date", "batch") == [(D2, 1)]
    assert ingest.stage_table(spark, root, ORDERS).count() == 4 and ingest.stored(spark, root, ORDERS).count() == 6
    runs = ingest.read_manifest(spark, root, STAGE_RUNS, "runs")
    assert rows(runs, "run", "status") == [(1, "completed")]


def test_orphans_and_stale_rows(spark, source, tmp_path):
    root = str(tmp_path / "stage")
    ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2])
    kept = tmp_path / "stage/orders/outcome=kept"
    shutil.copytree(kept / "date=2026-01-02", kept / "date=2026-01-03")
    assert ingest.stage_table(spark, root, ORDERS).count() == 4  # what no manifest row names is not read
    with pytest.raises(ValueError, match="without a manifest row: 2026-01-03, batch 1"):
        ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D5])
    shutil.rmtree(kept / "date=2026-01-03")
    shutil.rmtree(kept / "date=2026-01-02")
    assert rows(ingest.partition_states(spark, root, ORDERS), "date", "state") == [(D2, "stale")]
    assert rows(ingest.stage_dates(spark, str(source), ORDERS, root, "v1", [D2]), "date", "batch") == [(D2, 2)]
    assert ingest.stage_table(spark, root, ORDERS).count() == 4


def test_stream_with_manifest(spark, source, tmp_path, monkeypatch):
    root, state = str(tmp_path / "stage"), str(tmp_path / "state")
    run = lambda: ingest.stage_stream(spark, str(source), ORDERS, root, "v1", state)
    with monkeypatch.context() as m:
        m.setattr(ingest, "counts_of", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
            run()
    run()  # the batch again, under its own number
    manifest = ingest.read_manifest(spark, root)
    assert rows(manifest, "date", "batch", "row_count") == [(D2, 1, 4), (D5, 1, 2)] and ingest.stored(spark, root, ORDERS).where("outcome = 'kept'").count() == 6
    run()
    assert ingest.read_manifest(spark, root).count() == 2
    archive(source / "late", D2, {"order/00003.csv": GOOD})
    archive(source, D6, {"order/00001.csv": GOOD})
    run()
    states = ingest.day_states(ingest.read_manifest(spark, root))
    assert rows(states, "date", "row_count", "batches", "reopened", "status") == [(D2, 6, 2, True, "completed"), (D5, 2, 1, False, "completed_with_member_errors"), (D6, 2, 1, False, "completed")]
    assert ingest.stage_table(spark, root, ORDERS).count() == 10


def test_counts_sort_no_rows_of_a_day(spark):
    """Neither rows nor members of a day are sorted whole, and first failures are those of all members."""
    form = ingest.stored_schema(ORDERS)
    row = lambda **x: tuple(({"date": D2, "table_name": "orders", "outcome": "kept", "batch": 1} | x).get(c) for c in form.names)
    made = [row(source_file=f"m{i:02}", Time=f"{90000 + i:06}", SeqNum=i, SendTimeRaw="x") for i in range(40)]
    made += [row(source_file=f"m{i:02}", outcome="failed", error=e) for i in range(12, 30) for e in ("late", "early")]
    made += [row(source_file="m50", outcome="rejected", Time="000001", reasons=["null_required_input:SeqNum"]), row(date=D5, source_file="m01", outcome="failed", error="broken")]
    counts = ingest.counts_of(spark.createDataFrame(made, form), ORDERS)
    two, five = (r for r in counts.orderBy("date").collect())
    assert (two.raw_row_count, two.row_count, two.rejected_row_count, two.source_member_count, two.failed_member_count) == (41, 40, 1, 23, 18)
    assert [tuple(x) for x in two.failed_member_examples] == [(f"m{i:02}", "early") for i in range(12, 22)]
    assert (two.min_time, two.max_time, two.send_time_parse_failure_count, two.status, two.error) == ("090000", "090039", 40, "completed_with_member_errors", None)
    assert two.required_null_counts == {"SeqNum": 1, "OrderId": 1, "Time": 0, "Price": 1, "Volume": 1} and two.rejection_reason_counts == {"null_required_input:SeqNum": 1}
    assert (five.raw_row_count, five.source_member_count, five.min_time, five.status, five.rejection_reason_counts) == (0, 0, None, "failed", {})
    assert five.error == "all source members failed; first: broken"
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    assert all("min(error" in x for x in plan.splitlines() if "SortAggregate" in x) and plan.count("Window [") <= plan.count("WindowGroupLimit")
