"""Publishing of stage days with metadata: what is recorded, what is done again, what is refused."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from tapelens.operators import verified

POLICY = [
    {"table": "orders", "field": "OrderId", "bucket": "admit_now"},
    {"table": "orders", "field": "instrument_key", "bucket": "admit_now"},
    {"table": "orders", "field": "OrderSideVendor", "bucket": "admit_with_explicit_caveat_only"},
    {"table": "orders", "field": "Level", "bucket": "keep_out_for_now"},
]
DAYS = [dt.date(2025, 12, 30), dt.date(2026, 1, 2), dt.date(2026, 1, 5)]


@pytest.fixture
def stage(spark):
    rows = [(d, i, "110", f"order/{i:05d}.csv", 3) for k, d in enumerate(DAYS) for i in range(10 * (k + 1))]
    return spark.createDataFrame(rows, "date date, OrderId bigint, Ext string, source_file string, Level int")


def test_metadata_of_written_days(spark, stage, tmp_path):
    root = str(tmp_path)
    plan = verified.resolve(POLICY, "orders", 2026, ("OrderSideVendor",))
    made = {r.date: r for r in verified.publish(stage, root, "orders", plan, DAYS[:2]).collect()}
    old, new = made[DAYS[0]], made[DAYS[1]]
    assert (old.research_time_grade, new.research_time_grade) == ("coarse_only", "fine_ok")
    assert (new.year, new.table_name, new.verified_table_name, new.input_row_count, new.output_row_count) == (2026, "orders", "verified_orders__caveat_OrderSideVendor", 20, 20)
    assert (new.included_columns, new.included_caveat_columns, new.excluded_columns) == (["OrderId", "instrument_key", "OrderSideVendor"], ["OrderSideVendor"], ["Level"])
    assert (new.contains_caveat_fields, new.reference_join_applied, new.admission_rule, new.source_layer, new.verified_policy_version) == (True, False, "admit_now_plus_caveat_only", "candidate_cleaned", "2026-03-15")
    files = list(tmp_path.glob("verified_orders__caveat_OrderSideVendor/year=2026/date=2026-01-02/*.parquet"))
    assert new.output_bytes == sum(f.stat().st_size for f in files) and new.output_files == len(files)
    # A finished run is followed by one of other days; nothing is published twice.
    assert [r.date for r in verified.publish(stage, root, "orders", plan).collect()] == DAYS[2:]
    assert verified.publish(stage, root, "orders", plan).count() == 0
    total = verified.totals(verified.read_manifest(spark, root)).first()
    assert (total.partition_count, total.output_row_count, total.min_date, total.max_date) == (3, 60, DAYS[0], DAYS[2]) and total.output_bytes > new.output_bytes
    again = verified.publish(stage, root, "orders", plan, DAYS[:1], overwrite=True)
    assert [(r.date, r.batch) for r in again.collect()] == [(DAYS[0], 3)] and verified.read_manifest(spark, root).count() == 3


def test_orphans_and_stale_days(spark, stage, tmp_path, monkeypatch):
    root, plan = str(tmp_path), verified.resolve(POLICY, "orders", 2026)
    with monkeypatch.context() as m:
        m.setattr(verified, "metadata", lambda *a: 1 / 0)  # killed before its metadata
        with pytest.raises(ZeroDivisionError):
            verified.publish(stage, root, "orders", plan, DAYS[1:2])
    with pytest.raises(ValueError, match="without a metadata row: 2026-01-02"):
        verified.publish(stage, root, "orders", plan)
    verified.publish(stage, root, "orders", plan, DAYS[:1])
    verified.publish(stage, root, "orders", plan, overwrite=True)
    assert {(r.date, r.state) for r in verified.output_states(spark, root, plan["variant"]).collect()} == {(d, "done") for d in DAYS}
    shutil.rmtree(tmp_path / "verified_orders/year=2026/date=2026-01-05")
    assert [r.date for r in verified.output_states(spark, root, plan["variant"]).where("state = 'stale'").collect()] == DAYS[2:]
    assert [r.date for r in verified.publish(stage, root, "orders", plan).collect()] == DAYS[2:]
    assert spark.read.parquet(str(tmp_path / "verified_orders")).groupBy().agg(F.count("*")).first()[0] == 60
