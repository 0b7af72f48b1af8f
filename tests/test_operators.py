"""Operators on small literal tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapelens.contracts import ORDER_RULES
from tapelens.operators import coverage, gates, linkage, probes, profile, staging, universe, verified

T0 = dt.datetime(2026, 1, 5, 9, 30)
ORDER = "date string, OrderId bigint, SeqNum bigint, OrderType int, SendTime timestamp, Time string, row bigint"
TRADE = "date string, BidOrderID bigint, AskOrderID bigint, SeqNum bigint, SendTime timestamp, Time string, row bigint"


def books(spark, sendtime=T0):
    orders = spark.createDataFrame([("d", 1001, 1, 1, sendtime, "093000", 1), ("d", 1002, 2, 1, sendtime, "093000", 2), ("d", 1003, 3, 1, sendtime, "093000", 3)], ORDER)
    later = T0 + dt.timedelta(seconds=1) if sendtime else None
    trades = spark.createDataFrame([("d", 1001, 0, None, later, "093000", 1), ("d", 1002, 1003, None, later, "093000", 2), ("d", 0, 9999, None, later, "093000", 3)], TRADE)
    return orders, trades


def test_linkage_with_times(spark):
    orders, trades = books(spark)
    r = linkage.day_record(trades, orders, ["date"], ["date"]).first()
    assert (r.bid_present_count, r.bid_id_equal_count, r.ask_present_count, r.ask_id_equal_count) == (2, 2, 2, 1)
    assert (r.both_present_count, r.both_id_equal_count, r.combined_negative_lag_count) == (1, 1, 0)
    assert {r.id_equality_status, r.time_anchor_status, r.lag_validation_status, r.lag_linkage_status, r.linkage_feasibility_status} == {"pass"}


def test_linkage_without_times(spark):
    orders, trades = books(spark, None)
    r = linkage.day_record(trades, orders, ["date"], ["date"]).first()
    assert (r.id_equality_status, r.time_anchor_status, r.lag_linkage_status, r.linkage_feasibility_status) == ("pass", "unavailable", "not_verifiable", "warn")


def test_linkage_without_trades_of_orders(spark):
    orders, trades = books(spark)
    r = linkage.day_record(trades.withColumns({"BidOrderID": F.lit(0).cast("bigint"), "AskOrderID": F.lit(None).cast("bigint")}), orders, ["date"], ["date"]).first()
    assert (r.combined_present_count, r.linkage_feasibility_status) == (0, "not_applicable")


def test_time_anchor(spark):
    orders, trades = books(spark)
    r = linkage.time_anchor(trades.where("AskOrderID <> 9999"), orders, ["date"], ["date"]).first()
    assert (r.edge_count, r.matched_edge_count, r.same_time_rate, r.coarse_time_anchor_status) == (3, 3, 1.0, "weak_pass")
    blank = orders.withColumn("Time", F.lit(None).cast("string"))
    assert linkage.time_anchor(trades, blank, ["date"], ["date"]).first().coarse_time_anchor_status == "unavailable"


def test_lifecycle_and_trajectories(spark):
    orders = spark.createDataFrame([("d", 1001, 1, 1, None, "1", 1), ("d", 1001, 2, 2, None, "1", 2), ("d", 1002, 3, 1, None, "1", 3)], ORDER)
    trades = spark.createDataFrame([("d", 1001, 0, None, None, "1", 1), ("d", 0, 1002, None, None, "1", 2)], TRADE)
    r = probes.lifecycle(orders, trades, ["date"], ["row"], ["row"]).first()
    assert (r.distinct_orderids, r.linked_orderids, r.multi_event_orderids, r.single_trade_orderids, r.trade_seqnum_rows) == (2, 2, 1, 2, 0)
    p = probes.ordertype_probe(orders, ["date"], ["row"]).first()
    assert (p.single_type_orderids, p.multi_type_orderids, p.top_OrderType, p.pattern_count, p.status) == (1, 1, "1:2,2:1", 2, "weak_pass")
    assert {r.pattern for r in probes.trajectories(orders, ["date"], ["row"]).collect()} == {"1", "1,2"}


def test_direction_contrast(spark):
    times = ["090000", "093100", "100000", "110000", "123000", "133000", "150000", "160001"]
    rows = [(f"d{day}", day * 8 + i, d, float(p), 10, 0 if d == 0 else 1, 0 if d == 0 else 2, t) for day in range(3) for i, (d, p, t) in enumerate(zip([0, 1, 2, 1, 2, 1, 2, 0], [100, 101, 100, 100, 101, 102, 101, 101], times, strict=True))]
    trades = spark.createDataFrame(rows, "date string, SeqNum bigint, Dir int, Price double, Volume bigint, BidOrderID bigint, AskOrderID bigint, Time string").withColumn("chunk", F.floor(F.col("SeqNum") / 3))
    moves = probes.tick_moves(trades, ["date"], "chunk", ["SeqNum"])
    daily = probes.direction_contrast(moves, ["date"])
    got = {(r.date, r.Dir): r for r in daily.collect()}
    assert len(got) == 9
    one, zero = got["d0", 1], got["d0", 0]
    assert (one.row_count, one.both_present_rate, round(one.uptick_rate, 4), zero.neither_side_rate) == (3, 1.0, 0.6667, 1.0)
    gaps = probes.contrast_gaps(daily, probes.bucket_mix(moves, ["date"]), ["date"])
    year = probes.contrast_yearly(gaps.withColumn("year", F.lit(2026)), ["year"]).first()
    assert (year.days_run, year.linkage_gap_avg, year.uptick_sign_consistent) == (3, 0.0, True)


def test_two_level_lag_equals_a_plain_one(spark):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), i, draw.choice([None, *range(50)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, i int, Price int").withColumn("chunk", F.floor(F.col("i") / 37)).where("chunk % 5 <> 2").repartition(7)
    two = profile.chunked_lag(df, ["g"], "chunk", ["i"], ["Price"]).select("g", "i", "prev_Price")
    plain = df.select("g", "i", F.lag("Price").over(Window.partitionBy("g").orderBy("i")).alias("prev_Price"))
    assert two.exceptAll(plain).count() == plain.exceptAll(two).count() == 0


def test_edges_are_the_present_ids(spark):
    _, trades = books(spark)
    assert linkage.edges(trades, ["date"]).count() == trades.where("BidOrderID <> 0").count() + trades.where("AskOrderID <> 0").count()


def test_rules_and_profile(spark):
    rows = [("d", 1, 5.0, 1, 1, -1, 0, "090000", T0), ("d", 2, 5.0, 0, None, 0, 0, "090000", T0)]
    df = spark.createDataFrame(rows, "date string, SeqNum bigint, Price double, Volume bigint, OrderId bigint, Level int, VolumePre bigint, Time string, SendTime timestamp")
    got = {r.rule_name: r.status for r in profile.rule_profile(df, ["date"], ORDER_RULES, F.lit(2026)).collect()}
    assert got["level_ge_0"] == "fail" and got["orderid_not_null"] == "fail" and got["volume_ge_0"] == "pass" and got["sendtime_not_null"] == "pass"
    assert {r.rule_name: r.status for r in profile.rule_profile(df, ["date"], ORDER_RULES, F.lit(2025)).collect()}["sendtime_not_null"] == "not_applicable"
    fields = {r.field: (r.null_count, r.status) for r in profile.field_profile(df, ["date"], ["OrderId", "Time"]).collect()}
    assert fields == {"OrderId": (1, "pass"), "Time": (0, "pass")}
    assert profile.hour_map(profile.hour_histogram(df, ["date"]), ["date"]).first().hour_bucket_profile == '{"17":2}'


def test_reconciliation(spark):
    parts = spark.createDataFrame([(2025, "d", "orders", 10, 10, 0, 0), (2025, "d", "trades", 10, 8, 2, 0), (2025, "e", "trades", 10, 8, 1, 0)], "year int, date string, table_name string, raw_row_count int, row_count int, rejected_row_count int, failed_member_count int")
    none = parts.limit(0)
    got = {(r.date, r.table_name): r.reconciliation_status for r in coverage.reconcile(parts, none, none.select("date")).collect()}
    assert got == {("d", "orders"): "pass", ("d", "trades"): "warn", ("e", "trades"): "fail"}


def test_sessions(spark):
    orders = spark.createDataFrame([("d", 1, "am"), ("d", 1, "pm"), ("d", 2, "am")], "date string, OrderId bigint, Session string")
    trades = spark.createDataFrame([("d", 1)], "date string, BidOrderID bigint")
    assert probes.session_probe(orders.drop("Session"), trades, ["date"]).first().status == "not_run"
    r = probes.session_probe(orders, trades, ["date"]).first()
    assert (r.cross_session_orders, r.distinct_sessions, r.status, r.trades_session_rate) == (1, 2, "weak_pass", 0.0)


def test_policy(spark):
    policy = [{"table": "orders", "field": f, "bucket": b} for f, b in (("OrderId", "admit_now"), ("OrderSideVendor", "admit_with_explicit_caveat_only"), ("Level", "keep_out_for_now"))]
    policy += [{"table": "orders", "field": "SendTime", "bucket": "admit_now", "admit_years": [2026]}, {"table": "trades", "field": "Dir", "bucket": "admit_with_explicit_caveat_only"}]
    plain = verified.resolve(policy, "orders", 2025)
    assert plain["outputs"] == ["OrderId"] and plain["variant"] == "verified_orders" and not plain["skip"]
    asked = verified.resolve(policy, "orders", 2026, ("OrderSideVendor",))
    assert asked["inputs"] == ["OrderId", "Ext", "SendTime"] and asked["variant"] == "verified_orders__caveat_OrderSideVendor"
    assert verified.resolve(policy, "trades", 2025, ("OrderSideVendor",))["skip"]
    df = spark.createDataFrame([("d", 7, "110", T0, 3)], "date string, OrderId bigint, Ext string, SendTime timestamp, Level int")
    assert verified.project(df, asked).columns == ["date", "OrderId", "OrderSideVendor", "SendTime"] and verified.project(df, asked).first().OrderSideVendor == "1"
    assert verified.unlisted(df, policy, "orders") == ["Ext"]
    with pytest.raises(ValueError, match="missing columns: Ext"):
        verified.project(df.drop("Ext"), asked)
    with pytest.raises(ValueError, match="unknown bucket"):
        verified.resolve([{"table": "orders", "field": "x", "bucket": "maybe"}], "orders", 2025)


def test_verified_days_replace_each_other(spark, tmp_path):
    day = lambda d, n: spark.range(n).select(F.lit(d).cast("date").alias("date"), F.col("id").alias("OrderId"))
    for d, n in (("2025-01-02", 3), ("2025-01-03", 4), ("2025-01-02", 5)):
        verified.write_verified(day(d, n), str(tmp_path), "verified_orders")
    r = verified.summary(spark.read.parquet(str(tmp_path / "verified_orders")), ["year"]).first()
    assert (r.output_row_count, r.partition_count) == (9, 2)


def test_seed_merge_keeps_the_first_values(spark):
    form = "instrument_key string, listing_date date, source_label string"
    base = spark.createDataFrame([("00823", None, "base")], form)
    more = spark.createDataFrame([("00823", dt.date(2005, 11, 25), "more"), ("00001", None, "more")], form)
    got = sorted(map(tuple, universe.merge_seeds([base, more], ["listing_date", "source_label"]).collect()))
    assert got == [("00001", None, "more"), ("00823", dt.date(2005, 11, 25), "base")]
    merged = universe.merge_seeds([base, more], ["listing_date", "source_label"])
    assert sorted(map(tuple, universe.merge_seeds([merged, merged], ["listing_date", "source_label"]).collect())) == got


def test_seeds_of_different_columns(spark):
    """A source may lack columns, or all may; values keep the label and date of the row they are from."""
    base = spark.createDataFrame([("00823", 1.5, "base"), ("00823", 1.5, "base"), (None, 2.0, "base")], "instrument_key string, float_mktcap_hkd double, source_label string")
    more = spark.createDataFrame([("00823", "reit", dt.date(2026, 1, 2)), ("00001", None, dt.date(2026, 1, 3))], "instrument_key string, instrument_family string, as_of_date date")
    got = {r.instrument_key: r for r in universe.merge_seeds([base, more], ["float_mktcap_hkd", "instrument_family", "southbound_eligible"], provenance=True).collect()}
    assert set(got) == {"00823", "00001", None}
    r = got["00823"]
    assert (r.float_mktcap_hkd, tuple(r.float_mktcap_hkd_from), r.instrument_family, tuple(r.instrument_family_from)) == (1.5, (0, "base", None), "reit", (1, None, dt.date(2026, 1, 2)))
    assert got["00001"].instrument_family is None and got["00001"].instrument_family_from is None and got[None].float_mktcap_hkd == 2.0
    assert universe.merge_seeds([base.limit(0), more.limit(0)], ["instrument_family"]).count() == 0
    bare = universe.normalise_seed(spark.createDataFrame([("1.HK", "a"), ("HK.00001", "b")], "instrument_key string, line string"), ["line"]).collect()
    assert [(r.instrument_key, r.source_label, r.listing_date) for r in bare] == [("00001", "instrument_profile_seed", None)]


def test_profile_says_where_it_is_from(spark):
    seen = spark.createDataFrame([(k, dt.date(2026, 1, 2)) for k in ("00001", "02800", "89300", "00823", "77777")], "instrument_key string, date date")
    seed = spark.createDataFrame([("00823", "reit", "curated", "A note.", "label")], "instrument_key string, instrument_family string, instrument_family_source string, instrument_family_note string, source_label string")
    keys = universe.universe(seen)
    got = {r.instrument_key: r for r in universe.instrument_profile(keys, seen, seen.limit(0), seed).collect()}
    assert len(got["00001"]) == 21
    assert (got["00823"].instrument_family_source, got["00823"].instrument_family_note, got["00823"].source_label, got["00823"].reference_join_applied) == ("curated", "A note.", "label", True)
    assert (got["02800"].instrument_family_source, got["02800"].instrument_family_note[:45]) == ("hkex_stock_code_allocation_plan", "HKEX Stock Code Allocation Plan ETF range: 02")
    assert got["89300"].instrument_family_note.endswith("RMB derivative warrant range: 89200-89599.") and got["77777"].instrument_family_source == "raw_universe_only_unclassified"
    assert (got["00001"].stock_research_candidate_status, got["77777"].stock_research_candidate_status) == ("candidate_from_low_code_listed_security_unclassified", "not_in_stock_research_candidate_lane")
    assert not universe.instrument_profile(keys, seen, seen, seed.limit(0)).first().reference_join_applied


def test_policy_check(spark):
    policy = gates.TextPolicy((("trades", "Dir", ("vendor-defined", "unverified-semantic")), ("orders", "Level", ("vendor-defined",)), ("orders", "OrderId", ("official-family-compatible",))), (("Level", "keep_out_for_now"), ("Dir", "admit_with_explicit_caveat_only")), ("signed_flow", "true direction"), ("broker_identity",), ("reference_lookup",))
    texts = ["The `Dir` and Dir, not Direction or xDir or Dir_2; dir.", "Signed\n\u3000 flow by Level is not research-verified; source_layer: a reference\tlookup.", "`Level`", None, "Broker IDENTITY of the OMD-C  family: OrderId1 (OrderId)"]
    got = {r.doc_id: r for r in gates.policy_check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), policy).collect()}
    assert [tuple(m) for m in got[0].field_mentions] == [("trades", "Dir", 2, ["vendor-defined", "unverified-semantic"])] and got[0].mentioned_caveat_only_fields == ["Dir"] and not got[0].missing_keep_out_caveat
    assert got[0].mentioned_unverified_fields == got[0].mentioned_vendor_defined_fields == ["Dir"]
    assert got[1].avoid_phrase_hits == ["signed_flow"] and got[1].has_unverified_caveat and got[1].has_source_layer_phrase and got[1].has_reference_label and not got[1].missing_keep_out_caveat
    assert got[2].mentioned_keep_out_fields == ["Level"] and got[2].missing_keep_out_caveat and got[2].mentioned_unverified_fields == []
    assert got[3].field_mentions == [] and not got[3].has_source_layer_phrase
    assert got[4].reference_avoid_label_hits == ["broker_identity"] and got[4].has_provenance_phrase and [m.field for m in got[4].field_mentions] == ["OrderId"]


def test_snapshot_and_ranges(spark):
    rows = spark.createDataFrame([("HK.02800", "ETF", None, 1), ("HK.00001", "STOCK", "1970-01-01", 2)], "code string, stock_type string, listing_date string, line int")
    got = {r.instrument_key: (r.instrument_family, r.listing_date) for r in universe.collapse_snapshot(rows, ["line"]).collect()}
    assert got == {"02800": ("exchange_traded_fund", None), "00001": (None, None)}
    codes = spark.createDataFrame([("02800",), ("02850",), ("87001",), ("99999",), ("x",)], "instrument_key string")
    assert [r[0] for r in codes.select(universe.range_family()).collect()] == ["exchange_traded_fund", None, "reit_or_unit_trust_non_etf", "stock_connect_security", None]


def test_gates(spark):
    manifest = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("c", 2)], "k string, row_count int")
    outputs = spark.createDataFrame([("a", 1), ("b", 1), ("z", 9)], "k string, row_count int")
    tasks = spark.createDataFrame([(x,) for x in "abcd"], "k string")
    got = {r.k: r.state for r in gates.manifest_state(tasks, manifest, outputs, ["k"]).collect()}
    assert got == {"a": "done", "b": "duplicate", "c": "stale", "d": "todo", "z": "orphan"}
    areas = spark.createDataFrame([("order_lifecycle", "pass", "blocking"), ("trade_dir", "weak_pass", "blocking"), ("order_type", "weak_pass", "blocking"), ("session", "not_run", "context_only")], "semantic_area string, status string, blocking_level string")
    assert gates.bridge(areas).count() == 11
    strict = {r.research_module: (r.final_status, r.strict_status) for r in gates.bridge(areas).where("listed = 'blocked'").collect()}
    assert strict["execution_realism_or_fill_simulation"] == ("allow", "block") and strict["signed_flow"] == ("block", "block")


def test_results_do_not_depend_on_partitions(spark):
    from tapelens.plans.adapters import orders, trades

    sf = "/root/testdata/sf0.001"
    one, many = (linkage.day_record(trades(spark, sf).repartition(n), orders(spark, sf).repartition(n), ["year"], []) for n in (1, 17))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_exact_percentiles(spark):
    """Against numpy, over ties, single values, null groups and values far apart."""
    import numpy as np

    draw = np.random.default_rng(6)
    groups = {"a": draw.normal(size=501).round(1).tolist(), "b": [5.0], "c": [1.0, 1e12, 2.0, 2.0], None: [3.0, 3.0, 3.0, 7.0]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("d", None)]
    got = {r.key.g: r for r in probes.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p50": 0.5, "p90": 0.9, "p99": 0.99}).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, share in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
            assert abs(got[g][name] - np.quantile(values, share)) <= 1e-9 * max(1, abs(np.quantile(values, share)))


def test_broker_codes_are_normalised(spark):
    rows = [(1, " 7 "), (1, "0007"), (1, "12345"), (1, ""), (1, None), (1, "0"), (1, "x")]
    codes = spark.createDataFrame([("7",), ("12345",)], "code string")
    r = probes.broker_profile(spark.createDataFrame(rows, "year int, BrokerNo string"), ["year"], codes).first()
    assert (r.tested_rows, r.nonnull_count, r.zero_count, r.distinct_codes, r.matched_codes, r.matched_rows) == (7, 5, 1, 4, 2, 3)
    assert r.unmatched_sample == "0000:1,x:1" and r.zero_rate == 1 / 7


def test_members_outside_a_group_folder_have_no_group(spark):
    rows = [("20250218/OrderAdd/1.csv", 2025), ("20250218/1.csv", 2025), ("order/1.csv", 2026), ("1.csv", 2026)]
    got = spark.createDataFrame(rows, "f string, y int").select(staging.raw_group(F.col("f"), F.col("y")).alias("g")).collect()
    assert [r.g for r in got] == ["OrderAdd", None, "order", None]
