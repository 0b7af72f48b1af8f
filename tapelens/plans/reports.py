"""Queries of verified projections, the instrument universe, gates and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelens.contracts import CANDIDATE, CODE_RANGES, NO_CANDIDATE, NO_SOURCE, RANGE_NOTES, RANGE_NOTES_BY_START, RANGE_SOURCE, UNCLASSIFIED_NOTE
from tapelens.functions.columns import zero_pad
from tapelens.operators import gates, probes, universe, verified
from tapelens.plans.adapters import EVENT_TRADES, ORDER_EVENTS, TRADES, event_trades, order_events, read, trades
from tapelens.plans.common import rounded
from tapelens.plans.probes import _BOTH, _GROUPS, _MOVES, year_gaps
from tapelens.sources.files import code_list, common_dates, scratch, select_dates

#: A policy over the adapted trades.
POLICY = [
    {"table": "trades", "field": "TickID", "bucket": "admit_now"},
    {"table": "trades", "field": "Time", "bucket": "admit_now"},
    {"table": "trades", "field": "Price", "bucket": "admit_now"},
    {"table": "trades", "field": "SendTime", "bucket": "admit_now", "admit_years": [2026]},
    {"table": "trades", "field": "instrument_key", "bucket": "admit_now"},
    {"table": "trades", "field": "Dir", "bucket": "admit_with_explicit_caveat_only"},
    {"table": "trades", "field": "BrokerNo", "bucket": "keep_out_for_now"},
]


def projected(spark, sf_dir):
    return verified.project(trades(spark, sf_dir), verified.resolve(POLICY, "trades", 2025))


def caveat(spark, sf_dir):
    plan = verified.resolve(POLICY, "trades", 2025, ("Dir",))
    out = verified.project(trades(spark, sf_dir), plan)
    return out.withColumn("variant", F.lit(plan["variant"])).groupBy("variant", "Dir").agg(F.count("*").alias("row_count"), F.count_distinct("instrument_key").alias("instruments"))


def verified_summary(spark, sf_dir):
    return verified.summary(trades(spark, sf_dir), ["year"])


def verified_manifest(spark, sf_dir):
    """Metadata of two published variants, with months for days: what is in them, and whether the files have bytes."""
    root, rows = scratch(spark, "verified"), trades(spark, sf_dir).withColumn("date", F.trunc("date", "month"))
    for caveats in ((), ("Dir",)):
        verified.publish(rows, root, "trades", verified.resolve(POLICY, "trades", 2025, caveats))
    out = verified.read_manifest(spark, root)
    lists = {c: F.array_join(c, ",") for c in ("included_columns", "included_caveat_columns", "excluded_columns")}
    return out.withColumns(lists).withColumn("has_bytes", (F.col("output_bytes") > 0) & (F.col("output_files") > 0)).drop("batch", "output_files", "output_bytes", "generated_at")


def published(spark, sf_dir):
    out = verified.published(verified.project(trades(spark, sf_dir), verified.resolve(POLICY, "trades", 2025)), "verified", "trades", 2025, "coarse_only")
    return out.groupBy("source_layer", "table_name", "year", "research_time_grade", "readonly").agg(F.count("*").alias("row_count"), F.count("query_generated_at").alias("stamped"))


def lookup(spark, sf_dir):
    names = read(spark, sf_dir, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 4, "0").alias("BrokerNo"), F.col("s_name").alias("broker_name"))
    return verified.lookup_labels(trades(spark, sf_dir), names, "BrokerNo").groupBy("BrokerNo", "broker_name", "enrichment").agg(F.count("*").alias("row_count"))


def _observed(spark, sf_dir):
    from tapelens.functions.columns import instrument_key

    rows = trades(spark, sf_dir).withColumn("instrument_key", instrument_key(F.col("source_file")))
    return rows.where("Dir = 1"), rows.where("Dir IS DISTINCT FROM 1")


def spans(spark, sf_dir):
    first, second = _observed(spark, sf_dir)
    return universe.observed_span(first.unionByName(second), "trades")


def _seed_rows(spark, sf_dir):
    n = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        F.concat((n * 37 % 100000).cast("string"), F.lit(".HK")).alias("instrument_key"),
        F.when(n % 2 == 0, "1970-01-01").otherwise("2001-02-03").alias("listing_date"),
        F.when(n % 5 == 0, "N/A").otherwise((n * 2).cast("string")).alias("float_mktcap_hkd"),
        F.when(n % 4 == 0, "Yes").when(n % 4 == 1, " 0 ").otherwise("?").alias("southbound_eligible"),
        F.when(n % 7 == 0, "reit").otherwise("").alias("instrument_family"),
        F.when(n % 7 == 0, F.col("p_brand")).otherwise("NULL").alias("instrument_family_source"),
        F.when(n % 3 == 0, F.col("p_name")).alias("instrument_family_note"),
        F.when(n % 2 == 0, "2026-03-15").otherwise("never").alias("as_of_date"),
        n.alias("line"),
    )


def seeds(spark, sf_dir):
    return universe.normalise_seed(_seed_rows(spark, sf_dir), ["line"])


def merged(spark, sf_dir):
    """Suppliers before customers, each key one of both."""
    key = lambda c: F.lpad(F.col(c).cast("string"), 12, "0").alias("instrument_key")
    first = read(spark, sf_dir, "supplier").select(key("s_suppkey"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("source_label"), F.col("s_acctbal").alias("value"))
    second = read(spark, sf_dir, "customer").select(key("c_custkey"), F.col("c_name").alias("source_label"), F.when(F.col("c_custkey") % 2 > 0, F.col("c_acctbal")).alias("value"))
    return universe.merge_seeds([first, second], ["source_label", "value"])


def merged_with_sources(spark, sf_dir):
    """Suppliers, customers and parts, none of which has all columns; every value with its source, label and date."""
    key = lambda c: F.lpad(F.col(c).cast("string"), 12, "0").alias("instrument_key")
    first = read(spark, sf_dir, "supplier").select(key("s_suppkey"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("value"), F.col("s_name").alias("source_label"))
    second = read(spark, sf_dir, "customer").select(key("c_custkey"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("kind"), F.lit("2026-01-02").cast("date").alias("as_of_date"))
    third = read(spark, sf_dir, "part").select(key("p_partkey"), F.col("p_type").alias("kind"), F.col("p_brand").alias("source_label"), F.lit("2026-01-03").cast("date").alias("as_of_date"))
    out = universe.merge_seeds([first, second, third], ["value", "kind", "as_of_date"], provenance=True)
    return out.select("instrument_key", "value", "kind", "as_of_date", *[F.col(f"{c}_from.{f}").alias(f"{c}_{f}") for c in ("value", "kind") for f in ("source", "source_label", "as_of_date")])


def snapshot(spark, sf_dir):
    n = F.col("p_partkey")
    kind = F.when(n % 5 == 0, "ETF").when(n % 5 == 1, "WARRANT").when(n % 5 == 2, "STOCK")
    rows = read(spark, sf_dir, "part").select(F.concat(F.lit("HK."), zero_pad((n % 700).cast("string"), 5)).alias("code"), kind.alias("stock_type"), F.when(n % 3 == 0, "1970-01-01").otherwise("1999-09-09").alias("listing_date"), n.alias("line"))
    return universe.collapse_snapshot(rows, ["line"])


def _profile(spark, sf_dir):
    orders, sold = _observed(spark, sf_dir)
    keys = universe.universe(orders, sold, seeds(spark, sf_dir))
    return universe.instrument_profile(keys, orders, sold, seeds(spark, sf_dir))


def instruments(spark, sf_dir):
    return _profile(spark, sf_dir)


def instrument_counts(spark, sf_dir):
    return universe.profile_summary(_profile(spark, sf_dir))


def families(spark, sf_dir):
    """The code-range table as a join: each part's code with its family."""
    code = read(spark, sf_dir, "part").select((F.col("p_partkey") * 37 % 100000).cast("int").alias("code")).distinct()
    ranges = universe.code_ranges(code)
    return code.join(F.broadcast(ranges), F.col("code").between(F.col("lo"), F.col("hi"))).groupBy("range_family").agg(F.count("*").alias("codes"), F.min("code").alias("lo_code"), F.max("code").alias("hi_code"))


def _daily(spark, sf_dir):
    """Daily results of three probes in one form."""
    life = probes.lifecycle(order_events(spark, sf_dir), event_trades(spark, sf_dir), ["date"], ["row_num_in_file"], ["row_num_in_file"])
    kinds = probes.ordertype_probe(order_events(spark, sf_dir), ["date"], ["row_num_in_file"])
    session = probes.session_probe(order_events(spark, sf_dir).drop("Session"), event_trades(spark, sf_dir).drop("Session"), ["date"])
    form = lambda df, area, n, blocking, share: df.select(F.lit(area).alias("semantic_area"), F.year("date").alias("year"), "status", F.lit(blocking).alias("blocking_level"), F.col(n).alias("tested_rows"), share.alias("share"))
    out = form(life, "order_lifecycle", "distinct_orderids", "blocking", F.col("linked_rate"))
    out = out.unionByName(form(kinds, "order_type", "tested_rows", "blocking", F.col("multi_type_rate")))
    return out.unionByName(form(session, "session", "tested_rows", "context_only", F.lit(None).cast("double")))


def _yearly(spark, sf_dir):
    return gates.yearly_summary(_daily(spark, sf_dir), ["semantic_area", "year"], ["share"])


def yearly(spark, sf_dir):
    return rounded(_yearly(spark, sf_dir))


def bridge(spark, sf_dir):
    return gates.bridge(_yearly(spark, sf_dir)).select("semantic_area", "year", "research_module", "listed", "status", "admissibility_impact", "final_status", "strict_status")


def impacts(spark, sf_dir):
    """The impact of all areas and statuses, by supplier and nation as areas and levels."""
    area = F.element_at(F.array(*map(F.lit, ("order_lifecycle", "trade_dir", "order_type", "session"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    status = F.element_at(F.array(*map(F.lit, ("pass", "weak_pass", "fail", "unknown", "not_run", "not_applicable"))), (F.col("s_suppkey") % 6 + 1).cast("int"))
    level = F.when(F.col("s_nationkey") % 2 == 0, "blocking").otherwise("context_only")
    return read(spark, sf_dir, "supplier").select("s_suppkey", gates.impact(area, status, level).alias("impact"))


def readiness(spark, sf_dir):
    found = probes.direction_distribution(trades(spark, sf_dir), ["year"]).select("year", "status", F.col("nonnull_rate").alias("nonnull_rate_avg"))
    contrast = probes.contrast_yearly(year_gaps(spark, sf_dir), ["year"])  # a year is its own day
    return rounded(gates.direction_readiness(found, contrast, ["year"]))


def methods(spark, sf_dir):
    n = F.col("p_partkey")
    pick = lambda values, by: F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))
    fields = F.array(pick(("Price", "Volume", "Time"), n), pick(("Price", "Dir", "SendTime", "BrokerNo", "Other", "Volume", "TickID"), n))
    usage = read(spark, sf_dir, "part").select(n.alias("use_id"), pick(("coarse_only", "fine_ok"), n).alias("grade"), pick(("entropy", "mutual_information", "transfer_entropy"), F.floor(n / 2)).alias("method"), fields.alias("fields"))
    return gates.method_gate(usage)


def terms(spark, sf_dir):
    found = gates.term_scan(read(spark, sf_dir, "documents"), [("license", "field"), ("the", "avoid"), ("under", "prefer")])
    return found.groupBy("doc_id").agg(F.sum("n").alias("hits"), F.sum(F.when(F.col("kind") == "avoid", F.col("n")).otherwise(0)).alias("avoid_hits"))


TEXT_POLICY = gates.TextPolicy(
    fields=(("orders", "License", ("vendor-defined",)), ("orders", "the", ("official-family-compatible",)), ("trades", "The", ("unverified-semantic", "vendor-defined")), ("trades", "Version", ())),
    buckets=(("License", "keep_out_for_now"), ("in", "keep_out_for_now"), ("and", "admit_with_explicit_caveat_only"), ("the", "admit_now")),
    avoid=("licensed_under", "of the"),
    avoid_labels=("in the", "released_under the mit"),
    prefer_labels=("public_license",),
)


def policy_check(spark, sf_dir):
    """All documents against a policy of words that they have; lists as text."""
    out = gates.policy_check(read(spark, sf_dir, "documents"), TEXT_POLICY)
    mention = F.transform("field_mentions", lambda m: F.concat_ws(":", m["table"], m["field"], m["count"].cast("string"), F.array_join(m["statuses"], "+")))
    lists = [c for c, kind in out.dtypes if kind == "array<string>"]
    return out.withColumns({"field_mentions": F.array_join(mention, ","), **{c: F.array_join(c, ",") for c in lists}})


def first_dates(spark, sf_dir):
    return select_dates(order_events(spark, sf_dir), batch=(2, 7)).groupBy("date").agg(F.count("*").alias("row_count"))


def shared_dates(spark, sf_dir):
    """Days of events that are also days on which an order was placed."""
    placed = read(spark, sf_dir, "orders").select(F.add_months(F.to_date("o_orderdate"), 324).alias("date"))
    return common_dates(order_events(spark, sf_dir), placed)


def codes(spark, sf_dir):
    lines = read(spark, sf_dir, "supplier").select(F.concat(F.col("s_nationkey").cast("string"), F.lit(" ,"), F.col("s_name")).alias("value"))
    return code_list(lines)


_KEY = "regexp_extract(source_file, '([^/]+)\\.csv$', 1)"
_PROJECT = f"SELECT date, TickID, Time, Price, {_KEY} AS instrument_key"
_SEED = """seed AS (SELECT instrument_key, CASE WHEN n % 2 <> 0 THEN DATE '2001-02-03' END AS listing_date, CASE WHEN n % 5 <> 0 THEN CAST(n * 2 AS DOUBLE) END AS float_mktcap_hkd,
    CASE n % 4 WHEN 0 THEN true WHEN 1 THEN false END AS southbound_eligible, CASE WHEN n % 7 = 0 THEN 'reit' END AS instrument_family,
    CASE WHEN n % 7 = 0 THEN p_brand END AS instrument_family_source, CASE WHEN n % 3 = 0 THEN p_name END AS instrument_family_note, CASE WHEN n % 2 = 0 THEN DATE '2026-03-15' END AS as_of_date, 'instrument_profile_seed' AS source_label
    FROM (SELECT p_brand, p_name, lpad(CAST(p_partkey * 37 % 100000 AS VARCHAR), 5, '0') AS instrument_key, p_partkey AS n, row_number() OVER (PARTITION BY p_partkey * 37 % 100000 ORDER BY p_partkey DESC) AS r FROM part) WHERE r = 1)"""
_FAMILY = "CASE " + " ".join(f"WHEN TRY_CAST(k.instrument_key AS INT) BETWEEN {lo} AND {hi} THEN '{f}'" for f, lo, hi in CODE_RANGES) + " END"
_NOTE = "CASE " + " ".join(f"WHEN TRY_CAST(k.instrument_key AS INT) BETWEEN {lo} AND {hi} THEN '{RANGE_NOTES_BY_START.get(lo, RANGE_NOTES[f])}'" for f, lo, hi in CODE_RANGES) + " END"
_PROFILE = f"""WITH {TRADES}, seen AS (SELECT *, {_KEY} AS instrument_key FROM trades), {_SEED},
 k AS (SELECT instrument_key FROM seen UNION SELECT instrument_key FROM seed),
 o AS (SELECT instrument_key, min(date) AS f, max(date) AS l, count(DISTINCT date) AS d FROM seen WHERE Dir = 1 GROUP BY 1), t AS (SELECT instrument_key, min(date) AS f, max(date) AS l, count(DISTINCT date) AS d FROM seen WHERE Dir <> 1 GROUP BY 1),
 j AS (SELECT k.instrument_key, least(o.f, t.f) AS observed_first_date, greatest(o.l, t.l) AS observed_last_date, coalesce(o.d, 0) AS observed_orders_days, coalesce(t.d, 0) AS observed_trades_days,
    listing_date, float_mktcap_hkd, southbound_eligible, seed.instrument_family AS own, {_FAMILY} AS rf, {_NOTE} AS rn, instrument_family_source AS fs, instrument_family_note AS fn, as_of_date, source_label FROM k LEFT JOIN o ON k.instrument_key = o.instrument_key LEFT JOIN t ON k.instrument_key = t.instrument_key LEFT JOIN seed ON k.instrument_key = seed.instrument_key),
 pr AS (SELECT instrument_key, observed_first_date, observed_last_date, observed_orders_days, observed_trades_days, listing_date, float_mktcap_hkd, southbound_eligible, coalesce(own, rf, 'listed_security_unclassified') AS instrument_family,
    CASE WHEN own IS NOT NULL THEN 'seed_classified' WHEN rf IS NOT NULL THEN 'official_range_classified' ELSE 'listed_security_unclassified' END AS instrument_family_status,
    CASE WHEN listing_date IS NOT NULL OR float_mktcap_hkd IS NOT NULL OR southbound_eligible IS NOT NULL OR own IS NOT NULL THEN 'seed_enriched' WHEN rf IS NOT NULL THEN 'official_range_classified' ELSE 'universe_only' END AS profile_status,
    coalesce(own, rf) IS NULL AND CAST(instrument_key AS INT) < 10000 AS stock_research_candidate, coalesce(fs, CASE WHEN rf IS NOT NULL THEN '{RANGE_SOURCE}' END, '{NO_SOURCE}') AS instrument_family_source,
    CASE WHEN own IS NOT NULL THEN fn WHEN rf IS NOT NULL THEN rn ELSE '{UNCLASSIFIED_NOTE}' END AS instrument_family_note,
    CASE WHEN coalesce(own, rf) IS NULL AND CAST(instrument_key AS INT) < 10000 THEN '{CANDIDATE[0]}' ELSE '{NO_CANDIDATE[0]}' END AS stock_research_candidate_status,
    CASE WHEN coalesce(own, rf) IS NULL AND CAST(instrument_key AS INT) < 10000 THEN '{CANDIDATE[1]}' ELSE '{NO_CANDIDATE[1]}' END AS stock_research_candidate_note,
    as_of_date, source_label, 'raw_zip_member_universe' AS source_layer, (SELECT count(*) > 0 FROM seed) AS reference_join_applied, 'instrument_profile_sidecar' AS profile_layer FROM j)"""
_LIFE = "CASE WHEN count(trade_match_count) / count(*) >= 0.02 AND count(*) FILTER (WHERE event_count > 1) / count(*) >= 0.5 THEN 'weak_pass' ELSE 'unknown' END"
_YEARLY = f"""{_BOTH}, {_GROUPS}, ot AS (SELECT date, OrderId, count(DISTINCT OrderType) AS k FROM ev WHERE OrderId <> 0 AND OrderType IS NOT NULL GROUP BY ALL),
 daily AS (SELECT 'order_lifecycle' AS semantic_area, og.date, {_LIFE} AS status, 'blocking' AS blocking_level, count(*) AS tested_rows, count(trade_match_count) / count(*) AS share FROM og LEFT JOIN tg ON og.date = tg.date AND og.OrderId = tg.OrderId GROUP BY og.date
   UNION ALL SELECT 'order_type', date, CASE WHEN count(*) FILTER (WHERE k > 1) > 0 THEN 'weak_pass' ELSE 'unknown' END, 'blocking', any_value(n), count(*) FILTER (WHERE k > 1) / count(*) FROM ot JOIN (SELECT date, count(*) AS n FROM ev GROUP BY date) USING (date) GROUP BY date
   UNION ALL SELECT DISTINCT 'session', date, 'not_run', 'context_only', 0, CAST(NULL AS DOUBLE) FROM ev),
 sev AS (SELECT *, CASE status WHEN 'fail' THEN 6 WHEN 'unknown' THEN 5 WHEN 'not_run' THEN 4 WHEN 'weak_pass' THEN 3 WHEN 'pass' THEN 2 ELSE 1 END AS s FROM daily),
 yr AS (SELECT semantic_area, CAST(year(date) AS INT) AS year, arg_max(status, s) AS status, max(blocking_level) AS blocking_level, count(*) AS days_run,
   {", ".join(f"count(*) FILTER (WHERE status = '{s}') AS days_{s}" for s in ("fail", "unknown", "not_run", "weak_pass", "pass", "not_applicable"))}, CAST(sum(tested_rows) AS BIGINT) AS tested_rows_total, round(avg(share), 6) AS share_avg FROM sev GROUP BY 1, 2)"""
_IMPACT = "CASE WHEN {s} = 'fail' THEN 'block' WHEN {a} = 'session' THEN 'requires_session_split' WHEN {a} = 'trade_dir' THEN 'requires_manual_review' WHEN {a} = 'order_type' THEN 'allow_with_caveat' WHEN {s} = 'pass' THEN 'allow' WHEN {s} IN ('weak_pass', 'not_applicable') THEN 'allow_with_caveat' WHEN {b} <> 'blocking' THEN 'allow_with_caveat' ELSE 'requires_manual_review' END"
_MODULES = """(VALUES ('order_lifecycle', 'recommended', 'order_lifecycle_shape_by_event_count'), ('order_lifecycle', 'blocked', 'execution_realism_or_fill_simulation'), ('order_lifecycle', 'blocked', 'strict_ordering_sensitive_causality'),
 ('order_type', 'recommended', 'ordertype_weak_consistency_check'), ('order_type', 'recommended', 'order_lifecycle_shape_by_event_count'), ('order_type', 'blocked', 'event_semantics_inference'),
 ('session', 'recommended', 'matched_edge_session_profile'), ('session', 'blocked', 'cross_session_unaware_research')) m(area, listed, research_module)"""

QUERIES = {
    "verified_projection": (projected, f"WITH {TRADES} {_PROJECT} FROM trades"),
    "verified_caveat_variant": (caveat, f"WITH {TRADES} SELECT 'verified_trades__caveat_Dir' AS variant, Dir, count(*) AS row_count, count(DISTINCT {_KEY}) AS instruments FROM trades GROUP BY Dir"),
    "verified_summary": (verified_summary, f"WITH {TRADES} SELECT year, count(*) AS output_row_count, count(DISTINCT date) AS partition_count, min(date) AS min_date, max(date) AS max_date FROM trades GROUP BY year"),
    "verified_manifest": (
        verified_manifest,
        f"""WITH {TRADES} SELECT CAST(year AS INT) AS year, CAST(date_trunc('month', date) AS DATE) AS date, 'trades' AS table_name, v.name AS verified_table_name, count(*) AS input_row_count, count(*) AS output_row_count, v.cols AS included_columns,
              v.caveats AS included_caveat_columns, v.out AS excluded_columns, '2026-03-15' AS verified_policy_version, 'candidate_cleaned' AS source_layer, v.rule AS admission_rule, v.caveats <> '' AS contains_caveat_fields,
              false AS reference_join_applied, CASE WHEN year = 2026 THEN 'fine_ok' ELSE 'coarse_only' END AS research_time_grade, true AS has_bytes
            FROM trades, (VALUES ('verified_trades', 'TickID,Time,Price,instrument_key', '', 'SendTime,Dir,BrokerNo', 'admit_now_only'),
              ('verified_trades__caveat_Dir', 'TickID,Time,Price,instrument_key,Dir', 'Dir', 'SendTime,BrokerNo', 'admit_now_plus_caveat_only')) v(name, cols, caveats, out, rule) GROUP BY ALL""",
    ),
    "verified_published": (published, f"WITH {TRADES} SELECT 'verified' AS source_layer, 'trades' AS table_name, 2025 AS year, 'coarse_only' AS research_time_grade, true AS readonly, count(*) AS row_count, count(*) AS stamped FROM trades"),
    "verified_lookup": (lookup, f"WITH {TRADES} SELECT BrokerNo, s_name AS broker_name, 'reference_lookup' AS enrichment, count(*) AS row_count FROM trades LEFT JOIN supplier ON BrokerNo = lpad(CAST(s_suppkey AS VARCHAR), 4, '0') GROUP BY ALL"),
    "universe_spans": (spans, f"WITH {TRADES} SELECT {_KEY} AS instrument_key, min(date) AS trades_first_seen_date, max(date) AS trades_last_seen_date, count(DISTINCT date) AS observed_trades_days FROM trades GROUP BY 1"),
    "universe_seeds": (seeds, f"WITH {_SEED} SELECT * FROM seed"),
    "universe_merge": (
        merged,
        """WITH u AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS instrument_key, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS source_label, s_acctbal AS value, 0 AS p FROM supplier
             UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0'), c_name, CASE WHEN c_custkey % 2 > 0 THEN c_acctbal END, 1 FROM customer)
           SELECT instrument_key, arg_min(source_label, p) FILTER (WHERE source_label IS NOT NULL) AS source_label, arg_min(value, p) FILTER (WHERE value IS NOT NULL) AS value FROM u GROUP BY 1""",
    ),
    "universe_merge_sources": (
        merged_with_sources,
        """WITH u AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS instrument_key, 0 AS p, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS value, NULL AS kind, NULL::DATE AS d, s_name AS l FROM supplier
             UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0'), 1, c_acctbal, c_mktsegment, DATE '2026-01-02', NULL FROM customer
             UNION ALL SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0'), 2, NULL, p_type, DATE '2026-01-03', p_brand FROM part),
           g AS (SELECT instrument_key, min(p) FILTER (WHERE value IS NOT NULL) AS pv, min(p) FILTER (WHERE kind IS NOT NULL) AS pk, arg_min(d, p) FILTER (WHERE d IS NOT NULL) AS as_of_date FROM u GROUP BY 1)
           SELECT g.instrument_key, v.value, k.kind, g.as_of_date, CAST(pv AS INT) AS value_source, v.l AS value_source_label, v.d AS value_as_of_date, CAST(pk AS INT) AS kind_source, k.l AS kind_source_label, k.d AS kind_as_of_date
           FROM g LEFT JOIN u v ON v.instrument_key = g.instrument_key AND v.p = pv LEFT JOIN u k ON k.instrument_key = g.instrument_key AND k.p = pk""",
    ),
    "universe_snapshot": (
        snapshot,
        """WITH u AS (SELECT lpad(CAST(p_partkey % 700 AS VARCHAR), 5, '0') AS instrument_key, CASE p_partkey % 5 WHEN 0 THEN 'ETF' WHEN 1 THEN 'WARRANT' WHEN 2 THEN 'STOCK' END AS stock_type, CASE WHEN p_partkey % 3 > 0 THEN DATE '1999-09-09' END AS listing_date, p_partkey AS n FROM part),
             g AS (SELECT instrument_key, arg_min(stock_type, n) FILTER (WHERE stock_type IS NOT NULL) AS stock_type, arg_min(listing_date, n) FILTER (WHERE listing_date IS NOT NULL) AS listing_date FROM u GROUP BY 1)
           SELECT *, CASE stock_type WHEN 'ETF' THEN 'exchange_traded_fund' WHEN 'WARRANT' THEN 'derivative_warrant' END AS instrument_family FROM g""",
    ),
    "universe_profile": (instruments, f"{_PROFILE} SELECT * FROM pr"),
    "universe_profile_summary": (instrument_counts, f"{_PROFILE} SELECT instrument_family, profile_status, count(*) AS instruments, count(listing_date) AS with_listing_date, count(float_mktcap_hkd) AS with_market_cap, count(*) FILTER (WHERE stock_research_candidate) AS candidates FROM pr GROUP BY ALL"),
    "universe_code_ranges": (families, "WITH c AS (SELECT DISTINCT CAST(p_partkey * 37 % 100000 AS INT) AS code FROM part), r AS (SELECT * FROM (VALUES " + ", ".join(f"('{f}', {lo}, {hi})" for f, lo, hi in CODE_RANGES) + ") t(range_family, lo, hi)) SELECT range_family, count(*) AS codes, min(code) AS lo_code, max(code) AS hi_code FROM c JOIN r ON code BETWEEN lo AND hi GROUP BY 1"),
    "report_yearly": (yearly, f"{_YEARLY} SELECT * FROM yr"),
    "report_bridge": (
        bridge,
        f"""{_YEARLY}, im AS (SELECT *, {_IMPACT.format(s="status", a="semantic_area", b="blocking_level")} AS admissibility_impact FROM yr)
            SELECT semantic_area, year, research_module, listed, status, admissibility_impact, CASE WHEN admissibility_impact = 'allow' THEN 'allow' WHEN listed = 'blocked' THEN 'block' ELSE admissibility_impact END AS final_status,
              CASE WHEN listed = 'blocked' THEN 'block' ELSE admissibility_impact END AS strict_status FROM im JOIN {_MODULES} ON semantic_area = area""",
    ),
    "gate_impacts": (
        impacts,
        f"""WITH x AS (SELECT s_suppkey, ['order_lifecycle', 'trade_dir', 'order_type', 'session'][s_suppkey % 4 + 1] AS a, ['pass', 'weak_pass', 'fail', 'unknown', 'not_run', 'not_applicable'][s_suppkey % 6 + 1] AS s,
              CASE WHEN s_nationkey % 2 = 0 THEN 'blocking' ELSE 'context_only' END AS b FROM supplier) SELECT s_suppkey, {_IMPACT.format(s="s", a="a", b="b")} AS impact FROM x""",
    ),
    "gate_direction_readiness": (
        readiness,
        f"""{_MOVES}, p AS (SELECT year, CASE WHEN count(Dir) = count(*) AND count(DISTINCT Dir) BETWEEN 1 AND 3 THEN 'weak_pass' ELSE 'unknown' END AS probe_status, round(count(Dir) / count(*), 6) AS nonnull_rate_avg FROM trades GROUP BY year),
              c AS (SELECT year, CASE WHEN abs(uptick_gap) >= 0.02 AND bucket_uptick_consistent THEN 'candidate_directional_signal' ELSE 'no_stable_contrast' END AS contrast_status FROM gp)
            SELECT p.year, probe_status, nonnull_rate_avg, contrast_status, CASE WHEN probe_status <> 'weak_pass' OR nonnull_rate_avg < 1 THEN 'not_ready' WHEN contrast_status = 'candidate_directional_signal' THEN 'candidate_signal_only' ELSE 'structure_only' END AS decision
            FROM p LEFT JOIN c USING (year)""",
    ),
    "gate_methods": (
        methods,
        """WITH u AS (SELECT p_partkey AS use_id, ['coarse_only', 'fine_ok'][p_partkey % 2 + 1] AS grade, ['entropy', 'mutual_information', 'transfer_entropy'][p_partkey // 2 % 3 + 1] AS method, ['Price', 'Dir', 'SendTime', 'BrokerNo', 'Other', 'Volume', 'TickID'][p_partkey % 7 + 1] AS f FROM part),
             r AS (SELECT *, CASE WHEN grade = 'coarse_only' THEN CASE WHEN method = 'transfer_entropy' THEN 'blocked' ELSE 'allowed_with_caveat' END WHEN method = 'transfer_entropy' THEN 'allowed_with_caveat' ELSE 'allowed' END AS method_status,
               CAST(f = 'BrokerNo' AS BIGINT) AS blocked_fields, CAST(f IN ('Dir', 'Other') AS BIGINT) AS caveat_fields FROM u)
           SELECT use_id, grade, method, method_status, blocked_fields, caveat_fields, CASE WHEN method_status = 'blocked' OR blocked_fields > 0 THEN 'blocked' WHEN method_status = 'allowed_with_caveat' OR caveat_fields > 0 THEN 'allowed_with_caveat' ELSE 'allowed' END AS status FROM r""",
    ),
    "gate_policy_check": (
        policy_check,
        r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_]+') AS w, lower(regexp_replace(coalesce(text, ''), '[\s\p{Z}\x1c-\x1f\x85\x0b]+', ' ', 'g')) AS s FROM documents),
           n AS (SELECT doc_id, s, len(list_filter(w, lambda x: x = 'License')) AS li, len(list_filter(w, lambda x: x = 'the')) AS th, len(list_filter(w, lambda x: x = 'The')) AS ti, len(list_filter(w, lambda x: x = 'Version')) AS ve,
                   len(list_filter(w, lambda x: x = 'in')) AS i, len(list_filter(w, lambda x: x = 'and')) AS a FROM d)
           SELECT doc_id, concat_ws(',', CASE WHEN li > 0 THEN 'orders:License:' || li || ':vendor-defined' END, CASE WHEN th > 0 THEN 'orders:the:' || th || ':official-family-compatible' END,
                    CASE WHEN ti > 0 THEN 'trades:The:' || ti || ':unverified-semantic+vendor-defined' END, CASE WHEN ve > 0 THEN 'trades:Version:' || ve || ':' END) AS field_mentions,
             concat_ws(',', CASE WHEN contains(s, 'licensed under') THEN 'licensed_under' END, CASE WHEN contains(s, 'of the') THEN 'of the' END) AS avoid_phrase_hits,
             concat_ws(',', CASE WHEN contains(s, 'in the') THEN 'in the' END, CASE WHEN contains(s, 'released under the mit') THEN 'released_under the mit' END) AS reference_avoid_label_hits,
             CASE WHEN ti > 0 THEN 'The' ELSE '' END AS mentioned_unverified_fields, concat_ws(',', CASE WHEN li > 0 THEN 'License' END, CASE WHEN ti > 0 THEN 'The' END) AS mentioned_vendor_defined_fields,
             concat_ws(',', CASE WHEN li > 0 THEN 'License' END, CASE WHEN i > 0 THEN 'in' END) AS mentioned_keep_out_fields, CASE WHEN a > 0 THEN 'and' ELSE '' END AS mentioned_caveat_only_fields,
             contains(s, 'omd-c family') AS has_provenance_phrase, contains(s, 'source_layer') OR contains(s, 'candidate_cleaned') OR contains(s, 'verified') AS has_source_layer_phrase, contains(s, 'public license') AS has_reference_label,
             contains(s, 'vendor-defined') OR contains(s, 'vendor defined') OR contains(s, 'unverified') OR contains(s, 'not research-verified') AS has_unverified_caveat,
             (li > 0 OR i > 0) AND NOT (contains(s, 'vendor-defined') OR contains(s, 'vendor defined') OR contains(s, 'unverified') OR contains(s, 'not research-verified')) AS missing_keep_out_caveat FROM n""",
    ),
    "gate_term_scan": (
        terms,
        """WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+') AS w FROM documents),
             t AS (SELECT doc_id, len(list_filter(w, lambda x: x = 'license')) AS a, len(list_filter(w, lambda x: x = 'the')) AS b, len(list_filter(w, lambda x: x = 'under')) AS c FROM w)
           SELECT doc_id, a + b + c AS hits, b AS avoid_hits FROM t WHERE a + b + c > 0""",
    ),
    "select_date_batch": (first_dates, f"WITH {ORDER_EVENTS}, d AS (SELECT DISTINCT date FROM ev ORDER BY date LIMIT 7 OFFSET 7) SELECT date, count(*) AS row_count FROM ev SEMI JOIN d USING (date) GROUP BY date"),
    "select_common_dates": (shared_dates, f"WITH {ORDER_EVENTS} SELECT date FROM ev INTERSECT SELECT CAST(CAST(o_orderdate AS DATE) + INTERVAL 324 MONTH AS DATE) FROM orders"),
    "source_code_list": (codes, "SELECT DISTINCT lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS code FROM supplier"),
}
