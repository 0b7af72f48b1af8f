"""Queries of order-trade linkage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tapelens.functions.columns import rate
from tapelens.operators import linkage as op
from tapelens.plans.adapters import ORDERS, TRADES, orders, trades
from tapelens.plans.common import rounded
from tapelens.sources.files import scratch

_LOOKUP = f"""{TRADES}, {ORDERS},
 secs AS (SELECT *, CAST(substr(Time, 1, 2) AS INT) * 3600 + CAST(substr(Time, 3, 2) AS INT) * 60 + CAST(substr(Time, 5, 2) AS INT) AS sec FROM book),
 look AS (SELECT OrderId, count(*) AS order_events, min(SendTime) AS order_sendtime, min(sec) AS f, max(sec) AS l FROM secs WHERE OrderId <> 0 GROUP BY 1),
 edge AS (SELECT year, SendTime, Time, 'bid' AS side, BidOrderID AS id FROM trades WHERE BidOrderID <> 0 UNION ALL SELECT year, SendTime, Time, 'ask', AskOrderID FROM trades WHERE AskOrderID <> 0),
 linked AS (SELECT edge.*, look.*, CAST(substr(edge.Time, 1, 2) AS INT) * 3600 + CAST(substr(edge.Time, 3, 2) AS INT) * 60 + CAST(substr(edge.Time, 5, 2) AS INT) AS tsec FROM edge LEFT JOIN look ON id = OrderId)"""
_METRICS = ", ".join(
    f"count(*) FILTER (WHERE side = '{s}'{cond}) AS {s}_{name}_count"
    for s in ("bid", "ask")
    for name, cond in (
        ("present", ""),
        ("id_equal", " AND order_events IS NOT NULL"),
        ("time_usable", " AND order_events IS NOT NULL AND order_sendtime IS NOT NULL AND SendTime IS NOT NULL"),
        ("negative_lag", " AND SendTime < order_sendtime"),
    )
)


def edge_counts(spark, sf_dir):
    out = op.edges(trades(spark, sf_dir), ["year"])
    return out.groupBy("year", "side").agg(F.count("*").alias("edge_count"), F.count_distinct("trade_order_id").alias("distinct_ids"))


def order_lookup(spark, sf_dir):
    out = op.order_lookup(orders(spark, sf_dir), [])
    return out.select(F.col("trade_order_id").alias("order_id"), "order_events", "order_sendtime", "order_first_seconds", "order_last_seconds")


def edge_metrics(spark, sf_dir):
    return op.edge_metrics(op.linked_edges(trades(spark, sf_dir), orders(spark, sf_dir), ["year"], []), ["year"])


def both_sides(spark, sf_dir):
    return op.both_sides(trades(spark, sf_dir), orders(spark, sf_dir), ["year"], [])


def anchors(spark, sf_dir):
    return op.anchor_availability(trades(spark, sf_dir), ["date"], "trades")


def day_record(spark, sf_dir):
    return rounded(op.day_record(trades(spark, sf_dir), orders(spark, sf_dir), ["year"], []))


def colocated_record(spark, sf_dir):
    """The same record from tables bucketed by order id. They are external tables in the shared folder."""
    deals, book = trades(spark, sf_dir), orders(spark, sf_dir)
    name = f"linkage_{uuid.uuid4().hex}"
    tables = op.write_colocated(deals, book, ["year"], [], name, scratch(spark, "linkage"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rounded(op.colocated_record(tables, deals, book, ["year"]))


def time_anchor(spark, sf_dir):
    return rounded(op.time_anchor(trades(spark, sf_dir), orders(spark, sf_dir), ["year"], []))


def time_grades(spark, sf_dir):
    record = op.day_record(trades(spark, sf_dir), orders(spark, sf_dir), ["year"], []).select("year", "order_sendtime_present_rate")
    coarse = op.time_anchor(trades(spark, sf_dir), orders(spark, sf_dir), ["year"], []).select("year", "coarse_time_anchor_status")
    return record.join(coarse, "year").select("year", "coarse_time_anchor_status", op.time_grade(F.col("order_sendtime_present_rate"), F.col("coarse_time_anchor_status")).alias("research_time_grade"))


def density(spark, sf_dir):
    return rounded(op.second_density(trades(spark, sf_dir), ["year"]))


def match_rate(spark, sf_dir):
    m = op.edge_metrics(op.linked_edges(trades(spark, sf_dir), orders(spark, sf_dir), ["date"], []), ["date"])
    return rounded(m.select("date", rate(F.col("bid_id_equal_count"), F.col("bid_present_count")).alias("bid_rate"), rate(F.col("ask_id_equal_count"), F.col("ask_present_count")).alias("ask_rate")))


_RECORD = f"""{_LOOKUP},
 m AS (SELECT year, {_METRICS} FROM linked GROUP BY year),
 known AS (SELECT DISTINCT OrderId FROM book WHERE OrderId <> 0),
 b AS (SELECT year, count(*) AS both_present_count, count(*) FILTER (WHERE k1.OrderId IS NOT NULL AND k2.OrderId IS NOT NULL) AS both_id_equal_count
       FROM trades LEFT JOIN known k1 ON BidOrderID = k1.OrderId LEFT JOIN known k2 ON AskOrderID = k2.OrderId WHERE BidOrderID <> 0 AND AskOrderID <> 0 GROUP BY year),
 a AS (SELECT count(*) AS orders_rows, count(SendTime) AS orders_sendtime_rows, count(Time) AS orders_time_rows FROM book),
 n AS (SELECT year, count(*) AS trade_rows FROM trades GROUP BY year),
 c AS (SELECT *, bid_present_count + ask_present_count AS combined_present_count, bid_id_equal_count + ask_id_equal_count AS combined_id_equal_count,
         bid_time_usable_count + ask_time_usable_count AS combined_time_usable_count, bid_negative_lag_count + ask_negative_lag_count AS combined_negative_lag_count
       FROM n JOIN m USING (year) JOIN b USING (year) CROSS JOIN a),
 r AS (SELECT *, combined_id_equal_count / nullif(combined_present_count, 0) AS eq, both_id_equal_count / nullif(both_present_count, 0) AS bo,
         combined_negative_lag_count / nullif(combined_time_usable_count, 0) AS neg, orders_sendtime_rows / nullif(orders_rows, 0) AS osr,
         combined_time_usable_count / nullif(combined_id_equal_count, 0) AS use FROM c),
 s AS (SELECT *, CASE WHEN combined_present_count = 0 THEN 'not_applicable' WHEN eq IS NULL OR eq = 0 THEN 'fail' WHEN eq < 0.5 THEN 'warn' ELSE 'pass' END AS id_equality_status,
         CASE WHEN combined_id_equal_count = 0 THEN 'not_applicable' WHEN osr IS NULL OR osr = 0 THEN 'unavailable' WHEN combined_time_usable_count < combined_id_equal_count THEN 'partial' ELSE 'pass' END AS time_anchor_status,
         CASE WHEN combined_id_equal_count = 0 THEN 'not_applicable' WHEN osr IS NULL OR osr = 0 THEN 'time_anchor_unavailable' WHEN combined_time_usable_count = 0 OR neg > 0.25 THEN 'fail'
              WHEN use < 0.5 OR neg > 0.05 THEN 'warn' ELSE 'pass' END AS lag_validation_status FROM r)"""
_COUNTS = ", ".join([f"{s}_{m}_count" for s in ("bid", "ask", "combined") for m in ("present", "id_equal", "time_usable", "negative_lag")])

QUERIES = {
    "linkage_edges": (edge_counts, f"WITH {_LOOKUP} SELECT year, side, count(*) AS edge_count, count(DISTINCT id) AS distinct_ids FROM edge GROUP BY ALL"),
    "linkage_order_lookup": (order_lookup, f"WITH {_LOOKUP} SELECT OrderId AS order_id, order_events, order_sendtime, f AS order_first_seconds, l AS order_last_seconds FROM look"),
    "linkage_edge_metrics": (edge_metrics, f"WITH {_LOOKUP} SELECT year, {_METRICS} FROM linked GROUP BY year"),
    "linkage_both_sides": (both_sides, f"WITH {_RECORD} SELECT * FROM b"),
    "linkage_anchors": (anchors, f"WITH {TRADES} SELECT date, count(*) AS trades_rows, count(SendTime) AS trades_sendtime_rows, count(Time) AS trades_time_rows FROM trades GROUP BY date"),
    "linkage_day_record": (
        day_record,
        f"""WITH {_RECORD} SELECT year, trade_rows, both_present_count, both_id_equal_count, orders_rows, orders_sendtime_rows, orders_time_rows, {_COUNTS},
            round(eq, 6) AS combined_id_equal_rate, round(bo, 6) AS both_id_equal_rate, round(neg, 6) AS negative_time_lag_rate, round(osr, 6) AS order_sendtime_present_rate,
            id_equality_status, time_anchor_status, lag_validation_status,
            CASE WHEN lag_validation_status = 'time_anchor_unavailable' THEN 'not_verifiable' ELSE lag_validation_status END AS lag_linkage_status,
            CASE WHEN id_equality_status = 'not_applicable' THEN 'not_applicable' WHEN id_equality_status = 'fail' OR lag_validation_status = 'fail' THEN 'fail'
                 WHEN id_equality_status = 'warn' OR lag_validation_status IN ('warn', 'time_anchor_unavailable', 'not_applicable') THEN 'warn' ELSE 'pass' END AS linkage_feasibility_status FROM s""",
    ),
    "linkage_time_anchor": (
        time_anchor,
        f"""WITH {_LOOKUP}, g AS (SELECT year, count(*) AS edge_count, count(order_events) AS matched_edge_count, count(*) FILTER (WHERE f IS NOT NULL AND tsec IS NOT NULL) AS both_time_count,
              count(*) FILTER (WHERE f <= tsec) AS order_le_trade_count, count(*) FILTER (WHERE f <= tsec AND tsec <= l) AS trade_in_order_span_count, count(*) FILTER (WHERE f = tsec) AS same_time_count,
              CAST(quantile_cont(tsec - f, 0.5) AS DOUBLE) AS delta_seconds_p50, CAST(quantile_cont(tsec - f, 0.99) AS DOUBLE) AS delta_seconds_p99 FROM linked GROUP BY year),
            h AS (SELECT *, both_time_count / edge_count AS bt, order_le_trade_count / edge_count AS le, same_time_count / edge_count AS sm FROM g)
            SELECT year, edge_count, matched_edge_count, both_time_count, order_le_trade_count, trade_in_order_span_count, same_time_count, round(delta_seconds_p50, 6) AS delta_seconds_p50, round(delta_seconds_p99, 6) AS delta_seconds_p99,
              round(bt, 6) AS both_time_rate, round(le, 6) AS order_le_trade_rate, round(sm, 6) AS same_time_rate,
              CASE WHEN bt = 0 THEN 'unavailable' WHEN le >= 0.95 AND sm >= 0.5 THEN 'weak_pass' WHEN le >= 0.8 THEN 'warn' ELSE 'fail' END AS coarse_time_anchor_status FROM h""",
    ),
    "linkage_time_grades": (
        time_grades,
        f"""WITH {_LOOKUP}, g AS (SELECT year, count(*) FILTER (WHERE f IS NOT NULL) / count(*) AS bt, count(*) FILTER (WHERE f <= tsec) / count(*) AS le, count(*) FILTER (WHERE f = tsec) / count(*) AS sm FROM linked GROUP BY year),
            c AS (SELECT year, CASE WHEN bt = 0 THEN 'unavailable' WHEN le >= 0.95 AND sm >= 0.5 THEN 'weak_pass' WHEN le >= 0.8 THEN 'warn' ELSE 'fail' END AS coarse_time_anchor_status FROM g),
            o AS (SELECT count(SendTime) / count(*) AS osr FROM book)
            SELECT year, coarse_time_anchor_status, CASE WHEN osr >= 0.99 THEN 'fine_ok' WHEN coarse_time_anchor_status IN ('pass', 'weak_pass') THEN 'coarse_only' ELSE 'blocked' END AS research_time_grade FROM c CROSS JOIN o""",
    ),
    "linkage_second_density": (
        density,
        f"""WITH {TRADES}, e AS (SELECT year, Time, count(*) AS n FROM trades GROUP BY ALL)
            SELECT year, count(*) AS distinct_seconds, round(median(n), 6) AS rows_per_second_median, round(quantile_cont(CAST(n AS DOUBLE), 0.99), 6) AS rows_per_second_p99, max(n) AS rows_per_second_max FROM e GROUP BY year""",
    ),
    "linkage_match_rate": (
        match_rate,
        f"""WITH {TRADES}, {ORDERS}, known AS (SELECT DISTINCT OrderId FROM book WHERE OrderId <> 0),
            e AS (SELECT date, 'bid' AS side, BidOrderID AS id FROM trades WHERE BidOrderID <> 0 UNION ALL SELECT date, 'ask', AskOrderID FROM trades WHERE AskOrderID <> 0),
            g AS (SELECT date, count(*) FILTER (WHERE side = 'bid') AS b, count(*) FILTER (WHERE side = 'ask') AS a, count(OrderId) FILTER (WHERE side = 'bid') AS bk, count(OrderId) FILTER (WHERE side = 'ask') AS ak
                  FROM e LEFT JOIN known ON id = OrderId GROUP BY date)
            SELECT date, round(bk / nullif(b, 0), 6) AS bid_rate, round(ak / nullif(a, 0), 6) AS ask_rate FROM g""",
    ),
}
QUERIES["linkage_colocated_record"] = (colocated_record, QUERIES["linkage_day_record"][1])
