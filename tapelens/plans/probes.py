"""Queries of semantic probes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelens.operators import probes as op
from tapelens.plans.adapters import EVENT_TRADES, ORDER_EVENTS, ORDERS, TRADES, event_trades, order_events, orders, read, trades
from tapelens.plans.common import rounded

_ORDER = ["OrderId", "row_num_in_file"]


def lifecycle(spark, sf_dir):
    return rounded(op.lifecycle(order_events(spark, sf_dir), event_trades(spark, sf_dir), ["date"], ["row_num_in_file"], ["row_num_in_file"]))


def order_groups(spark, sf_dir):
    return op.order_groups(order_events(spark, sf_dir), ["date"], ["row_num_in_file"])


def trade_groups(spark, sf_dir):
    found = op.trade_groups(event_trades(spark, sf_dir), ["date"], ["row_num_in_file"])
    return op.linked_trade_groups(found, order_events(spark, sf_dir), ["date"])


def directions(spark, sf_dir):
    return rounded(op.direction_distribution(trades(spark, sf_dir), ["year"]))


def _moves(spark, sf_dir):
    return op.tick_moves(trades(spark, sf_dir), ["year"], "chunk", ["BidOrderID", "TickID"])


def moves(spark, sf_dir):
    return _moves(spark, sf_dir).groupBy("year").agg(F.count_if("move_tested").alias("tested"), F.sum("uptick").alias("up"), F.sum("downtick").alias("down"), F.sum("sameprice").alias("same"))


def contrast(spark, sf_dir):
    sizes = op.direction_sizes(trades(spark, sf_dir), ["year"])
    return rounded(op.direction_contrast(_moves(spark, sf_dir), ["year"], sizes))


def mix(spark, sf_dir):
    return rounded(op.bucket_mix(_moves(spark, sf_dir), ["year"]))


def year_gaps(spark, sf_dir):
    found = _moves(spark, sf_dir)
    return op.contrast_gaps(op.direction_contrast(found, ["year"]), op.bucket_mix(found, ["year"]), ["year"])


def gaps(spark, sf_dir):
    return rounded(year_gaps(spark, sf_dir))


def yearly(spark, sf_dir):
    """The years as the days of one period."""
    found = year_gaps(spark, sf_dir).withColumn("period", F.lit("all"))
    return rounded(op.contrast_yearly(found, ["period"]))


def top_types(spark, sf_dir):
    return op.top_values(order_events(spark, sf_dir), ["date"], "OrderType", 3)


def order_types(spark, sf_dir):
    return rounded(op.ordertype_probe(order_events(spark, sf_dir), ["date"], ["row_num_in_file"]))


def patterns(spark, sf_dir):
    found = op.trajectories(order_events(spark, sf_dir), ["date"], ["row_num_in_file"])
    return found.groupBy("date", "pattern").agg(F.count("*").alias("orders"))


def sessions(spark, sf_dir):
    return rounded(op.session_probe(order_events(spark, sf_dir), event_trades(spark, sf_dir), ["date"]))


def sessions_absent(spark, sf_dir):
    return op.session_probe(order_events(spark, sf_dir).drop("Session"), event_trades(spark, sf_dir).drop("Session"), ["date"])


def id_space(spark, sf_dir):
    return rounded(op.id_space(trades(spark, sf_dir), ["year"], "AskOrderID"))


def witness(spark, sf_dir):
    t = trades(spark, sf_dir).withColumns({"all": F.lit(1), "row": F.col("TickID")})
    o = orders(spark, sf_dir).withColumns({"all": F.lit(1), "row": F.col("OrderId")})
    return op.witnesses({"orders": (o, "OrderId"), "bid": (t, "BidOrderID")}, ["all"], ["row"])


def _codes(spark, sf_dir):
    return read(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.lpad(F.col("s_suppkey").cast("string"), 4, "0").alias("code"))


def _sold(spark, sf_dir):
    """Trades whose broker codes are as they are found: unfilled, between spaces, zero, empty or absent."""
    n = F.col("l_suppkey")
    code = F.when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), n.cast("string"), F.lit(" "))).when(F.col("l_linestatus") == "O", n.cast("string")).when(F.col("l_tax") == 0, "0").when(F.col("l_discount") == 0, "").when(F.col("l_discount") > 0.02, F.lpad(n.cast("string"), 4, "0"))
    return read(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), code.alias("BrokerNo"))


def brokers(spark, sf_dir):
    return rounded(op.broker_profile(_sold(spark, sf_dir), ["year"], _codes(spark, sf_dir)))


def broker_decision(spark, sf_dir):
    return op.broker_decision(op.broker_profile(_sold(spark, sf_dir), ["year"], _codes(spark, sf_dir)))


def seats(spark, sf_dir):
    return op.seat_activity(trades(spark, sf_dir), ["year"])


def by_session(spark, sf_dir):
    return op.field_by_session(trades(spark, sf_dir), ["year"], "Dir")


_BOTH = f"WITH {ORDER_EVENTS}, {EVENT_TRADES}"
_GROUPS = """og AS (SELECT date, OrderId, count(*) AS event_count, count(SeqNum) AS seqnum_count, arg_min(SeqNum, row_num_in_file) FILTER (WHERE SeqNum IS NOT NULL) AS first_seqnum,
    arg_max(SeqNum, row_num_in_file) FILTER (WHERE SeqNum IS NOT NULL) AS last_seqnum, count(DISTINCT OrderType) AS ordertype_count, count(DISTINCT Session) AS session_count FROM ev WHERE OrderId <> 0 GROUP BY ALL),
 de AS (SELECT *, BidOrderID AS id FROM deal WHERE BidOrderID <> 0 UNION ALL SELECT *, AskOrderID FROM deal WHERE AskOrderID <> 0),
 tg AS (SELECT date, id AS OrderId, count(*) AS trade_match_count, count(SeqNum) AS trade_seqnum_count, arg_min(SeqNum, row_num_in_file) FILTER (WHERE SeqNum IS NOT NULL) AS trade_first_seqnum,
    arg_max(SeqNum, row_num_in_file) FILTER (WHERE SeqNum IS NOT NULL) AS trade_last_seqnum, count(DISTINCT Session) AS trade_session_count FROM de GROUP BY ALL)"""
_BUCKET = "CASE WHEN Time < '0900' THEN 'unknown' WHEN substr(Time, 1, 4) < '0930' THEN '0900_0929' WHEN substr(Time, 1, 4) < '1200' THEN '0930_1159' WHEN substr(Time, 1, 4) < '1300' THEN '1200_1259' WHEN substr(Time, 1, 4) < '1600' THEN '1300_1559' ELSE '1600_plus' END"
_MOVES = f"""WITH {TRADES}, lagged AS (SELECT *, Price - lag(Price) OVER (PARTITION BY year ORDER BY BidOrderID, TickID) AS move FROM trades),
 mv AS (SELECT *, CAST(move > 0 AS INT) AS up, CAST(move < 0 AS INT) AS down, CAST(move = 0 AS INT) AS same, Price * Volume AS turn, {_BUCKET} AS time_bucket,
    BidOrderID <> 0 AS b, AskOrderID <> 0 AS a FROM lagged),
 ct AS (SELECT year, Dir, count(*) AS row_count, avg(CAST(b AS INT)) AS bid_present_rate, avg(CAST(a AS INT)) AS ask_present_rate, avg(CAST(a AND b AS INT)) AS both_present_rate, avg(CAST(b AND NOT a AS INT)) AS bid_only_rate,
    avg(CAST(a AND NOT b AS INT)) AS ask_only_rate, avg(CAST(NOT a AND NOT b AS INT)) AS neither_side_rate, count(move) AS move_tested_count, avg(up) AS uptick_rate, avg(down) AS downtick_rate, avg(same) AS sameprice_rate,
    median(Volume) AS volume_median, quantile_cont(CAST(Volume AS DOUBLE), 0.9) AS volume_p90, median(turn) AS turnover_proxy_median, quantile_cont(turn, 0.9) AS turnover_proxy_p90 FROM mv GROUP BY ALL),
 bm AS (SELECT year, Dir, time_bucket, bucket_rows, uptick_rate, bucket_rows / sum(bucket_rows) OVER (PARTITION BY year, Dir) AS bucket_share FROM (SELECT year, Dir, time_bucket, count(*) AS bucket_rows, avg(up) AS uptick_rate FROM mv GROUP BY ALL)),
 w AS (SELECT l.year AS y, {{pairs}} FROM (SELECT * FROM ct WHERE Dir = 1) l JOIN (SELECT * FROM ct WHERE Dir = 2) r ON l.year = r.year JOIN (SELECT * FROM ct WHERE Dir = 0) z ON l.year = z.year),
 tv AS (SELECT year, time_bucket, abs(coalesce(sum(bucket_rows) FILTER (WHERE Dir = 0), 0) / any_value(n0) - coalesce(sum(bucket_rows) FILTER (WHERE Dir IN (1, 2)), 0) / any_value(n12)) AS apart,
    max(uptick_rate) FILTER (WHERE Dir = 1) - max(uptick_rate) FILTER (WHERE Dir = 2) AS g
    FROM (SELECT *, sum(bucket_rows) FILTER (WHERE Dir = 0) OVER (PARTITION BY year) AS n0, sum(bucket_rows) FILTER (WHERE Dir IN (1, 2)) OVER (PARTITION BY year) AS n12 FROM bm) GROUP BY ALL),
 td AS (SELECT year, sum(apart) / 2 AS dist, coalesce(min(sign(g)) = max(sign(g)), false) AS same FROM tv GROUP BY year),
 gp AS (SELECT y AS year, ug AS uptick_gap, dg AS downtick_gap, sg AS sameprice_gap, lg AS linkage_gap, same AS bucket_uptick_consistent, pg AS price_move_gap, (zs + zm + dist) / 3 AS dir0_specialness FROM w JOIN td ON y = year)"""
_SIDES = ["bid_present", "ask_present", "both_present", "bid_only", "ask_only", "neither_side"]
_MOVED = ["uptick", "downtick", "sameprice"]
_pooled = lambda names: "(" + " + ".join(f"abs(z.{c}_rate - (l.{c}_rate + r.{c}_rate) / 2)" for c in names) + f") / {len(names)}"
_MOVES = _MOVES.replace(
    "{pairs}",
    "l.uptick_rate - r.uptick_rate AS ug, l.downtick_rate - r.downtick_rate AS dg, l.sameprice_rate - r.sameprice_rate AS sg, ("
    + " + ".join(f"abs(l.{c}_rate - r.{c}_rate)" for c in _SIDES)
    + ") / 6 AS lg, ("
    + " + ".join(f"abs(l.{c}_rate - r.{c}_rate)" for c in _MOVED)
    + f") / 3 AS pg, {_pooled(_SIDES)} AS zs, {_pooled(_MOVED)} AS zm",
)
_DOUBLES = [*(f"{c}_rate" for c in (*_SIDES, *_MOVED)), "volume_median", "volume_p90", "turnover_proxy_median", "turnover_proxy_p90"]
_KNOWN = "SELECT lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS code FROM supplier WHERE s_acctbal > 0"
_BROKER = f"""WITH raw AS (SELECT CAST(year(l_shipdate) AS INT) AS year, trim(CASE WHEN l_returnflag = 'R' THEN ' ' || l_suppkey || ' ' WHEN l_linestatus = 'O' THEN CAST(l_suppkey AS VARCHAR) WHEN l_tax = 0 THEN '0' WHEN l_discount = 0 THEN '' WHEN l_discount > 0.02 THEN lpad(CAST(l_suppkey AS VARCHAR), 4, '0') END) AS c FROM lineitem),
 sold AS (SELECT year, CASE WHEN c = '' THEN NULL WHEN length(c) < 4 THEN lpad(c, 4, '0') ELSE c END AS BrokerNo FROM raw), known AS ({_KNOWN}), k AS (SELECT year, BrokerNo AS code, count(*) AS n, BrokerNo IN (SELECT code FROM known) AS ok FROM sold WHERE BrokerNo IS NOT NULL GROUP BY ALL),
 p AS (SELECT year, count(*) AS distinct_codes, count(*) FILTER (WHERE ok) AS matched_codes, CAST(sum(CASE WHEN ok THEN n ELSE 0 END) AS BIGINT) AS matched_rows FROM k GROUP BY year),
 u AS (SELECT year, string_agg(code || ':' || n, ',' ORDER BY n DESC, code) AS unmatched_sample FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n DESC, code) AS r FROM k WHERE NOT ok) WHERE r <= 10 GROUP BY year),
 b AS (SELECT year, count(*) AS tested_rows, count(BrokerNo) AS nonnull_count, count(*) FILTER (WHERE BrokerNo IN ('0', '0000')) AS zero_count FROM sold GROUP BY year),
 f AS (SELECT *, zero_count / tested_rows AS zr, matched_codes / distinct_codes AS mr FROM b JOIN p USING (year) LEFT JOIN u USING (year))"""

QUERIES = {
    "probe_order_groups": (order_groups, f"{_BOTH}, {_GROUPS} SELECT * FROM og"),
    "probe_trade_groups": (trade_groups, f"{_BOTH}, {_GROUPS} SELECT * FROM tg SEMI JOIN ev ON tg.date = ev.date AND tg.OrderId = ev.OrderId"),
    "probe_lifecycle": (
        lifecycle,
        f"""{_BOTH}, {_GROUPS}, x AS (SELECT og.date, count(*) AS distinct_orderids, count(trade_match_count) AS linked_orderids, count(*) FILTER (WHERE event_count > 1) AS multi_event_orderids, count(*) FILTER (WHERE trade_match_count = 1) AS single_trade_orderids,
              count(*) FILTER (WHERE trade_match_count > 1) AS multi_trade_orderids, count(*) FILTER (WHERE ordertype_count > 1) AS multi_type_orderids, count(*) FILTER (WHERE session_count <> trade_session_count) AS cross_session_count,
              count(*) FILTER (WHERE session_count > 1 OR trade_session_count > 1) AS cross_session_order_count, CAST(sum(trade_seqnum_count) AS BIGINT) AS trade_seqnum_rows
              FROM og LEFT JOIN tg ON og.date = tg.date AND og.OrderId = tg.OrderId GROUP BY og.date)
            SELECT *, round(linked_orderids / distinct_orderids, 6) AS linked_rate, round(multi_event_orderids / distinct_orderids, 6) AS multi_event_rate,
              CASE WHEN linked_orderids >= 1000000 AND multi_event_orderids / distinct_orderids >= 0.9 THEN 'pass' WHEN linked_orderids >= 100000 AND multi_event_orderids / distinct_orderids >= 0.5 THEN 'weak_pass'
                   WHEN linked_orderids / distinct_orderids >= 0.02 AND multi_event_orderids / distinct_orderids >= 0.5 THEN 'weak_pass' ELSE 'unknown' END AS status FROM x""",
    ),
    "probe_directions": (
        directions,
        f"""WITH {TRADES}, x AS (SELECT year, count(*) AS tested_rows, count(Dir) AS nonnull_count, count(*) FILTER (WHERE Dir = 0) AS zero_count, count(*) FILTER (WHERE Dir > 0) AS pos_count, count(*) FILTER (WHERE Dir < 0) AS neg_count,
              count(*) FILTER (WHERE Dir NOT IN (-1, 0, 1)) AS other_count, count(DISTINCT Dir) AS distinct_values, string_agg(DISTINCT CAST(Dir AS VARCHAR), ',' ORDER BY CAST(Dir AS VARCHAR)) AS observed_values,
              count(*) FILTER (WHERE BidOrderID <> 0 OR AskOrderID <> 0) AS linked_edge_count, count(*) FILTER (WHERE (Dir > 0 AND AskOrderID <> 0) OR (Dir < 0 AND BidOrderID <> 0)) AS linked_consistent_count FROM trades GROUP BY year)
            SELECT *, round(nonnull_count / tested_rows, 6) AS nonnull_rate, round(linked_consistent_count / nullif(linked_edge_count, 0), 6) AS linked_consistency_rate,
              CASE WHEN nonnull_count = tested_rows AND distinct_values BETWEEN 1 AND 3 THEN 'weak_pass' ELSE 'unknown' END AS status FROM x""",
    ),
    "probe_tick_moves": (moves, f"{_MOVES} SELECT year, count(move) AS tested, CAST(sum(up) AS BIGINT) AS up, CAST(sum(down) AS BIGINT) AS down, CAST(sum(same) AS BIGINT) AS same FROM mv GROUP BY year"),
    "probe_direction_contrast": (contrast, f"{_MOVES} SELECT year, Dir, row_count, move_tested_count, {', '.join(f'round({c}, 6) AS {c}' for c in _DOUBLES)}, round(row_count / sum(row_count) OVER (PARTITION BY year), 6) AS row_share FROM ct"),
    "probe_bucket_mix": (mix, f"{_MOVES} SELECT year, Dir, time_bucket, bucket_rows, round(uptick_rate, 6) AS uptick_rate, round(bucket_share, 6) AS bucket_share FROM bm"),
    "probe_contrast_gaps": (gaps, f"{_MOVES} SELECT year, bucket_uptick_consistent, {', '.join(f'round({c}, 6) AS {c}' for c in ('uptick_gap', 'downtick_gap', 'sameprice_gap', 'linkage_gap', 'price_move_gap', 'dir0_specialness'))} FROM gp"),
    "probe_contrast_yearly": (
        yearly,
        f"""{_MOVES}, s AS (SELECT 'all' AS period, count(*) AS days_run, {", ".join(f"round(avg({c}_gap), 6) AS {c}_gap_avg" for c in (*_MOVED, "linkage"))}, round(avg(dir0_specialness), 6) AS dir0_specialness_score,
              count(*) FILTER (WHERE bucket_uptick_consistent) AS bucket_consistent_days, count(*) FILTER (WHERE uptick_gap >= 0.02) = count(*) OR count(*) FILTER (WHERE uptick_gap <= -0.02) = count(*) AS uptick_sign_consistent FROM gp)
            SELECT *, CASE WHEN uptick_sign_consistent AND bucket_consistent_days = days_run THEN 'candidate_directional_signal' ELSE 'no_stable_contrast' END AS status FROM s""",
    ),
    "probe_top_types": (top_types, f"WITH {ORDER_EVENTS}, c AS (SELECT date, OrderType, count(*) AS n FROM ev WHERE OrderType IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY n DESC, OrderType) AS p FROM c) SELECT date, string_agg(OrderType || ':' || n, ',' ORDER BY p) AS \"top_OrderType\" FROM r WHERE p <= 3 GROUP BY date"),
    "probe_order_types": (
        order_types,
        f"""WITH {ORDER_EVENTS}, t AS (SELECT date, OrderId, count(DISTINCT OrderType) AS k, string_agg(CAST(OrderType AS VARCHAR), ',' ORDER BY row_num_in_file) AS pattern FROM ev WHERE OrderId <> 0 AND OrderType IS NOT NULL GROUP BY ALL),
            b AS (SELECT date, count(*) AS tested_rows, count(OrderType) AS nonnull_count, count(DISTINCT OrderType) AS distinct_values FROM ev GROUP BY date),
            p AS (SELECT date, count(*) AS distinct_orderids, count(*) FILTER (WHERE k = 1) AS single_type_orderids, count(*) FILTER (WHERE k > 1) AS multi_type_orderids, count(DISTINCT pattern) AS pattern_count FROM t GROUP BY date),
            c AS (SELECT date, OrderType, count(*) AS n FROM ev WHERE OrderType IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY n DESC, OrderType) AS p FROM c),
            v AS (SELECT date, string_agg(OrderType || ':' || n, ',' ORDER BY p) AS "top_OrderType" FROM r WHERE p <= 5 GROUP BY date),
            q AS (SELECT date, pattern, count(*) AS n, row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, pattern) AS p FROM t GROUP BY date, pattern),
            w AS (SELECT date, string_agg(pattern || ':' || n, ',' ORDER BY p) AS top_pattern FROM q WHERE p <= 3 GROUP BY date)
            SELECT *, round(multi_type_orderids / distinct_orderids, 6) AS multi_type_rate, least(3, pattern_count) AS top_pattern_count, CASE WHEN distinct_values > 0 AND multi_type_orderids > 0 THEN 'weak_pass' ELSE 'unknown' END AS status
            FROM b JOIN p USING (date) JOIN v USING (date) JOIN w USING (date)""",
    ),
    "probe_patterns": (patterns, f"WITH {ORDER_EVENTS}, t AS (SELECT date, OrderId, string_agg(CAST(OrderType AS VARCHAR), ',' ORDER BY row_num_in_file) AS pattern FROM ev WHERE OrderId <> 0 AND OrderType IS NOT NULL GROUP BY ALL) SELECT date, pattern, count(*) AS orders FROM t GROUP BY ALL"),
    "probe_sessions": (
        sessions,
        f"""{_BOTH}, o AS (SELECT date, count(*) AS tested_rows, round(count(Session) / count(*), 6) AS orders_session_rate, count(DISTINCT Session) AS distinct_sessions FROM ev GROUP BY date),
            t AS (SELECT date, round(count(Session) / count(*), 6) AS trades_session_rate FROM deal GROUP BY date),
            x AS (SELECT date, count(*) FILTER (WHERE n > 1) AS cross_session_orders FROM (SELECT date, OrderId, count(DISTINCT Session) AS n FROM ev GROUP BY ALL) GROUP BY date)
            SELECT *, 'weak_pass' AS status FROM o LEFT JOIN t USING (date) LEFT JOIN x USING (date)""",
    ),
    "probe_sessions_absent": (sessions_absent, f"WITH {ORDER_EVENTS} SELECT DISTINCT date, CAST(0 AS BIGINT) AS tested_rows, CAST(NULL AS DOUBLE) AS orders_session_rate, CAST(NULL AS DOUBLE) AS trades_session_rate, CAST(NULL AS BIGINT) AS distinct_sessions, CAST(NULL AS BIGINT) AS cross_session_orders, 'not_run' AS status FROM ev"),
    "probe_id_space": (
        id_space,
        f"""WITH {TRADES}, v AS (SELECT year, AskOrderID AS v FROM trades WHERE AskOrderID <> 0),
            d AS (SELECT year, arg_max(len, (n, -len)) AS modal_digits FROM (SELECT year, length(CAST(v AS VARCHAR)) AS len, count(*) AS n FROM v GROUP BY ALL) GROUP BY year),
            l AS (SELECT year, arg_max(dig, (n, -dig)) AS modal_last_digit FROM (SELECT year, v % 10 AS dig, count(*) AS n FROM v GROUP BY ALL) GROUP BY year)
            SELECT year, count(*) AS present_count, count(DISTINCT v) AS distinct_count, min(v) AS min_id, max(v) AS max_id, round(quantile_cont(CAST(v AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST(v AS DOUBLE), 0.99), 6) AS p99,
              any_value(modal_digits) AS modal_digits, any_value(modal_last_digit) AS modal_last_digit, round(avg(v % 2), 6) AS odd_share FROM v JOIN d USING (year) JOIN l USING (year) GROUP BY year""",
    ),
    "probe_witnesses": (
        witness,
        f"""WITH {TRADES}, {ORDERS}, a AS (SELECT OrderId AS id, OrderId AS row, 'orders' AS source FROM book UNION ALL SELECT BidOrderID, TickID, 'bid' FROM trades),
            m AS (SELECT max(id) AS m FROM a WHERE id <> 0), h AS (SELECT 1 AS "all", id AS witness_id, source, min(row) AS row FROM a JOIN m ON id = m GROUP BY ALL)
            SELECT *, n AS n_sources FROM h CROSS JOIN (SELECT count(*) AS n FROM h) WHERE n >= 2""".replace("SELECT *, n AS n_sources FROM", 'SELECT "all", witness_id, source, row, n AS n_sources FROM'),
    ),
    "probe_brokers": (brokers, f"{_BROKER} SELECT year, tested_rows, nonnull_count, zero_count, distinct_codes, matched_codes, matched_rows, unmatched_sample, round(zr, 6) AS zero_rate, round(mr, 6) AS matched_distinct_rate FROM f"),
    "probe_broker_decision": (
        broker_decision,
        f"""{_BROKER}, g AS (SELECT CAST(sum(tested_rows) AS BIGINT) AS tested_rows, bool_or(zr > 0.05) AS high_zero, bool_or(mr < 0.95) AS imperfect FROM f)
            SELECT *, CASE WHEN tested_rows = 0 THEN 'insufficient_evidence' WHEN high_zero OR imperfect THEN 'lookup_only' ELSE 'not_alpha_ready' END AS decision FROM g""",
    ),
    "probe_seats": (seats, f"WITH {TRADES} SELECT year, CASE WHEN BrokerNo IN ('0', '0000') THEN 'unattributed' ELSE BrokerNo END AS seat, count(*) AS row_count, CAST(sum(Volume) AS BIGINT) AS volume, CAST(sum(CASE Dir WHEN 2 THEN Volume WHEN 1 THEN -Volume ELSE 0 END) AS BIGINT) AS net_volume FROM trades GROUP BY ALL"),
    "probe_field_by_session": (by_session, f"WITH {TRADES} SELECT year, {_BUCKET} AS time_bucket, Dir, count(*) AS row_count, min(CAST(substr(Time, 1, 2) AS INT) * 3600 + CAST(substr(Time, 3, 2) AS INT) * 60 + CAST(substr(Time, 5, 2) AS INT)) AS first_second FROM trades GROUP BY ALL"),
}
