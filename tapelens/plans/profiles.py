"""Queries of table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelens.contracts import ORDER_RULES, TRADE_RULES
from tapelens.operators import profile as op
from tapelens.plans.adapters import ORDER_EVENTS, TRADES, order_events, trades
from tapelens.plans.common import rounded
from tapelens.sources.files import listing

_RULES = ORDER_RULES
_FIELDS = ["SeqNum", "OrderType", "Level", "Volume", "Time"]


def fields(spark, sf_dir):
    return rounded(op.field_profile(order_events(spark, sf_dir), ["date"], _FIELDS))


def rules(spark, sf_dir):
    return rounded(op.rule_profile(order_events(spark, sf_dir), ["date"], tuple(_RULES), F.col("year")))


def trade_rules(spark, sf_dir):
    return rounded(op.rule_profile(trades(spark, sf_dir), ["year"], TRADE_RULES, F.col("year")))


def samples(spark, sf_dir):
    out = op.violation_samples(order_events(spark, sf_dir), ["date"], tuple(_RULES), ["row_num_in_file"], ["OrderId", "Level", "Volume"])
    rows = F.from_json("samples", "array<struct<OrderId:bigint,Level:int,Volume:bigint>>")
    text = F.transform(rows, lambda r: F.concat_ws(":", *[F.coalesce(r[c].cast("string"), F.lit("-")) for c in ("OrderId", "Level", "Volume")]))
    return out.select("date", "rule_name", F.array_join(text, ",").alias("samples"))


def hours(spark, sf_dir):
    return op.hour_histogram(order_events(spark, sf_dir), ["date"])


def inversions(spark, sf_dir):
    events = order_events(spark, sf_dir).withColumn("chunk", F.col("OrderId"))
    return rounded(op.time_inversions(events, ["year"], "chunk", ["OrderId", "row_num_in_file"]))


def lagged(spark, sf_dir):
    """The two-level lag itself, row by row."""
    out = op.chunked_lag(order_events(spark, sf_dir), ["date"], "OrderId", ["OrderId", "row_num_in_file"], ["Price"])
    return out.select("row_num_in_file", "prev_Price")


def times(spark, sf_dir):
    out = op.time_profile(order_events(spark, sf_dir), ["date"], "OrderId", ["OrderId", "row_num_in_file"])
    return rounded(out)


def fingerprints(spark, sf_dir):
    """Footers of the tables' files; DuckDB has no view of files, so there is no SQL."""
    files = listing(spark, sf_dir).where("path LIKE '%.parquet'")
    table = F.regexp_extract("path", r"/(\w+)\.parquet", 1)
    return op.schema_fingerprints(spark, files).groupBy(table.alias("table_name"), "fingerprint").agg(F.count("*").alias("n_files"), F.first(F.size("columns")).alias("n_columns"))


def _field(name: str) -> str:
    blank = f"count(*) FILTER (WHERE trim({name}) = '')" if name == "Time" else "0"
    return f"SELECT date, '{name}' AS field, count(*) AS row_count, count(*) - count({name}) AS null_count, CAST({blank} AS BIGINT) AS blank_count, CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value FROM ev GROUP BY date"


def _rule(r, table: str, by: str) -> str:
    years = "true" if r.years is None else f"year IN ({', '.join(map(str, r.years))})"
    return f"SELECT {by}, '{r.name}' AS rule_name, count(*) AS row_count, bool_or({years}) AS applicable, count(*) FILTER (WHERE ({r.tested}) AND {years}) AS tested_count, count(*) FILTER (WHERE ({r.tested}) AND {years} AND ({r.violating})) AS violating_count FROM {table} GROUP BY {by}"


_STATUS = "CASE WHEN NOT applicable OR tested_count = 0 THEN 'not_applicable' WHEN violating_count > 0 THEN 'fail' ELSE 'pass' END AS status"


def _rules(head: str, some, table: str, by: str) -> str:
    return f"WITH {head}, x AS ({' UNION ALL '.join(_rule(r, table, by) for r in some)}) SELECT *, round(violating_count / nullif(tested_count, 0), 6) AS violation_rate, {_STATUS} FROM x"




def _lag(by: str) -> str:
    return f"""WITH {ORDER_EVENTS}, l AS (SELECT *, lag(SendTime) OVER w AS ps, lag(SeqNum) OVER w AS pq FROM ev WINDOW w AS (PARTITION BY {by} ORDER BY OrderId, row_num_in_file)),
 i AS (SELECT {by}, count(*) FILTER (WHERE SendTime IS NOT NULL AND ps IS NOT NULL) AS comparable_count, count(*) FILTER (WHERE SendTime < ps) AS inversion_count,
   count(*) FILTER (WHERE SendTime IS NOT NULL AND ps IS NOT NULL AND SeqNum IS NOT NULL AND pq IS NOT NULL) AS seq_comparable_count,
   count(*) FILTER (WHERE SendTime < ps AND SeqNum > pq) AS seq_time_disagreement_count FROM l GROUP BY 1),
 j AS (SELECT *, round(inversion_count / nullif(comparable_count, 0), 6) AS inversion_rate, round(seq_time_disagreement_count / nullif(seq_comparable_count, 0), 6) AS seq_time_disagreement_rate FROM i)"""
_CHECKS = " UNION ALL ".join(f"SELECT date, '{r.name}' AS rule_name, row_num_in_file, OrderId, Level, Volume FROM ev WHERE ({r.tested}) AND ({r.violating})" for r in _RULES)

QUERIES = {
    "profile_fields": (
        fields,
        f"""WITH {ORDER_EVENTS}, x AS ({" UNION ALL ".join(map(_field, _FIELDS))})
            SELECT *, round(null_count / row_count, 6) AS null_rate, round(blank_count / row_count, 6) AS blank_rate, CASE WHEN null_count / row_count > 0.5 THEN 'warn' ELSE 'pass' END AS status FROM x""",
    ),
    "profile_order_rules": (rules, _rules(ORDER_EVENTS, _RULES, "ev", "date")),
    "profile_trade_rules": (trade_rules, _rules(TRADES, TRADE_RULES, "trades", "year")),
    "profile_violation_samples": (
        samples,
        f"""WITH {ORDER_EVENTS}, x AS ({_CHECKS}) SELECT date, rule_name, array_to_string(list_slice(list(coalesce(CAST(OrderId AS VARCHAR), '-') || ':' || coalesce(CAST(Level AS VARCHAR), '-') || ':' || coalesce(CAST(Volume AS VARCHAR), '-') ORDER BY row_num_in_file), 1, 5), ',') AS samples FROM x GROUP BY ALL""",
    ),
    "profile_hours": (
        hours,
        f"""WITH {ORDER_EVENTS} SELECT date, CAST(coalesce(hour(SendTime + INTERVAL 8 HOUR), CAST(substr(Time, 1, 2) AS INT)) AS INT) AS hour, count(*) AS n FROM ev GROUP BY ALL""",
    ),
    "profile_time_inversions": (inversions, _lag("year") + " SELECT * FROM j"),
    "profile_two_level_lag": (lagged, f"WITH {ORDER_EVENTS} SELECT row_num_in_file, lag(Price) OVER (PARTITION BY date ORDER BY OrderId, row_num_in_file) AS prev_Price FROM ev"),
    "profile_schema_fingerprints": (fingerprints, None),
    "profile_times": (
        times,
        _lag("date")
        + """, t AS (SELECT date, count(*) AS row_count, count(*) - count(SendTime) AS sendtime_null_count, count(*) - count(Time) AS time_null_count, min(SendTime) AS min_sendtime, max(SendTime) AS max_sendtime, min(Time) AS min_time, max(Time) AS max_time FROM ev GROUP BY date),
            h AS (SELECT date, lpad(CAST(coalesce(hour(SendTime + INTERVAL 8 HOUR), CAST(substr(Time, 1, 2) AS INT)) AS VARCHAR), 2, '0') AS hh, count(*) AS n FROM ev GROUP BY ALL),
            m AS (SELECT date, '{' || string_agg('"' || hh || '":' || n, ',' ORDER BY hh) || '}' AS hour_bucket_profile FROM h GROUP BY date)
            SELECT * FROM t JOIN j USING (date) JOIN m USING (date)""",
    ),
}
