"""The driver's tables as objects of the tick model, as DataFrames and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _hms(seconds: Column) -> Column:
    part = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(part(F.floor(seconds / 3600)), part(F.floor(seconds / 60) % 60), part(seconds % 60))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as trades: the order is the bid, the part times ten the ask."""
    n = F.col("l_orderkey") * 37 + F.col("l_linenumber") * 1009 + F.col("l_partkey")
    return read(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.year("l_shipdate").alias("year"),
        F.col("l_shipdate").alias("SendTime"),
        (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 10000 + F.col("l_suppkey")).alias("TickID"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("SeqNum"),
        _hms(F.lit(32000) + n % 27000).alias("Time"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("Price"),
        F.col("l_quantity").cast("bigint").alias("Volume"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(0).alias("Dir"),
        F.col("l_orderkey").alias("BidOrderID"),
        (F.col("l_partkey") * 10).alias("AskOrderID"),
        F.lpad(F.col("l_suppkey").cast("string"), 4, "0").alias("BrokerNo"),
        F.concat(F.lit("trade/"), F.lpad((F.col("l_partkey") * 37 % 100000).cast("string"), 5, "0"), F.lit(".csv")).alias("source_file"),
        F.floor(F.col("l_orderkey") / 1000).alias("chunk"),
    )


TRADES = """trades AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(year(l_shipdate) AS INT) AS year, l_shipdate AS SendTime,
    ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS TickID,
    CASE WHEN l_partkey % 50 <> 0 THEN l_orderkey * 8 + l_linenumber END AS SeqNum,
    lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS Time,
    l_extendedprice / l_quantity AS Price, CAST(l_quantity AS BIGINT) AS Volume,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 0 END AS Dir, l_orderkey AS BidOrderID, l_partkey * 10 AS AskOrderID,
    lpad(CAST(l_suppkey AS VARCHAR), 4, '0') AS BrokerNo, 'trade/' || lpad(CAST(l_partkey * 37 % 100000 AS VARCHAR), 5, '0') || '.csv' AS source_file,
    l_orderkey // 1000 AS chunk
    FROM (SELECT *, 32000 + (l_orderkey * 37 + l_linenumber * 1009 + l_partkey) % 27000 AS s FROM lineitem))"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as one add event an order; some have no SendTime."""
    n = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        n.alias("OrderId"),
        F.when(n % 40 != 0, F.col("o_orderdate")).alias("SendTime"),
        _hms(F.lit(32000) + n * 37 % 27000).alias("Time"),
        F.col("o_totalprice").alias("Price"),
    )


ORDERS = """book AS (SELECT o_orderkey AS OrderId, CASE WHEN o_orderkey % 40 <> 0 THEN o_orderdate END AS SendTime,
    lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS Time, o_totalprice AS Price
    FROM (SELECT *, 32000 + o_orderkey * 37 % 27000 AS s FROM orders))"""


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as order events of a day: the user is the order, the type its code."""
    n = F.col("event_id")
    code = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "click", 3).when(F.col("event_type") == "purchase", 4)
    return read(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"),
        F.year("ts").alias("year"),
        F.when(n % 25 != 0, n).alias("SeqNum"),
        n.alias("row_num_in_file"),
        F.col("user_id").alias("OrderId"),
        code.alias("OrderType"),
        F.when(n % 31 != 0, F.col("ts")).alias("SendTime"),
        F.date_format("ts", "HHmmss").alias("Time"),
        F.col("value").alias("Price"),
        (n % 7 - 1).alias("Volume"),
        F.when(n % 3 != 0, (n % 11 - 1).cast("int")).alias("Level"),
        F.when(n % 5 != 0, n % 9 - 1).alias("VolumePre"),
        F.concat(F.lit("order/"), F.lpad(F.col("user_id").cast("string"), 5, "0"), F.lit(".csv")).alias("source_file"),
        F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("Session"),
    )


ORDER_EVENTS = """ev AS (SELECT CAST(ts AS DATE) AS date, CAST(year(ts) AS INT) AS year, CASE WHEN event_id % 25 <> 0 THEN event_id END AS SeqNum, event_id AS row_num_in_file, user_id AS OrderId,
    CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END AS OrderType,
    CASE WHEN event_id % 31 <> 0 THEN ts END AS SendTime, strftime(ts, '%H%M%S') AS Time, value AS Price, event_id % 7 - 1 AS Volume,
    CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 11 - 1 AS INT) END AS Level, CASE WHEN event_id % 5 <> 0 THEN event_id % 9 - 1 END AS VolumePre, 'order/' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '.csv' AS source_file,
    CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS Session FROM events)"""


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as trades against other users' orders of the same day; two in three name no order at all."""
    n = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"),
        n.alias("row_num_in_file"),
        F.when(n % 2 == 0, n).alias("SeqNum"),
        F.when((n % 3 == 0) & (n % 4 != 0), F.col("user_id") + 1).alias("BidOrderID"),
        F.when(n % 3 == 0, n % 211).otherwise(0).alias("AskOrderID"),
        F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("Session"),
    )


EVENT_TRADES = """deal AS (SELECT CAST(ts AS DATE) AS date, event_id AS row_num_in_file, CASE WHEN event_id % 2 = 0 THEN event_id END AS SeqNum,
    CASE WHEN event_id % 3 = 0 AND event_id % 4 <> 0 THEN user_id + 1 END AS BidOrderID, CASE WHEN event_id % 3 = 0 THEN event_id % 211 ELSE 0 END AS AskOrderID,
    CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS Session FROM events)"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the all-text rows of order members, with null tokens and bad cells at fixed places."""
    n, text = F.col("event_id"), lambda c: c.cast("string")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))")
    return read(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"),
        F.when(n % 97 == 0, "NULL").otherwise(text(n)).alias("SeqNum"),
        F.when(n % 89 == 0, "abc").otherwise(F.concat(F.lit(" "), text(F.col("user_id")), F.lit(" "))).alias("OrderId"),
        F.when(F.col("event_type") == "error", "nan").otherwise("1").alias("OrderType"),
        F.when(n % 83 == 0, "12:30:00").when(n % 79 == 0, "").otherwise(text(F.date_format("ts", "HHmmss").cast("int"))).alias("Time"),
        F.when(n % 71 == 0, "null").otherwise(text(F.floor("value"))).alias("Price"),
        text(n % 7).alias("Volume"),
        F.when(n % 61 == 0, "x").otherwise(F.concat(text(micros), F.lit("123"))).alias("SendTime"),
        F.concat(F.lit("order/"), F.lpad(text(F.col("user_id")), 5, "0"), F.lit(".csv")).alias("source_file"),
        n.alias("row_num_in_file"),
    )


RAW_ORDERS = """raw AS (SELECT CAST(ts AS DATE) AS date, CASE WHEN event_id % 97 = 0 THEN 'NULL' ELSE CAST(event_id AS VARCHAR) END AS SeqNum,
    CASE WHEN event_id % 89 = 0 THEN 'abc' ELSE ' ' || user_id || ' ' END AS OrderId, CASE WHEN event_type = 'error' THEN 'nan' ELSE '1' END AS OrderType,
    CASE WHEN event_id % 83 = 0 THEN '12:30:00' WHEN event_id % 79 = 0 THEN '' ELSE CAST(CAST(strftime(ts, '%H%M%S') AS INT) AS VARCHAR) END AS Time,
    CASE WHEN event_id % 71 = 0 THEN 'null' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS Price, CAST(event_id % 7 AS VARCHAR) AS Volume,
    CASE WHEN event_id % 61 = 0 THEN 'x' ELSE epoch_us(ts) || '123' END AS SendTime, 'order/' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '.csv' AS source_file,
    event_id AS row_num_in_file FROM events),
 cleaned AS (SELECT *, CASE WHEN trim(SeqNum) IN ('', 'NULL', 'null', 'nan', 'NaN') THEN NULL ELSE trim(SeqNum) END AS q, trim(OrderId) AS o,
    CASE WHEN trim(Time) IN ('', 'NULL', 'null', 'nan', 'NaN') THEN NULL ELSE trim(Time) END AS t, CASE WHEN Price = 'null' THEN NULL ELSE Price END AS p FROM raw),
 typed AS (SELECT date, source_file, row_num_in_file, TRY_CAST(q AS BIGINT) AS SeqNum, TRY_CAST(o AS BIGINT) AS OrderId, CASE WHEN OrderType = '1' THEN 1 END AS OrderType,
    CASE WHEN regexp_full_match(t, '[0-9]{1,6}') THEN lpad(t, 6, '0') END AS Time, TRY_CAST(p AS DOUBLE) AS Price, CAST(Volume AS BIGINT) AS Volume,
    SendTime AS SendTimeRaw, TRY_CAST(SendTime AS BIGINT) AS SendTimeNs, make_timestamp(TRY_CAST(SendTime AS BIGINT) // 1000) AS SendTime, q, o, t, p FROM cleaned),
 judged AS (SELECT *, list_filter([
      CASE WHEN SeqNum IS NULL THEN CASE WHEN q IS NULL THEN 'null_required_input:SeqNum' ELSE 'cast_failed_required:SeqNum' END END,
      CASE WHEN OrderId IS NULL THEN CASE WHEN o IS NULL THEN 'null_required_input:OrderId' ELSE 'cast_failed_required:OrderId' END END,
      CASE WHEN Time IS NULL THEN CASE WHEN t IS NULL THEN 'null_required_input:Time' ELSE 'invalid_required_format:Time' END END,
      CASE WHEN Price IS NULL THEN CASE WHEN p IS NULL THEN 'null_required_input:Price' ELSE 'cast_failed_required:Price' END END], lambda x: x IS NOT NULL) AS reasons FROM typed)"""
