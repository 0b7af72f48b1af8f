"""Trades linked to orders on both sides: edges, lookups, statuses, time anchors.

by: the grain of the result, columns of the trades. on: what must agree besides the order id.
Lookups are reduced to a row for each order before they are joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelens.functions.columns import day_seconds, present_id, rate

#: An order id is hot with more than a HOT_SHARE-th of all edges, and LEAST_HOT at least.
HOT_SHARE, LEAST_HOT = 1_000, 1_000
#: Ids are counted by so many classes first, and one by one only in classes that can have a hot one.
CLASSES = 1 << 14


def edges(trades: DataFrame, keep: list[str]) -> DataFrame:
    """Up to two rows for each trade, (side, trade_order_id), in one scan."""
    sides = F.array(F.struct(F.lit("bid").alias("side"), F.col("BidOrderID").alias("id")), F.struct(F.lit("ask").alias("side"), F.col("AskOrderID").alias("id")))
    out = trades.select(*keep, F.explode(sides).alias("edge"))
    return out.select(*keep, "edge.side", F.col("edge.id").alias("trade_order_id")).where(present_id(F.col("trade_order_id")))


def order_lookup(orders: DataFrame, on: list[str]) -> DataFrame:
    """A row for each order: events, first SendTime, first and last time of day."""
    seconds = day_seconds(F.col("Time"))
    return (
        orders.where(present_id(F.col("OrderId")))
        .groupBy(*on, F.col("OrderId").alias("trade_order_id"))
        .agg(F.count("*").alias("order_events"), F.min("SendTime").alias("order_sendtime"), F.min(seconds).alias("order_first_seconds"), F.max(seconds).alias("order_last_seconds"))
    )


def linked_edges(trades: DataFrame, orders: DataFrame, by: list[str], on: list[str]) -> DataFrame:
    """Edges with what the order's lookup has; order_events is null where there is none."""
    keep = list(dict.fromkeys([*by, *on, "SendTime", "Time"]))
    return edges(trades, keep).join(order_lookup(orders, on), [*on, "trade_order_id"], "left")


def edge_metrics(linked: DataFrame, by: list[str]) -> DataFrame:
    """Per group and side: present, id-equal, time-usable, negative-lag counts."""
    equal = F.col("order_events").isNotNull()
    usable = equal & F.col("order_sendtime").isNotNull() & F.col("SendTime").isNotNull()
    counts = []
    for side in ("bid", "ask"):
        mine = F.col("side") == side
        counts += [
            F.count_if(mine).alias(f"{side}_present_count"),
            F.count_if(mine & equal).alias(f"{side}_id_equal_count"),
            F.count_if(mine & usable).alias(f"{side}_time_usable_count"),
            F.count_if(mine & usable & (F.col("SendTime") < F.col("order_sendtime"))).alias(f"{side}_negative_lag_count"),
        ]
    return linked.groupBy(*by).agg(*counts)


def both_sides(trades: DataFrame, orders: DataFrame, by: list[str], on: list[str]) -> DataFrame:
    """Per group, of the trades that name both orders: how many, and how many have both in the orders."""
    known = orders.where(present_id(F.col("OrderId"))).select(*on, F.col("OrderId").alias("known_id")).distinct()
    both = trades.where(present_id(F.col("BidOrderID")) & present_id(F.col("AskOrderID")))
    bid = known.withColumnRenamed("known_id", "BidOrderID").withColumn("bid_known", F.lit(True))
    ask = known.withColumnRenamed("known_id", "AskOrderID").withColumn("ask_known", F.lit(True))
    joined = both.select(*dict.fromkeys([*by, *on, "BidOrderID", "AskOrderID"])).join(bid, [*on, "BidOrderID"], "left").join(ask, [*on, "AskOrderID"], "left")
    return joined.groupBy(*by).agg(F.count("*").alias("both_present_count"), F.count_if(F.col("bid_known") & F.col("ask_known")).alias("both_id_equal_count"))


def anchor_availability(df: DataFrame, by: list[str], prefix: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(f"{prefix}_rows"), F.count("SendTime").alias(f"{prefix}_sendtime_rows"), F.count("Time").alias(f"{prefix}_time_rows"))


def id_status(present: Column, share: Column) -> Column:
    return F.when(present == 0, "not_applicable").when(share.isNull() | (share == 0), "fail").when(share < 0.5, "warn").otherwise("pass")


def lag_status(equal: Column, usable: Column, order_share: Column, negative: Column) -> Column:
    return (
        F.when(equal == 0, "not_applicable")
        .when(order_share.isNull() | (order_share == 0), "time_anchor_unavailable")
        .when((usable == 0) | (negative > 0.25), "fail")
        .when((usable / equal < 0.5) | (negative > 0.05), "warn")
        .otherwise("pass")
    )


def anchor_status(equal: Column, usable: Column, order_share: Column) -> Column:
    return F.when(equal == 0, "not_applicable").when(order_share.isNull() | (order_share == 0), "unavailable").when(usable < equal, "partial").otherwise("pass")


def overall_status(ids: Column, times: Column) -> Column:
    return (
        F.when(ids == "not_applicable", "not_applicable")
        .when((ids == "fail") | (times == "fail"), "fail")
        .when((ids == "warn") | times.isin("warn", "time_anchor_unavailable", "not_applicable"), "warn")
        .otherwise("pass")
    )


def day_record(trades: DataFrame, orders: DataFrame, by: list[str], on: list[str]) -> DataFrame:
    """Linkage feasibility: counts, rates and five statuses for each group of trades.

    Orders are matched by `on` and the id; where the grain is not among `on`, their anchor rates are
    those of all orders.
    """
    return _record(trades, orders, by, on, edge_metrics(linked_edges(trades, orders, by, on), by), both_sides(trades, orders, by, on))


def _record(trades: DataFrame, orders: DataFrame, by: list[str], on: list[str], metrics: DataFrame, both: DataFrame) -> DataFrame:
    out = trades.groupBy(*by).agg(F.count("*").alias("trade_rows")).join(metrics, by, "left").join(both, by, "left")
    grain = [c for c in by if c in on]
    anchors = anchor_availability(orders, grain, "orders")
    out = out.join(anchors, grain, "left") if grain else out.crossJoin(F.broadcast(anchors))  # one row
    counts = [f"{s}_{m}_count" for s in ("bid", "ask") for m in ("present", "id_equal", "time_usable", "negative_lag")] + ["both_present_count", "both_id_equal_count"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    out = out.withColumns({f"combined_{m}_count": F.col(f"bid_{m}_count") + F.col(f"ask_{m}_count") for m in ("present", "id_equal", "time_usable", "negative_lag")})
    get = F.col
    out = out.withColumns(
        {
            "combined_id_equal_rate": rate(get("combined_id_equal_count"), get("combined_present_count")),
            "both_id_equal_rate": rate(get("both_id_equal_count"), get("both_present_count")),
            "negative_time_lag_rate": rate(get("combined_negative_lag_count"), get("combined_time_usable_count")),
            "order_sendtime_present_rate": rate(get("orders_sendtime_rows"), get("orders_rows")),
        }
    )
    out = out.withColumns(
        {
            "id_equality_status": id_status(get("combined_present_count"), get("combined_id_equal_rate")),
            "time_anchor_status": anchor_status(get("combined_id_equal_count"), get("combined_time_usable_count"), get("order_sendtime_present_rate")),
            "lag_validation_status": lag_status(get("combined_id_equal_count"), get("combined_time_usable_count"), get("order_sendtime_present_rate"), get("negative_time_lag_rate")),
        }
    )
    lag = get("lag_validation_status")
    return out.withColumns(
        {
            "lag_linkage_status": F.when(lag == "time_anchor_unavailable", "not_verifiable").otherwise(lag),
            "linkage_feasibility_status": overall_status(get("id_equality_status"), lag),
        }
    )


@dataclass(frozen=True)
class Colocated:
    """Edges and order lookups as tables bucketed alike by (on, order id), and the few hot ids' edges beside them.

    Names are those of tables in the session's catalog: <name>_edges, <name>_orders, <name>_hot_edges, <name>_hot_orders.
    """

    name: str
    on: tuple[str, ...]

    def linked(self, spark: SparkSession) -> DataFrame:
        """`linked_edges`, with both order ids of each edge's trade, read without a shuffle."""
        keys, table = [*self.on, "trade_order_id"], lambda kind: spark.table(f"{self.name}_{kind}")
        cold = table("edges").join(table("orders").hint("merge"), keys, "left")
        hot = table("hot_edges").join(F.broadcast(table("hot_orders")), keys, "left")  # under HOT_SHARE ids
        return cold.unionByName(hot)

    def drop(self, spark: SparkSession) -> None:
        for kind in ("edges", "orders", "hot_edges", "hot_orders"):
            spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}")


def hot_keys(every: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of more than a HOT_SHARE-th of the edges, and LEAST_HOT at least: fewer than HOT_SHARE rows.

    A hot key's class, by its hash, has as many edges as the key at least, so that keys of the other classes, nearly all, are
    neither kept in a table of all keys nor shuffled.
    """
    own = F.pmod(F.xxhash64(*keys), F.lit(CLASSES))
    sizes = every.groupBy(own.alias("own")).agg(F.count("*").alias("n")).collect()  # CLASSES rows at most
    least = max(LEAST_HOT, sum(r.n for r in sizes) // HOT_SHARE)
    large = [r.own for r in sizes if r.n > least]  # under HOT_SHARE
    found = every.where(own.isin(large)).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > least).select(*keys)
    return every.sparkSession.createDataFrame(found.collect() if large else [], found.schema)


def write_colocated(trades: DataFrame, orders: DataFrame, by: list[str], on: list[str], name: str, folder: str, buckets: int) -> Colocated:
    """Write edges and lookups once, for any number of linkage queries over them, into tables below the folder.

    Ids with more than a HOT_SHARE-th of all edges, fewer than HOT_SHARE of them, would each fill a bucket: their edges lie
    apart, unbucketed, and their lookups are broadcast. Edges without an order keep their place; edges of null `on` match none.
    """
    spark = trades.sparkSession
    keys = [*on, "trade_order_id"]
    every = edges(trades, list(dict.fromkeys([*by, *on, "SendTime", "Time", "BidOrderID", "AskOrderID"])))
    hot = hot_keys(every, keys)
    same = lambda df: reduce(lambda x, y: x & y, [df[k].eqNullSafe(F.col(f"{k}__hot")) for k in keys])
    few = F.broadcast(hot.withColumnsRenamed({k: f"{k}__hot" for k in keys}))
    lookups = order_lookup(orders, on)

    def save(rows: DataFrame, kind: str, bucketed: bool) -> None:
        # One file a bucket: rows are dealt out by the hash that buckets have.
        out = (rows.repartition(buckets, *keys) if bucketed else rows).write.mode("overwrite").format("parquet").option("path", f"{folder}/{name}_{kind}").option("compression", "zstd")
        (out.bucketBy(buckets, *keys).sortBy(*keys) if bucketed else out).saveAsTable(f"{name}_{kind}")

    for kind, rows in (("edges", every), ("orders", lookups)):
        save(rows.join(few, same(rows), "left_anti"), kind, True)
        save(rows.join(few, same(rows), "left_semi"), f"hot_{kind}", False)
    return Colocated(name, tuple(on))


def colocated_record(tables: Colocated, trades: DataFrame, orders: DataFrame, by: list[str]) -> DataFrame:
    """`day_record` from co-located tables: edges meet orders where they lie. Only pairs of orders that trades name are shuffled, counted before."""
    linked = tables.linked(trades.sparkSession)
    paired = linked.where(present_id(F.col("BidOrderID")) & present_id(F.col("AskOrderID")))
    pairs = paired.groupBy(*dict.fromkeys([*by, *tables.on]), "BidOrderID", "AskOrderID").agg(F.count_if(F.col("side") == "bid").alias("n"), F.bool_and(F.col("order_events").isNotNull()).alias("known"))
    both = pairs.groupBy(*by).agg(F.sum("n").alias("both_present_count"), F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("both_id_equal_count"))
    return _record(trades, orders, by, list(tables.on), edge_metrics(linked, by), both)


def time_anchor(trades: DataFrame, orders: DataFrame, by: list[str], on: list[str]) -> DataFrame:
    """Time-of-day agreement of edges with their orders.

    edge_count is over all edges, matched or not; matched_edge_count over those with an order.
    """
    linked = linked_edges(trades, orders, by, on).withColumn("trade_seconds", day_seconds(F.col("Time")))
    first, last, trade = F.col("order_first_seconds"), F.col("order_last_seconds"), F.col("trade_seconds")
    delta = trade - first
    out = linked.groupBy(*by).agg(
        F.count("*").alias("edge_count"),
        F.count("order_events").alias("matched_edge_count"),
        F.count_if(first.isNotNull() & trade.isNotNull()).alias("both_time_count"),
        F.count_if(first <= trade).alias("order_le_trade_count"),
        F.count_if((first <= trade) & (trade <= last)).alias("trade_in_order_span_count"),
        F.count_if(first == trade).alias("same_time_count"),
        F.percentile(delta, 0.5).alias("delta_seconds_p50"),
        F.percentile(delta, 0.99).alias("delta_seconds_p99"),
    )
    share = lambda c: rate(F.col(c), F.col("edge_count"))
    out = out.withColumns({"both_time_rate": share("both_time_count"), "order_le_trade_rate": share("order_le_trade_count"), "same_time_rate": share("same_time_count")})
    status = (
        F.when(F.col("edge_count") == 0, "not_applicable")
        .when(F.col("both_time_rate") == 0, "unavailable")
        .when((F.col("order_le_trade_rate") >= 0.95) & (F.col("same_time_rate") >= 0.5), "weak_pass")
        .when(F.col("order_le_trade_rate") >= 0.8, "warn")
        .otherwise("fail")
    )
    return out.withColumn("coarse_time_anchor_status", status)


def time_grade(sendtime_rate: Column, coarse_status: Column) -> Column:
    """What research a day's times can bear."""
    return F.when(sendtime_rate >= 0.99, "fine_ok").when(coarse_status.isin("pass", "weak_pass"), "coarse_only").otherwise("blocked")


def second_density(df: DataFrame, by: list[str]) -> DataFrame:
    """How rows crowd in seconds: distinct seconds, median, p99 and most rows in one."""
    each = df.where(F.col("Time").isNotNull()).groupBy(*by, "Time").agg(F.count("*").alias("n"))
    return each.groupBy(*by).agg(F.count("*").alias("distinct_seconds"), F.median("n").alias("rows_per_second_median"), F.percentile("n", 0.99).alias("rows_per_second_p99"), F.max("n").alias("rows_per_second_max"))
