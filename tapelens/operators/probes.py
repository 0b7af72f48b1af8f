"""Probes of what coded fields mean: lifecycles, trajectories, directions, sessions, id spaces, codes.

by: the grain, usually ["date"]. All groups are processed at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelens.functions.columns import day_seconds, presence, present_id, rate, session_bucket, turnover
from tapelens.operators.linkage import edges
from tapelens.operators.profile import chunked_lag

PRESENCE_RATES = ["bid_present", "ask_present", "both_present", "bid_only", "ask_only", "neither_side"]
MOVE_RATES = ["uptick", "downtick", "sameprice"]
UPTICK_GAP = 0.02
#: Ranks at which percentiles are bracketed; events up to which an order's pattern is spelt out.
SPLITS, LONG = 2048, 10_000


def order_groups(orders: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """A row for each order: events, SeqNum counts, its first and last SeqNum in order, distinct types and sessions."""
    key = F.struct(*order)
    seq = F.when(F.col("SeqNum").isNotNull(), key)
    session = F.count_distinct("Session") if "Session" in orders.columns else F.lit(0).cast("bigint")
    return (
        orders.where(present_id(F.col("OrderId")))
        .groupBy(*by, "OrderId")
        .agg(F.count("*").alias("event_count"), F.count("SeqNum").alias("seqnum_count"), F.min_by("SeqNum", seq).alias("first_seqnum"), F.max_by("SeqNum", seq).alias("last_seqnum"), F.count_distinct("OrderType").alias("ordertype_count"), session.alias("session_count"))
    )


def trade_groups(trades: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """A row for each order id that trades name: matches and SeqNum counts, first and last in order."""
    keep = list(dict.fromkeys([*by, *order, "SeqNum", *[c for c in ("Session",) if c in trades.columns]]))
    seq = F.when(F.col("SeqNum").isNotNull(), F.struct(*order))
    session = F.count_distinct("Session") if "Session" in trades.columns else F.lit(0).cast("bigint")
    return (
        edges(trades, keep)
        .groupBy(*by, F.col("trade_order_id").alias("OrderId"))
        .agg(F.count("*").alias("trade_match_count"), F.count("SeqNum").alias("trade_seqnum_count"), F.min_by("SeqNum", seq).alias("trade_first_seqnum"), F.max_by("SeqNum", seq).alias("trade_last_seqnum"), session.alias("trade_session_count"))
    )


def linked_trade_groups(groups: DataFrame, orders: DataFrame, by: list[str]) -> DataFrame:
    """Trade groups whose order is among the orders."""
    return groups.join(orders.select(*by, "OrderId"), [*by, "OrderId"], "left_semi")


def lifecycle_status(distinct: Column, linked: Column, multi: Column, many: int = 1_000_000, some: int = 100_000) -> Column:
    """many, some: linked orders from which a rate is trusted."""
    events = multi / distinct
    return (
        F.when(distinct == 0, "not_applicable")
        .when((linked >= many) & (events >= 0.9), "pass")
        .when((linked >= some) & (events >= 0.5), "weak_pass")
        .when((linked / distinct >= 0.02) & (events >= 0.5), "weak_pass")
        .otherwise("unknown")
    )


def lifecycle(orders: DataFrame, trades: DataFrame, by: list[str], order: list[str], trade_order: list[str]) -> DataFrame:
    """Order lifecycles per group: linked, multi-event, single- and multi-trade, cross-session orders and a status.

    cross_session_count compares session counts of the two sides, cross_session_order_count looks
    for orders seen in several sessions.
    """
    own, named = order_groups(orders, by, order), trade_groups(trades, by, trade_order)
    both = own.join(named, [*by, "OrderId"], "left")
    out = both.groupBy(*by).agg(
        F.count("*").alias("distinct_orderids"),
        F.count("trade_match_count").alias("linked_orderids"),
        F.count_if(F.col("event_count") > 1).alias("multi_event_orderids"),
        F.count_if(F.col("trade_match_count") == 1).alias("single_trade_orderids"),
        F.count_if(F.col("trade_match_count") > 1).alias("multi_trade_orderids"),
        F.count_if(F.col("ordertype_count") > 1).alias("multi_type_orderids"),
        F.count_if(F.col("session_count") != F.col("trade_session_count")).alias("cross_session_count"),
        F.count_if((F.col("session_count") > 1) | (F.col("trade_session_count") > 1)).alias("cross_session_order_count"),
        F.sum("trade_seqnum_count").alias("trade_seqnum_rows"),
    )
    of = F.col("distinct_orderids")
    return out.withColumns(
        {
            "linked_rate": rate(F.col("linked_orderids"), of),
            "multi_event_rate": rate(F.col("multi_event_orderids"), of),
            "status": lifecycle_status(of, F.col("linked_orderids"), F.col("multi_event_orderids")),
        }
    )


def direction_distribution(trades: DataFrame, by: list[str]) -> DataFrame:
    """Counts of direction codes and how they agree with the sides linked. Code 2 counts as positive and as other."""
    d = F.col("Dir")
    has = presence()
    linked = has["bid_present"] | has["ask_present"]
    fits = F.coalesce(((d > 0) & has["ask_present"]) | ((d < 0) & has["bid_present"]), F.lit(False))
    out = trades.groupBy(*by).agg(
        F.count("*").alias("tested_rows"),
        F.count("Dir").alias("nonnull_count"),
        F.count_if(d == 0).alias("zero_count"),
        F.count_if(d > 0).alias("pos_count"),
        F.count_if(d < 0).alias("neg_count"),
        F.count_if(~d.isin(-1, 0, 1)).alias("other_count"),
        F.count_distinct("Dir").alias("distinct_values"),
        F.array_join(F.sort_array(F.collect_set("Dir")).cast("array<string>"), ",").alias("observed_values"),
        F.count_if(linked).alias("linked_edge_count"),
        F.count_if(linked & fits).alias("linked_consistent_count"),
    )
    ok = (F.col("nonnull_count") == F.col("tested_rows")) & F.col("distinct_values").between(1, 3)
    return out.withColumns({"nonnull_rate": rate(F.col("nonnull_count"), F.col("tested_rows")), "linked_consistency_rate": rate(F.col("linked_consistent_count"), F.col("linked_edge_count")), "status": F.when(ok, "weak_pass").otherwise("unknown")})


def tick_moves(trades: DataFrame, by: list[str], chunk: str, order: list[str]) -> DataFrame:
    """Adds how the price moved against the row before in the group's order, presence of sides, turnover and session bucket.

    chunk, a column that does not fall as the order rises, bounds what one task sorts.
    """
    lagged = chunked_lag(trades, by, chunk, order, ["Price"])
    move = F.col("Price") - F.col("prev_Price")
    tested = move.isNotNull()
    return lagged.withColumns(
        {
            **presence(),
            "move_tested": tested,
            "uptick": F.when(tested, (move > 0).cast("int")),
            "downtick": F.when(tested, (move < 0).cast("int")),
            "sameprice": F.when(tested, (move == 0).cast("int")),
            "turnover_proxy": turnover(),
            "time_bucket": session_bucket(F.col("Time")),
        }
    )


def brackets(df: DataFrame, by: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    """(key, total, numbers, share): a row for each group; share, for each wanted share, is where its places lie.

    A share's struct has the two places it is interpolated between, and a low and a high value around them (null:
    unbounded), taken from a mergeable sketch of the group's values at SPLITS + 1 even ranks. Its error is a quarter of
    their distance, and two of them are added on either side, so between low and high are at most six SPLITS-ths of the
    group's numbers, repeats of one value and two rows aside. NaN is above all numbers.
    """
    value = F.col(column).cast("double")
    number = F.when(~F.isnan(value), value)
    grid = F.percentile_approx(number, [i / SPLITS for i in range(SPLITS + 1)], 4 * SPLITS)
    out = df.where(F.col(column).isNotNull()).groupBy(F.struct(*by).alias("key")).agg(F.count("*").alias("total"), F.count(number).alias("numbers"), grid.alias("grid"))

    def around(name: str, share: float) -> Column:
        place = F.lit(share) * (F.col("total") - 1)
        rank = lambda p: F.try_divide(p, "numbers") * SPLITS
        low, high = F.floor(rank(F.floor(place))) - 2, F.ceil(rank(F.ceil(place) + 1)) + 2
        at = lambda i: F.get("grid", i.cast("int"))
        return F.struct(F.lit(name).alias("name"), place.alias("place"), F.when(low > 0, at(low)).alias("low"), F.when(high < SPLITS, at(high)).alias("high"))

    return out.select("key", "total", "numbers", F.array(*[around(n, s) for n, s in shares.items()]).alias("share"))


def held_values(df: DataFrame, by: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    """(key, numbers, share, value, n): the distinct values between a share's low and high with their rows; value null: all rows below."""
    value = F.col(column).cast("double")
    values = df.where(F.col(column).isNotNull() & ~F.isnan(value)).select(F.struct(*by).alias("key"), value.alias("value"))
    each = values.join(brackets(df, by, column, shares), "key").select("key", "numbers", "value", F.explode("share").alias("share"))
    low, high = F.col("share.low"), F.col("share.high")
    kept = each.where(high.isNull() | (F.col("value") <= high))
    return kept.groupBy("key", "numbers", "share", F.when(low.isNull() | (F.col("value") >= low), F.col("value")).alias("value")).agg(F.count("*").alias("n"))


def exact_percentiles(df: DataFrame, by: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    """(key, a column for each share): interpolated percentiles of a group's values; key is a struct of `by`.

    Places are first bracketed by a sketch (`brackets`), rows below a bracket counted, and only the values inside
    sorted, so that the values of a group are in no one task, however they lie. Null values do not count; NaN is above all
    numbers; columns of any name may be in the table.
    """
    inside = held_values(df, by, column, shares)
    ordered = Window.partitionBy("key", "share").orderBy(F.asc_nulls_first("value"))
    inside = inside.withColumn("first", F.coalesce(F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    of = lambda p: F.max(F.when((p >= F.col("first")) & (p < F.col("first") + F.col("n")), F.col("value")))
    place = F.col("share.place")
    found = inside.groupBy("key", F.col("share.name").alias("name")).agg(of(F.floor(place)).alias("lower"), of(F.ceil(place)).alias("upper"))
    asked = brackets(df, by, column, shares).select("key", "numbers", F.explode("share").alias("share")).select("key", "numbers", F.col("share.name").alias("name"), F.col("share.place").alias("place"))
    known = asked.join(found, ["key", "name"], "left")
    end = lambda c, p: F.when(p >= F.col("numbers"), F.lit(float("nan"))).otherwise(F.col(c))
    lower, upper = end("lower", F.floor("place")), end("upper", F.ceil("place"))
    exact = F.when((F.col("place") == F.floor("place")) | (lower == upper), lower).otherwise(lower + (F.col("place") - F.floor("place")) * (upper - lower))
    return known.groupBy("key").agg(*[F.max(F.when(F.col("name") == name, exact)).alias(name) for name in shares])


def direction_sizes(trades: DataFrame, by: list[str]) -> DataFrame:
    """(key, medians and 90th percentiles of volume and turnover) of each direction code of a group; key is a struct of `by` and Dir."""
    shares = lambda c: {f"{c}_median": 0.5, f"{c}_p90": 0.9}
    volume = exact_percentiles(trades, [*by, "Dir"], "Volume", shares("volume"))
    return volume.join(exact_percentiles(trades.withColumn("turnover_proxy", turnover()), [*by, "Dir"], "turnover_proxy", shares("turnover_proxy")), "key", "full")


def direction_contrast(moves: DataFrame, by: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """A row for each direction code of a group: its share, side rates, move rates, and sizes if given (`direction_sizes`). A null code is a group."""
    out = moves.groupBy(*by, "Dir").agg(
        F.count("*").alias("row_count"),
        *[F.avg(F.col(c).cast("int")).alias(f"{c}_rate") for c in PRESENCE_RATES],
        F.count_if("move_tested").alias("move_tested_count"),
        *[F.avg(c).alias(f"{c}_rate") for c in MOVE_RATES],
    )
    if sizes is not None:
        out = out.withColumn("key", F.struct(*by, "Dir")).join(sizes, "key", "left").drop("key")
    whole = F.sum("row_count").over(Window.partitionBy(*by))  # a few codes in a group
    return out.withColumn("row_share", rate(F.col("row_count"), whole))


def bucket_mix(moves: DataFrame, by: list[str]) -> DataFrame:
    """(by, Dir, time_bucket): rows, share of the code's rows, uptick rate."""
    out = moves.groupBy(*by, "Dir", "time_bucket").agg(F.count("*").alias("bucket_rows"), F.avg("uptick").alias("uptick_rate"))
    return out.withColumn("bucket_share", F.col("bucket_rows") / F.sum("bucket_rows").over(Window.partitionBy(*by, "Dir")))


def contrast_gaps(contrast: DataFrame, mix: DataFrame, by: list[str]) -> DataFrame:
    """A row for each group: how codes 1 and 2 differ, and how code 0 differs from both."""
    rates = [f"{c}_rate" for c in (*PRESENCE_RATES, *MOVE_RATES)]
    pick = lambda code, c: F.max(F.when(F.col("Dir") == code, F.col(c))).alias(f"{c}_{code}")
    wide = contrast.groupBy(*by).agg(*[pick(code, c) for code in (0, 1, 2) for c in (*rates, "row_count")])
    # The mean over what is there: a rate that a code lacks is left out.
    apart = lambda names, left, right: F.filter(F.array(*[F.abs(left(c) - right(c)) for c in names]), F.isnotnull)
    mean = lambda list_: F.when(F.size(list_) > 0, F.aggregate(list_, F.lit(0.0), lambda a, x: a + x) / F.size(list_))
    gap = lambda names, left, right: mean(apart(names, left, right))
    of = lambda code: lambda c: F.col(f"{c}_{code}")
    pooled = lambda c: (F.col(f"{c}_1") + F.col(f"{c}_2")) / 2
    sides, moves = [f"{c}_rate" for c in PRESENCE_RATES], [f"{c}_rate" for c in MOVE_RATES]
    counted = lambda *codes: F.coalesce(F.sum(F.when(F.col("Dir").isin(*codes), F.col("bucket_rows"))), F.lit(0))
    rows = lambda *codes: F.sum(F.when(F.col("Dir").isin(*codes), F.col("bucket_rows"))).over(Window.partitionBy(*by))
    shared = mix.withColumns({"of0": rows(0), "of12": rows(1, 2)})
    up = lambda code: F.max(F.when(F.col("Dir") == code, F.col("uptick_rate")))
    buckets = shared.groupBy(*by, "time_bucket").agg(F.abs(counted(0) / F.max("of0") - counted(1, 2) / F.max("of12")).alias("apart"), (up(1) - up(2)).alias("bucket_gap"))
    sign = F.signum("bucket_gap")
    per = buckets.groupBy(*by).agg((F.sum("apart") / 2).alias("bucket_distance"), (F.min(sign) == F.max(sign)).alias("same"))
    out = wide.join(per, by)
    return out.select(
        *by,
        *[(F.col(f"{c}_rate_1") - F.col(f"{c}_rate_2")).alias(f"{c}_gap") for c in MOVE_RATES],
        gap(sides, of(1), of(2)).alias("linkage_gap"),
        gap(moves, of(1), of(2)).alias("price_move_gap"),
        F.coalesce("same", F.lit(False)).alias("bucket_uptick_consistent"),
        mean(F.filter(F.array(gap(sides, of(0), pooled), gap(moves, of(0), pooled), F.col("bucket_distance")), F.isnotnull)).alias("dir0_specialness"),
    )


def contrast_yearly(gaps: DataFrame, by: list[str], threshold: float = UPTICK_GAP) -> DataFrame:
    """A row for each year: mean gaps, whether every day has a clear uptick gap of one sign, status."""
    g = F.col("uptick_gap")
    out = gaps.groupBy(*by).agg(
        F.count("*").alias("days_run"),
        *[F.avg(f"{c}_gap").alias(f"{c}_gap_avg") for c in (*MOVE_RATES, "linkage")],
        F.avg("dir0_specialness").alias("dir0_specialness_score"),
        F.count_if(g >= threshold).alias("clear_up"),
        F.count_if(g <= -threshold).alias("clear_down"),
        F.count_if("bucket_uptick_consistent").alias("bucket_consistent_days"),
    )
    days = F.col("days_run")
    steady = (F.col("clear_up") == days) | (F.col("clear_down") == days)
    status = F.when(steady & (F.col("bucket_consistent_days") == days), "candidate_directional_signal").otherwise("no_stable_contrast")
    return out.withColumns({"uptick_sign_consistent": steady, "status": status}).drop("clear_up", "clear_down")


def top_values(df: DataFrame, by: list[str], column: str, most: int = 5) -> DataFrame:
    """Per group the most frequent values as `value:count` text, by count and then value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), F.asc(column)))
    top = counts.withColumn("place", place).where(F.col("place") <= most)
    listed = F.array_sort(F.collect_list(F.struct("place", F.concat_ws(":", F.col(column).cast("string"), "n").alias("t"))))
    return top.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: x["t"]), ",").alias(f"top_{column}"))


def trajectories(orders: DataFrame, by: list[str], order: list[str], chunk: Column | None = None, long: int = LONG) -> DataFrame:
    """A row for each order: its distinct event codes, and the codes in order, as text.

    The pattern of an order with more than `long` events is the text `<events>:<digest>`: its codes are numbered and cut in
    blocks of `long`, and the digest is the SHA-256 of the blocks' SHA-256 digests in order; so equal sequences have
    equal patterns, and others do not. To number them without one task for an order, events are dealt out by `chunk`, which
    must not fall as the order rises; else by the first order column in steps of `long`, where that is an integer.
    """
    if chunk is None:
        integer = dict(orders.dtypes)[order[0]] in ("tinyint", "smallint", "int", "bigint")
        chunk = F.floor(F.col(order[0]) / long) if integer else F.lit(0)
    # Keys are structs, in which nulls are equal.
    rows = orders.where(present_id(F.col("OrderId")) & F.col("OrderType").isNotNull()).select(F.struct(*by, "OrderId").alias("key"), F.struct(chunk.alias("at")).alias("chunk"), F.struct(*order, "OrderType").alias("event"))
    sizes = rows.groupBy("key", "chunk").agg(F.count("*").alias("n"), F.collect_set("event.OrderType").alias("codes"))
    many = sizes.groupBy("key").agg(F.sum("n").alias("events"), F.size(F.array_distinct(F.flatten(F.collect_list("codes")))).cast("bigint").alias("n_types")).where(F.col("events") > long)
    text = lambda listed: F.array_join(F.transform(F.array_sort(listed), lambda x: x["OrderType"].cast("string")), ",")
    short = rows.join(many, "key", "left_anti").groupBy("key").agg(F.count_distinct("event.OrderType").alias("n_types"), text(F.collect_list("event")).alias("pattern"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.join(many, "key").select("key", "chunk", "events", "n_types", F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("key", "chunk").orderBy("event")
    placed = rows.join(starts, ["key", "chunk"]).withColumn("place", F.col("before") + F.row_number().over(inside) - 1)
    blocks = placed.groupBy("key", "events", "n_types", F.floor(F.col("place") / long).alias("block")).agg(text(F.collect_list(F.struct("place", "event.OrderType"))).alias("codes"))
    digests = F.transform(F.array_sort(F.collect_list(F.struct("block", F.sha2("codes", 256).alias("digest")))), lambda x: x["digest"])
    longer = blocks.groupBy("key", "events", "n_types").agg(F.sha2(F.array_join(digests, ""), 256).alias("digest"))
    longer = longer.select("key", "n_types", F.concat_ws(":", F.col("events").cast("string"), "digest").alias("pattern"))
    return short.unionByName(longer).select("key.*", "n_types", "pattern")


def ordertype_probe(orders: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Event codes per group: rows, codes, orders of one and several codes, patterns and the three most frequent, status."""
    base = orders.groupBy(*by).agg(F.count("*").alias("tested_rows"), F.count("OrderType").alias("nonnull_count"), F.count_distinct("OrderType").alias("distinct_values"))
    paths = trajectories(orders, by, order)
    per = paths.groupBy(*by).agg(F.count("*").alias("distinct_orderids"), F.count_if(F.col("n_types") == 1).alias("single_type_orderids"), F.count_if(F.col("n_types") > 1).alias("multi_type_orderids"), F.count_distinct("pattern").alias("pattern_count"))
    out = base.join(per, by, "left").join(top_values(orders, by, "OrderType"), by, "left").join(top_values(paths, by, "pattern", 3), by, "left")
    status = F.when((F.col("distinct_values") > 0) & (F.col("multi_type_orderids") > 0), "weak_pass").otherwise("unknown")
    return out.withColumns({"multi_type_rate": rate(F.col("multi_type_orderids"), F.col("distinct_orderids")), "top_pattern_count": F.least(F.lit(3), F.col("pattern_count")).cast("bigint"), "status": status})


def session_probe(orders: DataFrame, trades: DataFrame, by: list[str]) -> DataFrame:
    """Session values per group; a table without the column is not run."""
    if "Session" not in orders.columns and "Session" not in trades.columns:
        return orders.select(*by).distinct().select(*by, F.lit(0).cast("bigint").alias("tested_rows"), F.lit(None).cast("double").alias("orders_session_rate"), F.lit(None).cast("double").alias("trades_session_rate"), F.lit(None).cast("bigint").alias("distinct_sessions"), F.lit(None).cast("bigint").alias("cross_session_orders"), F.lit("not_run").alias("status"))
    with_session = lambda df: df if "Session" in df.columns else df.withColumn("Session", F.lit(None).cast("string"))
    orders, trades = with_session(orders), with_session(trades)
    own = orders.groupBy(*by).agg(F.count("*").alias("tested_rows"), rate(F.count("Session"), F.count("*")).alias("orders_session_rate"), F.count_distinct("Session").alias("distinct_sessions"))
    sold = trades.groupBy(*by).agg(rate(F.count("Session"), F.count("*")).alias("trades_session_rate"))
    per = orders.where("OrderId IS NOT NULL AND Session IS NOT NULL").groupBy(*by, "OrderId").agg(F.count_distinct("Session").alias("n")).groupBy(*by).agg(F.count_if(F.col("n") > 1).alias("cross_session_orders"))
    out = own.join(sold, by, "left").join(per, by, "left").withColumn("cross_session_orders", F.coalesce("cross_session_orders", F.lit(0)))
    return out.withColumn("status", F.when(F.col("distinct_sessions") > 0, "weak_pass").otherwise("unknown"))


def id_space(df: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """The shape of present ids in each group."""
    v = F.col(id_col)
    rows = df.where(present_id(v))
    out = rows.groupBy(F.struct(*by).alias("key")).agg(
        F.count("*").alias("present_count"),
        F.count_distinct(v).alias("distinct_count"),
        F.min(v).alias("min_id"),
        F.max(v).alias("max_id"),
        F.mode(F.length(v.cast("string")), True).alias("modal_digits"),
        F.mode(v % 10, True).alias("modal_last_digit"),
        F.avg(v % 2).alias("odd_share"),
    )
    return out.join(exact_percentiles(rows, by, id_col, {"p50": 0.5, "p99": 0.99}), "key").select("key.*", *[c for c in out.columns if c != "key"], "p50", "p99")


def witnesses(sources: dict[str, tuple[DataFrame, str]], by: list[str], order: list[str]) -> DataFrame:
    """For each source the first row that holds the group's greatest id over all sources; groups where two sources or more hold it."""
    top = None
    for df, id_col in sources.values():
        own = df.where(present_id(F.col(id_col))).groupBy(*by).agg(F.max(id_col).alias("witness_id"))
        top = own if top is None else top.unionByName(own)
    top = top.groupBy(*by).agg(F.max("witness_id").alias("witness_id"))
    out = None
    for name, (df, id_col) in sources.items():
        hit = df.select(*by, F.col(id_col).alias("witness_id"), F.struct(*order).alias("at")).join(top, [*by, "witness_id"])
        first = hit.groupBy(*by, "witness_id").agg(F.min("at").alias("at")).select(*by, "witness_id", F.lit(name).alias("source"), "at.*")
        out = first if out is None else out.unionByName(first)
    return out.withColumn("n_sources", F.count("*").over(Window.partitionBy(*by))).where("n_sources >= 2")


def broker_code(code: Column) -> Column:
    """A code without white space around it; digits are filled up to four, an empty code is null."""
    bare = F.trim(code.cast("string"))
    return F.when(bare.rlike(r"^\d{1,3}$"), F.lpad(bare, 4, "0")).when(bare != "", bare)


def broker_profile(df: DataFrame, by: list[str], codes: DataFrame, code_col: str = "BrokerNo") -> DataFrame:
    """Broker codes per group against a reference list: counts, rates, the ten most frequent unmatched as `code:rows`.

    codes: (code); one row per code. Codes of both sides are normalised, and counted before they are joined. The zero
    rate is of all tested rows.
    """
    rows = df.select(*by, broker_code(F.col(code_col)).alias("code"))
    base = rows.groupBy(*by).agg(F.count("*").alias("tested_rows"), F.count("code").alias("nonnull_count"), F.count_if(F.col("code").isin("0", "0000")).alias("zero_count"))
    counts = rows.where("code IS NOT NULL").groupBy(*by, "code").agg(F.count("*").alias("n"))
    known = counts.join(codes.select(broker_code(F.col("code")).alias("code"), F.lit(True).alias("known")).where("code IS NOT NULL").distinct(), "code", "left")
    per = known.groupBy(*by).agg(F.count("*").alias("distinct_codes"), F.count("known").alias("matched_codes"), F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("matched_rows"))
    unmatched = known.where("known IS NULL").withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "code"))).where("place <= 10")
    listed = F.array_sort(F.collect_list(F.struct("place", F.concat_ws(":", "code", "n").alias("t"))))
    top = unmatched.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: x["t"]), ",").alias("unmatched_sample"))
    out = base.join(per, by, "left").join(top, by, "left")
    return out.withColumns({"zero_rate": rate(F.col("zero_count"), F.col("tested_rows")), "matched_distinct_rate": rate(F.col("matched_codes"), F.col("distinct_codes"))})


def broker_decision(profile: DataFrame) -> DataFrame:
    """One decision over all groups of a broker profile."""
    out = profile.agg(F.sum("tested_rows").alias("tested_rows"), F.bool_or(F.col("zero_rate") > 0.05).alias("high_zero"), F.bool_or(F.col("matched_distinct_rate") < 0.95).alias("imperfect"))
    decision = F.when(F.coalesce("tested_rows", F.lit(0)) == 0, "insufficient_evidence").when(F.col("high_zero") | F.col("imperfect"), "lookup_only").otherwise("not_alpha_ready")
    return out.select("tested_rows", F.coalesce("high_zero", F.lit(False)).alias("high_zero"), F.coalesce("imperfect", F.lit(False)).alias("imperfect"), decision.alias("decision"))


def seat_activity(df: DataFrame, by: list[str]) -> DataFrame:
    """Volume by seat; codes 0 and 0000 and nulls form the unattributed bucket."""
    seat = F.when(F.col("BrokerNo").isNull() | F.col("BrokerNo").isin("0", "0000"), "unattributed").otherwise(F.col("BrokerNo"))
    signed = F.when(F.col("Dir") == 2, F.col("Volume")).when(F.col("Dir") == 1, -F.col("Volume")).otherwise(0)
    return df.groupBy(*by, seat.alias("seat")).agg(F.count("*").alias("row_count"), F.sum("Volume").alias("volume"), F.sum(signed).alias("net_volume"))


def field_by_session(df: DataFrame, by: list[str], field: str) -> DataFrame:
    """How a field's values spread over the parts of the day."""
    return df.groupBy(*by, session_bucket(F.col("Time")).alias("time_bucket"), field).agg(F.count("*").alias("row_count"), F.min(day_seconds(F.col("Time"))).alias("first_second"))
