"""Operators under skew: hot order ids, outlying values, chunks without number, orders without end."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelens.operators import linkage, probes, profile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Co-located linkage


@pytest.fixture
def books(spark):
    """One order id has a third of all edges; ids, dates and times may be null."""
    r = random.Random(1)
    ids = lambda: r.choice([7, r.randint(1, 400), r.randint(1, 400), 0, None])
    day = lambda: r.choice(["d1", "d2", "d3", None])
    stamp = lambda: r.choice([None, "2026-01-05 09:30:00", "2026-01-05 09:31:00"])
    trades = [(day(), ids(), ids(), stamp(), r.choice(["093000", None])) for _ in range(24_000)]
    orders = [(day(), r.choice([7, r.randint(1, 300)]), stamp(), "092959") for _ in range(1_500)]
    cast = lambda df: df.withColumn("SendTime", F.col("SendTime").cast("timestamp"))
    return cast(spark.createDataFrame(trades, "date string, BidOrderID bigint, AskOrderID bigint, SendTime string, Time string")), cast(spark.createDataFrame(orders, "date string, OrderId bigint, SendTime string, Time string"))


@pytest.mark.parametrize("on", [["date"], []])
def test_colocated_record(spark, books, tmp_path, on):
    trades, orders = books
    tables = linkage.write_colocated(trades, orders, ["date"], on, f"colocated_{len(on)}", str(tmp_path), 5)
    try:
        assert rows(linkage.colocated_record(tables, trades, orders, ["date"])) == rows(linkage.day_record(trades, orders, ["date"], on))
        hot = spark.table(f"{tables.name}_hot_edges")
        assert {r.trade_order_id for r in hot.select("trade_order_id").distinct().collect()} == {7}
        assert hot.count() > spark.table(f"{tables.name}_edges").count() / 4 and spark.table(f"{tables.name}_edges").where("trade_order_id = 7 AND date IS NOT NULL").count() == 0
        plan = tables.linked(spark)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and not re.search(r"\bExchange\b", plan)  # only the few hot lookups are broadcast
        assert len(list(tmp_path.glob(f"{tables.name}_edges/*.parquet"))) <= 5
        grouped = tables.linked(spark).groupBy(*on, "trade_order_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" in grouped  # beside the hot ones, so they meet anew
    finally:
        tables.drop(spark)


@pytest.mark.parametrize("on", [["date"], []])
def test_hot_keys_are_counted_by_classes(spark, books, monkeypatch, on):
    """The same keys as by counting all, whatever shares their class; keys of small classes are not counted one by one."""
    monkeypatch.setattr(linkage, "LEAST_HOT", 90)
    monkeypatch.setattr(linkage, "HOT_SHARE", 400)
    every, keys = linkage.edges(books[0], ["date"]), [*on, "trade_order_id"]
    least = max(90, every.count() // 400)
    want = rows(every.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > least).select(*keys))
    assert 0 < len(want) < 400
    for classes in (1, 16, 1 << 14):
        monkeypatch.setattr(linkage, "CLASSES", classes)
        assert rows(linkage.hot_keys(every, keys)) == want
    monkeypatch.setattr(linkage, "LEAST_HOT", 1_000_000)
    assert linkage.hot_keys(every, keys).count() == 0 and linkage.hot_keys(every.limit(0), keys).count() == 0


# Percentiles


def numpy_percentiles(values, shares):
    """Linear interpolation, NaN above all numbers."""
    v = sorted(values, key=lambda x: (math.isnan(x), x))
    out = []
    for s in shares:
        p = s * (len(v) - 1)
        low, high = v[math.floor(p)], v[math.ceil(p)]
        out.append(low if p == math.floor(p) or low == high else low + (p - math.floor(p)) * (high - low))
    return out


SHARES = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}


def test_percentiles_of_any_shape(spark):
    r = np.random.default_rng(3)
    groups = {
        "lognormal and an outlier": [*np.exp(r.standard_normal(5_000)).tolist(), 1e12],
        "infinite": [*r.standard_normal(3_000).tolist(), math.inf, -math.inf],
        "not numbers": [*r.standard_normal(2_000).tolist(), *[math.nan] * 900],
        "only nan": [math.nan] * 3,
        "one value": [2.5] * 4_000,
        "mostly one": [*[0.0] * 3_000, *r.random(1_000).tolist()],
        "two": [1.0, 2.0],
        "single": [5.0],
        "tiny and huge": [*(r.random(2_000) * 1e-300).tolist(), *(r.random(2_000) * 1e300).tolist()],
    }
    data = [(g, float(v), "clash", "clash") for g, vs in groups.items() for v in vs] + [(None, 1.0, "clash", "clash"), (None, 3.0, "clash", "clash"), ("two", None, "clash", "clash"), ("nothing", None, "clash", "clash")]
    table = spark.createDataFrame(data, "g string, v double, key string, value string").repartition(7)
    got = {r.key.g: [r[n] for n in SHARES] for r in probes.exact_percentiles(table, ["g"], "v", SHARES).collect()}
    assert set(got) == {*groups, None} and got[None] == pytest.approx(numpy_percentiles([1.0, 3.0], SHARES.values()))
    for g, vs in groups.items():
        assert got[g] == pytest.approx(numpy_percentiles(vs, SHARES.values()), nan_ok=True, rel=1e-12, abs=0), g
    assert probes.exact_percentiles(table.limit(0), ["g"], "v", SHARES).count() == 0


def test_no_bracket_is_large(spark):
    """Between a share's low and high are six SPLITS-ths of the rows at most, whatever the outliers."""
    n = 200_000
    table = spark.range(n).select(F.lit("g").alias("g"), F.exp(F.randn(5) * 3).alias("v")).unionByName(spark.createDataFrame([("g", 1e15), ("g", math.inf), ("g", math.nan)], "g string, v double"))
    held = probes.held_values(table, ["g"], "v", {"p50": 0.5, "p99": 0.99}).where("value IS NOT NULL").groupBy("share.name").agg(F.sum("n").alias("n")).collect()
    assert len(held) == 2 and all(r.n <= 6 / probes.SPLITS * n + 2 for r in held)


# Lag


@pytest.mark.parametrize("scale", [1, 1_000_003, 2**50])
@pytest.mark.parametrize("fan", [2, 4096])
def test_lag_level_by_level(spark, monkeypatch, scale, fan):
    monkeypatch.setattr(profile, "FAN", fan if scale == 1 else 4096)
    r = random.Random(scale)
    data = [(r.choice(["a", "b", None]), None if c == 0 else (c - 9) * scale, i, r.choice([None, i])) for i, c in enumerate(r.choices(range(20), k=400))]
    df = spark.createDataFrame(data, "g string, chunk bigint, i bigint, v bigint")
    got = {x.i: x.prev_v for x in profile.chunked_lag(df, ["g"], "chunk", ["i"], ["v"]).collect()}
    want = {}
    for g in {d[0] for d in data}:
        own = sorted((d for d in data if d[0] == g), key=lambda d: (d[1] is not None, d[1] or 0, d[2]))
        want |= {b[2]: a[3] for a, b in itertools.pairwise(own)} | {own[0][2]: None}
    assert got == want


def test_no_window_holds_all_chunks(spark):
    """A table with as many chunks as rows: windows look through gatherings of them."""
    df = spark.range(100_000).select(F.lit("g").alias("g"), (F.col("id") * 7919).alias("chunk"), F.col("id").alias("i"))
    out = profile.chunked_lag(df, ["g"], "chunk", ["i"], ["i"])
    assert out.where("prev_i = i - 1").count() == 99_999 and out.where("prev_i IS NULL").count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "chunk__up__up" in plan and not re.search(r"Window \[lag\(at_end__\S* [^\n]*windowspecdefinition\(g\S*, chunk#", plan)
    assert profile.chunked_lag(df.limit(0), ["g"], "chunk", ["i"], ["i"]).count() == 0
    named = df.limit(50).withColumn("chunk", F.lpad(F.floor(F.col("i") / 7).cast("string"), 3, "0"))
    assert profile.chunked_lag(named, ["g"], "chunk", ["i"], ["i"]).where("prev_i = i - 1").count() == 49  # chunks that are no integers


# Trajectories


def digest(codes, long):
    blocks = ["".join(hashlib.sha256(",".join(map(str, b)).encode()).hexdigest()) for b in itertools.batched(codes, long)]
    return f"{len(codes)}:{hashlib.sha256(''.join(blocks).encode()).hexdigest()}"


def test_patterns_of_long_orders(spark):
    r = random.Random(2)
    events = {("d", 1): [1, 2, 3], ("d", 2): r.choices([1, 2, 3], k=5), ("d", 3): r.choices([1, 2], k=6), ("d", 4): r.choices([1, 2, 3], k=57), (None, 5): r.choices([1, 2, 3], k=23)}
    events[("e", 6)] = events[("d", 4)]
    data = [(day, order, i * 3, code) for (day, order), codes in events.items() for i, code in enumerate(codes)] + [("d", 0, 1, 1), ("d", None, 1, 1), ("d", 9, 1, None)]
    df = spark.createDataFrame(data, "date string, OrderId bigint, row bigint, OrderType int").repartition(6)
    want = {(*k, len(set(codes)), ",".join(map(str, codes)) if len(codes) <= 5 else digest(codes, 5)) for k, codes in events.items()}
    assert {tuple(x) for x in probes.trajectories(df, ["date"], ["row"], long=5).collect()} == want
    assert {tuple(x) for x in probes.trajectories(df, ["date"], ["row"], F.floor(F.col("row") / 40), long=5).collect()} == want
    assert {tuple(x) for x in probes.trajectories(df.withColumn("row", F.lpad(F.col("row").cast("string"), 4, "0")), ["date"], ["row"], long=5).collect()} == want
    assert probes.trajectories(df.limit(0), ["date"], ["row"]).count() == 0


def test_an_order_of_a_million_events(spark):
    df = spark.range(1_000_000, numPartitions=8).select(F.lit("d").alias("date"), F.lit(1).cast("bigint").alias("OrderId"), F.col("id").alias("row"), (F.col("id") % 3).cast("int").alias("OrderType"))
    found = probes.trajectories(df, ["date"], ["row"]).collect()
    assert [(r.n_types, r.pattern) for r in found] == [(3, digest([i % 3 for i in range(1_000_000)], probes.LONG))]
