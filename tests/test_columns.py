import datetime as dt

from pyspark.sql import functions as F

from tapelens.functions import columns as C


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_null_tokens(spark):
    assert apply(spark, C.null_tokens, [" a ", "\tNULL\n", "", " ", "nan", "NaN", "null", "Null", None]) == ["a", None, None, None, None, None, None, "Null", None]


def test_zero_pad_does_not_cut(spark):
    assert apply(spark, lambda c: C.zero_pad(c, 5), ["7", "12345", "1234567", None]) == ["00007", "12345", "1234567", None]


def test_times(spark):
    assert apply(spark, C.stage_time, ["92048", "0", "999999", "1234567", "12:30:00", "", None]) == ["092048", "000000", "999999", None, None, None, None]
    assert apply(spark, C.day_seconds, ["092048", "9:20:48", "240000", "126000", "235959", "", None]) == [33648, 33648, None, None, 86399, None, None]
    assert apply(spark, C.session_bucket, ["085959", "090000", "093000", "120000", "130000", "160001", None]) == ["unknown", "0900_0929", "0930_1159", "1200_1259", "1300_1559", "1600_plus", "unknown"]


def test_epoch_nanoseconds_keep_microseconds(spark):
    got = apply(spark, lambda c: C.ns_timestamp(C.epoch_ns(c)), ["1739842248123456789", "-1", "x", None])
    assert got[0] == dt.datetime(2025, 2, 18, 1, 30, 48, 123456) and got[1] == dt.datetime(1969, 12, 31, 23, 59, 59, 999999) and got[2:] == [None, None]


def test_paths_and_codes(spark):
    assert apply(spark, C.instrument_key, ["a/00001.csv", "00002.csv", "a/b", "x.csv.gz"]) == ["00001", "00002", "a/b", "x.csv.gz"]
    assert apply(spark, C.path_date, ["r/20250218.zip", "r/2025-02-18/x", "r/120250218.zip", "r/20251340.zip", "none"]) == [dt.date(2025, 2, 18), dt.date(2025, 2, 18), None, None, None]
    assert apply(spark, C.bare_code, ["00700.HK", "HK.5", "123456"]) == ["00700", "00005", "123456"]
    assert apply(spark, C.listing_date, ["1970-01-01", "2001-02-03", "bad", None]) == [None, dt.date(2001, 2, 3), None, None]


def test_flags(spark):
    assert apply(spark, C.text_bool, [" Yes", "0", "F", "maybe", None]) == [True, False, False, None, None]
    assert apply(spark, C.present_id, [0, 5, None], "bigint") == [False, True, False]
    assert apply(spark, C.order_side, ["110", "000", "", None]) == ["1", "0", "", None]
