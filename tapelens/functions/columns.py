"""Column functions of the tick model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelens.contracts import NULL_TOKENS


def stripped(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"^\s+", ""), r"\s+$", "")


def null_tokens(c: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Stripped text; null where it is a null token."""
    text = stripped(c)
    return F.when(text.isin(tokens), None).otherwise(text)


def zero_pad(c: Column, width: int) -> Column:
    """Zeros before shorter text; longer text stays whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def stage_time(c: Column) -> Column:
    """One to six digits as HHMMSS, not range-checked; else null."""
    text = null_tokens(c)
    return F.when(text.rlike("^[0-9]{1,6}$"), zero_pad(text, 6))


def day_seconds(c: Column) -> Column:
    """Seconds since midnight of HHMMSS text with any separators; null if out of range."""
    digits = F.regexp_replace(c.cast("string"), "[^0-9]", "")
    text = F.when(F.length(digits).between(1, 6), zero_pad(digits, 6))
    h, m, s = (F.substring(text, at, 2).try_cast("int") for at in (1, 3, 5))
    return F.when((h < 24) & (m < 60) & (s < 60), h * 3600 + m * 60 + s)


def session_bucket(c: Column) -> Column:
    """The part of the trading day that HHMMSS text is in."""
    hhmm = F.substring(c, 1, 4)
    return (
        F.when(c.isNull() | (hhmm < "0900"), "unknown")
        .when(hhmm < "0930", "0900_0929")
        .when(hhmm < "1200", "0930_1159")
        .when(hhmm < "1300", "1200_1259")
        .when(hhmm < "1600", "1300_1559")
        .otherwise("1600_plus")
    )


def epoch_ns(c: Column) -> Column:
    """Nanoseconds of text; null if it is no whole number."""
    return null_tokens(c).try_cast("bigint")


def ns_timestamp(ns: Column) -> Column:
    """A timestamp of nanoseconds, to the microsecond below."""
    return F.timestamp_micros(F.floor(ns.cast("decimal(20,0)") / 1000).cast("bigint"))


def present_id(c: Column) -> Column:
    """Not null and not 0."""
    return c.isNotNull() & (c != 0)


def instrument_key(source_file: Column) -> Column:
    """The file's name without .csv; other paths as they are."""
    return F.coalesce(F.regexp_substr(source_file, F.lit(r"[^/]+(?=\.csv$)")), source_file)


def order_side(ext: Column) -> Column:
    return F.substring(ext, 1, 1)


def text_bool(c: Column) -> Column:
    text = F.lower(stripped(c))
    return F.when(text.isin("1", "true", "t", "yes", "y"), True).when(text.isin("0", "false", "f", "no", "n"), False)


def listing_date(c: Column) -> Column:
    """A date; the sentinel 1970-01-01 is null."""
    return F.nullif(F.try_to_date(c.cast("string")), F.lit("1970-01-01").cast("date"))


def bare_code(c: Column) -> Column:
    """Without the exchange's prefix or suffix, five digits wide."""
    return zero_pad(F.regexp_replace(F.regexp_replace(c, r"\.HK$", ""), r"^HK\.", ""), 5)


def path_date(path: Column) -> Column:
    """The first YYYYMMDD or YYYY-MM-DD in a path that no digit touches; null if it is no date."""
    flat = F.regexp_substr(path, F.lit(r"(?<!\d)\d{8}(?!\d)"))
    dashed = F.regexp_substr(path, F.lit(r"(?<!\d)\d{4}-\d{2}-\d{2}(?!\d)"))
    return F.coalesce(F.try_to_date(flat, "yyyyMMdd"), F.try_to_date(dashed, "yyyy-MM-dd"))


def rate(part: Column, whole: Column) -> Column:
    """part / whole; null where whole is 0."""
    return F.when(whole > 0, part / whole)


def turnover(price: str = "Price", volume: str = "Volume") -> Column:
    return F.col(price) * F.col(volume)


def presence(bid: str = "BidOrderID", ask: str = "AskOrderID") -> dict[str, Column]:
    """Which order ids a trade names."""
    b, a = present_id(F.col(bid)), present_id(F.col(ask))
    return {"bid_present": b, "ask_present": a, "both_present": b & a, "bid_only": b & ~a, "ask_only": a & ~b, "neither_side": ~b & ~a}
