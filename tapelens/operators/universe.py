"""The instrument universe: observed spans, seeds, classification."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelens.contracts import CANDIDATE, CODE_RANGES, NO_CANDIDATE, NO_SOURCE, PROFILE_LAYER, PROFILE_SOURCE_LAYER, RANGE_NOTES, RANGE_NOTES_BY_START, RANGE_SOURCE, SEED_LABEL, SEED_NULL_TOKENS, TYPE_FAMILIES, UNCLASSIFIED_NOTE
from tapelens.functions.columns import bare_code, listing_date, null_tokens, text_bool

UNCLASSIFIED = "listed_security_unclassified"


def observed_span(df: DataFrame, prefix: str) -> DataFrame:
    return df.groupBy("instrument_key").agg(F.min("date").alias(f"{prefix}_first_seen_date"), F.max("date").alias(f"{prefix}_last_seen_date"), F.count_distinct("date").alias(f"observed_{prefix}_days"))


def universe(*tables: DataFrame) -> DataFrame:
    """Distinct instrument keys of all tables."""
    out = tables[0].select("instrument_key")
    for t in tables[1:]:
        out = out.union(t.select("instrument_key"))
    return out.distinct()


#: Columns of a seed beside its key, and their types.
SEED_COLUMNS = {
    "listing_date": "date", "float_mktcap_hkd": "double", "southbound_eligible": "boolean", "instrument_family": "string", "instrument_family_source": "string",
    "instrument_family_note": "string", "as_of_date": "date", "source_label": "string",
}


def normalise_seed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Seed rows of text with typed columns; of a key's rows the last in order stays. Columns that rows lack are nulls, or a seed's own label."""
    t = lambda c: null_tokens(F.col(c), SEED_NULL_TOKENS)
    typed = {
        "listing_date": lambda c: listing_date(t(c)),
        "float_mktcap_hkd": lambda c: t(c).try_cast("double"),
        "southbound_eligible": lambda c: text_bool(t(c)),
        "as_of_date": lambda c: F.try_to_date(t(c)),
    }
    absent = lambda c, kind: F.lit(SEED_LABEL if c == "source_label" else None).cast(kind)
    columns = [(typed.get(c, t)(c) if c in rows.columns else absent(c, kind)).alias(c) for c, kind in SEED_COLUMNS.items()]
    place = F.row_number().over(Window.partitionBy("instrument_key").orderBy(*[F.desc(f"order.{c}") for c in order]))
    out = rows.select(bare_code(t("instrument_key")).alias("instrument_key"), *columns, F.struct(*order).alias("order"))
    return out.withColumn("place", place).where("place = 1").drop("place", "order")


def merge_seeds(sources: list[DataFrame], columns: list[str], provenance: bool = False) -> DataFrame:
    """One row a key: of each column the first value that is not null, in the order of the sources, then the least.

    A source may lack columns, which then are null there; a column that all lack is text. With provenance each column has
    another, <column>_from: the number of its source from 0, and the source_label and as_of_date of the row it came from,
    which a date or label of another row does not replace. Null keys are one key.
    """
    types = {c: kind for s in reversed(sources) for c, kind in s.dtypes}
    have = lambda s, c: (F.col(c) if c in s.columns else F.lit(None)).cast(types.get(c, "string")).alias(c)
    labels = ["source_label", "as_of_date"]
    parts = [s.select("instrument_key", *[have(s, c) for c in columns], F.struct(F.lit(i).alias("source"), *[have(s, c) for c in labels]).alias("row__")) for i, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, parts)

    def best(c: str) -> list[Column]:
        first = F.min(F.when(F.col(c).isNotNull(), F.struct("row__.source", F.col(c).alias("value"), "row__")))
        return [first["value"].alias(c), *[first["row__"].alias(f"{c}_from")] * provenance]

    return rows.groupBy("instrument_key").agg(*[x for c in columns for x in best(c)])


def collapse_snapshot(rows: DataFrame, order: list[str]) -> DataFrame:
    """A reference snapshot reduced to a row for each code: first values in order, family from the security type."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)
    out = rows.withColumn("instrument_key", bare_code(F.col("code"))).withColumn("listing_date", listing_date(F.col("listing_date")))
    out = out.groupBy("instrument_key").agg(first("stock_type"), first("listing_date"))
    family = F.lit(None).cast("string")
    for kind, name in TYPE_FAMILIES.items():
        family = F.when(F.col("stock_type") == kind, name).otherwise(family)
    return out.withColumn("instrument_family", family)


def code_ranges(df: DataFrame) -> DataFrame:
    """(family, lo, hi): a fixed small table."""
    return df.sparkSession.createDataFrame(CODE_RANGES, "range_family string, lo int, hi int")


def _by_range(code: str, value: Callable[[str, int], str]) -> Column:
    n, out = F.col(code).try_cast("int"), F.lit(None).cast("string")
    grouped: dict[str, Column] = {}
    for family, lo, hi in CODE_RANGES:
        inside = n.between(lo, hi)
        grouped[value(family, lo)] = grouped[value(family, lo)] | inside if value(family, lo) in grouped else inside
    for text, inside in grouped.items():  # the ranges do not overlap
        out = F.when(inside, text).otherwise(out)
    return out


def range_family(code: str = "instrument_key") -> Column:
    """The family whose code range holds a key; null if none does."""
    return _by_range(code, lambda family, _: family)


def range_note(code: str = "instrument_key") -> Column:
    """What is to be said of the code range that holds a key; null if none does."""
    return _by_range(code, lambda family, lo: RANGE_NOTES_BY_START.get(lo, RANGE_NOTES[family]))


def instrument_profile(keys: DataFrame, orders: DataFrame, trades: DataFrame, seed: DataFrame) -> DataFrame:
    """A row for each instrument: when it was seen, what it is, and how that is known, with sources and notes.

    seed: a row a key; columns of SEED_COLUMNS that it lacks are null. Whether a reference was joined at all is asked of it first.
    """
    full = seed.select("instrument_key", *[(F.col(c) if c in seed.columns else F.lit(None)).cast(kind).alias(c) for c, kind in SEED_COLUMNS.items()])
    joined = seed.limit(1).count() > 0
    rows = keys.join(observed_span(orders, "orders"), "instrument_key", "left").join(observed_span(trades, "trades"), "instrument_key", "left").join(full, "instrument_key", "left")
    own, by_range = F.col("instrument_family"), range_family()
    seeded = F.col("listing_date").isNotNull() | F.col("float_mktcap_hkd").isNotNull() | F.col("southbound_eligible").isNotNull() | own.isNotNull()
    family = F.coalesce(own, by_range, F.lit(UNCLASSIFIED))
    candidate = F.coalesce((family == UNCLASSIFIED) & (F.col("instrument_key").try_cast("int") < 10000), F.lit(False))
    return rows.select(
        "instrument_key",
        F.least("orders_first_seen_date", "trades_first_seen_date").alias("observed_first_date"),
        F.greatest("orders_last_seen_date", "trades_last_seen_date").alias("observed_last_date"),
        F.coalesce("observed_orders_days", F.lit(0)).alias("observed_orders_days"),
        F.coalesce("observed_trades_days", F.lit(0)).alias("observed_trades_days"),
        "listing_date",
        "float_mktcap_hkd",
        "southbound_eligible",
        family.alias("instrument_family"),
        F.when(own.isNotNull(), "seed_classified").when(by_range.isNotNull(), "official_range_classified").otherwise(UNCLASSIFIED).alias("instrument_family_status"),
        F.coalesce("instrument_family_source", F.when(by_range.isNotNull(), RANGE_SOURCE), F.lit(NO_SOURCE)).alias("instrument_family_source"),
        F.when(own.isNotNull(), F.col("instrument_family_note")).when(by_range.isNotNull(), range_note()).otherwise(UNCLASSIFIED_NOTE).alias("instrument_family_note"),
        candidate.alias("stock_research_candidate"),
        *[F.when(candidate, yes).otherwise(no).alias(f"stock_research_candidate_{c}") for c, yes, no in zip(("status", "note"), CANDIDATE, NO_CANDIDATE, strict=True)],
        "as_of_date",
        "source_label",
        F.when(seeded, "seed_enriched").when(by_range.isNotNull(), "official_range_classified").otherwise("universe_only").alias("profile_status"),
        F.lit(PROFILE_SOURCE_LAYER).alias("source_layer"),
        F.lit(joined).alias("reference_join_applied"),
        F.lit(PROFILE_LAYER).alias("profile_layer"),
    )


def profile_summary(profile: DataFrame) -> DataFrame:
    return profile.groupBy("instrument_family", "profile_status").agg(F.count("*").alias("instruments"), F.count("listing_date").alias("with_listing_date"), F.count("float_mktcap_hkd").alias("with_market_cap"), F.count_if("stock_research_candidate").alias("candidates"))
