"""Yearly reports, admissibility gates and manifest reconciliation."""

from __future__ import annotations

import re

from functools import reduce

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelens.contracts import AREA_MODULES, FIELD_LANES, METHOD_RULES, SEVERITY


def severity(status: Column) -> Column:
    return reduce(lambda out, kv: out.when(status == kv[0], kv[1]), list(SEVERITY.items())[1:], F.when(status == "fail", SEVERITY["fail"])).otherwise(0)


def impact(area: Column, status: Column, blocking: Column) -> Column:
    """What a probe's result means for research."""
    failed = status == "fail"
    return (
        F.when(failed, "block")
        .when(area == "session", "requires_session_split")
        .when(area == "trade_dir", "requires_manual_review")
        .when(area == "order_type", "allow_with_caveat")
        .when(status == "pass", "allow")
        .when(status.isin("weak_pass", "not_applicable"), "allow_with_caveat")
        .when(status.isin("unknown", "not_run") & (blocking != "blocking"), "allow_with_caveat")
        .otherwise("requires_manual_review")
    )


def yearly_summary(daily: DataFrame, by: list[str], averages: list[str]) -> DataFrame:
    """Per area and year: the worst status, days of each kind, sums, and averages that skip nulls. daily: status, blocking_level, tested_rows."""
    days = {s: F.count_if(F.col("status") == s).alias(f"days_{s}") for s in SEVERITY}
    return daily.groupBy(*by).agg(
        F.max_by("status", severity(F.col("status"))).alias("status"),
        F.max("blocking_level").alias("blocking_level"),
        F.count("*").alias("days_run"),
        *days.values(),
        F.sum("tested_rows").alias("tested_rows_total"),
        *[F.avg(c).alias(f"{c}_avg") for c in averages],
    )


def area_modules(df: DataFrame) -> DataFrame:
    """(semantic_area, listed, research_module): a fixed small table."""
    return df.sparkSession.createDataFrame(AREA_MODULES, "semantic_area string, listed string, research_module string")


def bridge(summary: DataFrame, area: str = "semantic_area") -> DataFrame:
    """Areas by research modules with their final status.

    final_status lets a module listed as blocked through when its area is allowed; strict_status
    does not.
    """
    out = summary.withColumn("admissibility_impact", impact(F.col(area), F.col("status"), F.col("blocking_level")))
    out = out.join(F.broadcast(area_modules(summary)), area)
    effect = F.col("admissibility_impact")
    listed_out = F.col("listed") == "blocked"
    final = F.when(effect == "allow", "allow").when(listed_out, "block").otherwise(effect)
    return out.withColumns({"final_status": final, "strict_status": F.when(listed_out, "block").otherwise(effect)})


def direction_readiness(probe: DataFrame, contrast: DataFrame, by: list[str]) -> DataFrame:
    """One of three decisions for each year. probe: status, nonnull_rate_avg; contrast: status."""
    joined = probe.select(*by, F.col("status").alias("probe_status"), "nonnull_rate_avg").join(contrast.select(*by, F.col("status").alias("contrast_status")), by, "left")
    whole = F.col("nonnull_rate_avg") == 1.0
    decision = (
        F.when((F.col("probe_status") == "weak_pass") & whole & (F.col("contrast_status") == "candidate_directional_signal"), "candidate_signal_only")
        .when(F.col("probe_status").isin("weak_pass", "pass") & whole, "structure_only")
        .otherwise("not_ready")
    )
    return joined.withColumn("decision", decision)


def method_gate(usage: DataFrame) -> DataFrame:
    """Which uses of information-theoretic methods are allowed. usage: use_id, grade, method, fields (array).

    A blocked field blocks the use; a caveat field, or one without a lane, asks for a caveat.
    """
    spark = usage.sparkSession
    rules = spark.createDataFrame(METHOD_RULES, "grade string, method string, method_status string")
    lanes = spark.createDataFrame(FIELD_LANES, "field string, lane string")
    per = usage.select("use_id", F.explode("fields").alias("field")).join(F.broadcast(lanes), "field", "left")
    per = per.groupBy("use_id").agg(F.count_if(F.col("lane") == "blocked").alias("blocked_fields"), F.count_if((F.col("lane") == "caveat") | F.col("lane").isNull()).alias("caveat_fields"))
    out = usage.drop("fields").join(F.broadcast(rules), ["grade", "method"], "left").join(per, "use_id", "left")
    out = out.withColumns({"blocked_fields": F.coalesce("blocked_fields", F.lit(0)), "caveat_fields": F.coalesce("caveat_fields", F.lit(0))})
    status = F.when(F.col("method_status").isNull() | (F.col("method_status") == "blocked") | (F.col("blocked_fields") > 0), "blocked").when((F.col("method_status") == "allowed_with_caveat") | (F.col("caveat_fields") > 0), "allowed_with_caveat").otherwise("allowed")
    return out.withColumn("status", status)


def term_scan(docs: DataFrame, terms: list[tuple[str, str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How often each term of a policy occurs in each text: (id, term, kind, n), where it does. terms: a short fixed list of (term, kind), matched as words."""
    hits = [F.struct(F.lit(t).alias("term"), F.lit(k).alias("kind"), F.regexp_count(F.lower(text_col), F.lit(rf"(?<![\p{{L}}\p{{N}}_]){re.escape(t)}(?![\p{{L}}\p{{N}}_])")).cast("bigint").alias("n")) for t, k in terms]
    return docs.select(id_col, F.explode(F.filter(F.array(*hits), lambda h: h["n"] > 0)).alias("h")).select(id_col, "h.*")


@dataclass(frozen=True)
class TextPolicy:
    """What is looked for in a text; a few dozen names and phrases.

    fields: (table, field, statuses). buckets: (field, bucket). Phrases may have underscores for spaces.
    """

    fields: tuple[tuple[str, str, tuple[str, ...]], ...]
    buckets: tuple[tuple[str, str], ...]
    avoid: tuple[str, ...]
    avoid_labels: tuple[str, ...]
    prefer_labels: tuple[str, ...]


def policy_check(texts: DataFrame, policy: TextPolicy, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text: which fields it mentions how often, what it should not say, which caveats it has or lacks.

    A text is cut into names once, and the policy's are kept by a hash set; a field is met where it is a whole name, in
    its own case, in back quotes or not. Phrases are met anywhere in the text in lower case with single white space. A null text is
    empty. Fields are in order of table and name, phrases in the policy's.
    """
    names = sorted({f for _, f, _ in policy.fields} | {f for f, _ in policy.buckets})
    text = F.coalesce(F.col(text_col), F.lit(""))
    met = F.filter(F.regexp_extract_all(text, F.lit("[A-Za-z0-9_]+"), F.lit(0)), lambda w: w.isin(*names))
    rows = texts.select(F.col(id_col).alias("id"), met.alias("met"), F.lower(F.regexp_replace(text, r"(?U)\s+", " ")).alias("said"))
    says = lambda *phrases: reduce(lambda a, b: a | b, [F.contains("said", F.lit(p)) for p in phrases], F.lit(False))
    listed = lambda some: F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in some], F.lit(None).cast("string")))
    phrases = lambda some: listed([(p, says(p.replace("_", " "))) for p in some])
    ordered = sorted(policy.fields)
    times = lambda f: F.size(F.filter("met", lambda w: w == f)).cast("bigint")
    mentions = F.filter(F.array(*[F.struct(F.lit(t).alias("table"), F.lit(f).alias("field"), times(f).alias("count"), F.array(*map(F.lit, s)).cast("array<string>").alias("statuses")) for t, f, s in ordered]), lambda m: m["count"] > 0)
    of_status = lambda status: listed([(f, F.array_contains("met", f)) for _, f, s in ordered if status in s])
    of_bucket = lambda bucket: listed([(f, F.array_contains("met", f)) for f in sorted({f for f, b in policy.buckets if b == bucket})])
    out = rows.select(
        F.col("id").alias(id_col),
        mentions.alias("field_mentions"),
        phrases(policy.avoid).alias("avoid_phrase_hits"),
        phrases(policy.avoid_labels).alias("reference_avoid_label_hits"),
        of_status("unverified-semantic").alias("mentioned_unverified_fields"),
        of_status("vendor-defined").alias("mentioned_vendor_defined_fields"),
        of_bucket("keep_out_for_now").alias("mentioned_keep_out_fields"),
        of_bucket("admit_with_explicit_caveat_only").alias("mentioned_caveat_only_fields"),
        says("omd-c family").alias("has_provenance_phrase"),
        says("source_layer", "candidate_cleaned", "verified").alias("has_source_layer_phrase"),
        says(*[p.replace("_", " ") for p in policy.prefer_labels]).alias("has_reference_label"),
        says("vendor-defined", "vendor defined", "unverified", "not research-verified").alias("has_unverified_caveat"),
    )
    return out.withColumn("missing_keep_out_caveat", (F.size("mentioned_keep_out_fields") > 0) & ~F.col("has_unverified_caveat"))


def manifest_state(tasks: DataFrame, manifest: DataFrame, outputs: DataFrame, key: list[str]) -> DataFrame:
    """Tasks, manifest rows and outputs against each other: done, duplicate, stale, orphan or todo. outputs: key, row_count."""
    m = manifest.groupBy(*key).agg(F.count("*").alias("manifest_rows"), F.max("row_count").alias("manifest_row_count"))
    out = tasks.select(*key).distinct().withColumn("is_task", F.lit(True)).join(m, key, "full_outer").join(outputs.select(*key, F.col("row_count").alias("output_row_count")), key, "full_outer")
    state = (
        F.when(F.col("manifest_rows") > 1, "duplicate")
        .when(F.col("manifest_rows").isNull() & F.col("output_row_count").isNotNull(), "orphan")
        .when(F.col("manifest_rows").isNotNull() & (F.col("output_row_count").isNull() | (F.col("output_row_count") != F.col("manifest_row_count"))), "stale")
        .when(F.col("manifest_rows").isNull(), "todo")
        .otherwise("done")
    )
    return out.withColumn("state", state).withColumn("is_task", F.coalesce("is_task", F.lit(False)))
