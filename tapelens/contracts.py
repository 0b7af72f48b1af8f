"""Schemas, rules, policies and codes of the tick model. Data only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Tokens that mean null in text columns.
NULL_TOKENS = ["", "NULL", "null", "nan", "NaN"]
#: Tokens that mean null in CSV seeds.
SEED_NULL_TOKENS = ["", "NA", "N/A", "NULL", "null"]


@dataclass(frozen=True)
class Contract:
    """A stage table: business columns, those a row must have, and the raw groups that feed it by year."""

    name: str
    columns: tuple[tuple[str, str], ...]
    required: tuple[str, ...]
    groups: dict[str, tuple[str, ...]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in (*self.columns, *TECHNICAL)))


#: Technical columns of both tables.
TECHNICAL = (("date", "date"), ("table_name", "string"), ("source_file", "string"), ("ingest_ts", "timestamp"), ("row_num_in_file", "bigint"))

#: Stage contracts.
TRADES = Contract(
    "trades",
    (
        ("SendTimeRaw", "string"), ("SendTime", "timestamp"), ("SendTimeNs", "bigint"), ("SeqNum", "bigint"), ("TickID", "bigint"), ("Time", "string"), ("Price", "double"), ("Volume", "bigint"),
        ("Dir", "tinyint"), ("Type", "string"), ("BrokerNo", "string"), ("BidOrderID", "bigint"), ("BidVolume", "bigint"), ("AskOrderID", "bigint"), ("AskVolume", "bigint"),
    ),
    ("TickID", "Time", "Price", "Volume"),
    {"2025": ("TradeResumes",), "2026": ("trade",)},
)
ORDERS = Contract(
    "orders",
    (
        ("Channel", "int"), ("SendTimeRaw", "string"), ("SendTime", "timestamp"), ("SendTimeNs", "bigint"), ("SeqNum", "bigint"), ("OrderId", "bigint"), ("OrderType", "smallint"), ("Ext", "string"),
        ("Time", "string"), ("Price", "double"), ("Volume", "bigint"), ("Level", "int"), ("BrokerNo", "string"), ("VolumePre", "bigint"),
    ),
    ("SeqNum", "OrderId", "Time", "Price", "Volume"),
    {"2025": ("OrderAdd", "OrderModifyDelete"), "2026": ("order",)},
)
CONTRACTS = {c.name: c for c in (TRADES, ORDERS)}

#: Audit tables: what staging and publishing record for each partition they write.
MEMBER_FAILURES = "array<struct<source_file:string,error:string>>"
STAGE_MANIFEST = (
    "year int, date date, table_name string, batch bigint, replaces boolean, status string, error string, raw_row_count bigint, row_count bigint, rejected_row_count bigint, "
    f"source_member_count bigint, failed_member_count bigint, failed_member_examples {MEMBER_FAILURES}, required_null_counts map<string,bigint>, rejection_reason_counts map<string,bigint>, "
    "send_time_parse_failure_count bigint, min_send_time timestamp, max_send_time timestamp, min_time string, max_time string, output_files bigint, output_bytes bigint, version string, generated_at timestamp"
)
STAGE_RUNS = "run bigint, table_name string, selected_dates array<date>, version string, status string, updated_at timestamp"
VERIFIED_MANIFEST = (
    "year int, date date, table_name string, verified_table_name string, batch bigint, input_row_count bigint, output_row_count bigint, output_files bigint, output_bytes bigint, "
    "included_columns array<string>, included_caveat_columns array<string>, excluded_columns array<string>, verified_policy_version string, source_layer string, admission_rule string, "
    "contains_caveat_fields boolean, reference_join_applied boolean, research_time_grade string, generated_at timestamp"
)
#: Labels of published layers.
SOURCE_LAYER, POLICY_VERSION = "candidate_cleaned", "2026-03-15"
FINE_YEARS = (2026,)


@dataclass(frozen=True)
class Rule:
    """A value rule: where it can be tested, and which tested rows violate it, as SQL; years where it applies."""

    name: str
    tested: str
    violating: str
    years: tuple[int, ...] | None = None


#: Value rules of the two tables.
TRADE_RULES = (
    Rule("price_gt_0", "Price IS NOT NULL", "Price <= 0"),
    Rule("volume_gt_0", "Volume IS NOT NULL", "Volume <= 0"),
    Rule("tickid_not_null", "true", "TickID IS NULL"),
    Rule("time_not_null", "true", "Time IS NULL"),
    Rule("seqnum_not_null", "true", "SeqNum IS NULL", (2026,)),
    Rule("sendtime_not_null", "true", "SendTime IS NULL", (2026,)),
)
ORDER_RULES = (
    Rule("price_gt_0", "Price IS NOT NULL", "Price <= 0"),
    Rule("volume_ge_0", "Volume IS NOT NULL", "Volume < 0"),
    Rule("seqnum_not_null", "true", "SeqNum IS NULL"),
    Rule("orderid_not_null", "true", "OrderId IS NULL"),
    Rule("time_not_null", "true", "Time IS NULL"),
    Rule("sendtime_not_null", "true", "SendTime IS NULL", (2026,)),
    Rule("level_ge_0", "Level IS NOT NULL", "Level < 0"),
    Rule("volumepre_ge_0", "VolumePre IS NOT NULL", "VolumePre < 0"),
)

#: How bad a status is.
SEVERITY = {"fail": 6, "unknown": 5, "not_run": 4, "weak_pass": 3, "pass": 2, "not_applicable": 1}

#: Research modules that hang on each probe area.
AREA_MODULES = [
    ("order_lifecycle", "recommended", "order_lifecycle_shape_by_event_count"),
    ("order_lifecycle", "blocked", "execution_realism_or_fill_simulation"),
    ("order_lifecycle", "blocked", "strict_ordering_sensitive_causality"),
    ("trade_dir", "recommended", "trade_dir_weak_consistency_check"),
    ("trade_dir", "blocked", "signed_flow"),
    ("trade_dir", "blocked", "aggressor_side_inference"),
    ("order_type", "recommended", "ordertype_weak_consistency_check"),
    ("order_type", "recommended", "order_lifecycle_shape_by_event_count"),
    ("order_type", "blocked", "event_semantics_inference"),
    ("session", "recommended", "matched_edge_session_profile"),
    ("session", "blocked", "cross_session_unaware_research"),
]

#: Fixed values: (family, lowest code, highest code) of the exchange's stock code allocation plan.
CODE_RANGES = [
    ("exchange_traded_fund", 2800, 2849),
    ("exchange_traded_fund", 3000, 3199),
    ("exchange_traded_fund", 3400, 3499),
    ("leveraged_and_inverse_product", 7200, 7399),
    ("leveraged_and_inverse_product", 7500, 7599),
    ("leveraged_and_inverse_product", 7700, 7799),
    ("leveraged_and_inverse_product", 87200, 87399),
    ("leveraged_and_inverse_product", 87500, 87599),
    ("leveraged_and_inverse_product", 87700, 87799),
    ("temporary_counter", 2900, 2999),
    ("exchange_fund_note", 4000, 4199),
    ("government_bond", 4200, 4299),
    ("debt_security_professional_only", 4300, 4329),
    ("debt_security_professional_only", 4400, 4599),
    ("debt_security_professional_only", 5000, 6029),
    ("debt_security_public", 4700, 4799),
    ("spac_warrant", 4800, 4999),
    ("hdr", 6200, 6299),
    ("restricted_security_or_hdr", 6300, 6399),
    ("reit_or_unit_trust_non_etf", 87000, 87099),
    ("prc_mof_bond", 89000, 89099),
    ("derivative_warrant", 89200, 89599),
    ("derivative_warrant", 10000, 29999),
    ("inline_warrant", 47000, 48999),
    ("cbbc", 49500, 69999),
    ("stock_connect_security", 90000, 99999),
]
#: What a code range's note says, by family; one family has a range with a note of its own.
RANGE_NOTES = {
    "exchange_traded_fund": "HKEX Stock Code Allocation Plan ETF range: 02800-02849 / 03000-03199 / 03400-03499.",
    "leveraged_and_inverse_product": "HKEX Stock Code Allocation Plan leveraged/inverse product range.",
    "temporary_counter": "HKEX Stock Code Allocation Plan temporary counter range.",
    "exchange_fund_note": "HKEX Stock Code Allocation Plan Exchange Fund Note range.",
    "government_bond": "HKEX Stock Code Allocation Plan HKSAR Government Bond range.",
    "debt_security_professional_only": "HKEX Stock Code Allocation Plan debt securities for professional investors only range.",
    "debt_security_public": "HKEX Stock Code Allocation Plan debt securities for the public range.",
    "spac_warrant": "HKEX Stock Code Allocation Plan SPAC warrant range.",
    "hdr": "HKEX Stock Code Allocation Plan Hong Kong Depositary Receipt range.",
    "restricted_security_or_hdr": "HKEX Stock Code Allocation Plan restricted security / HDR range.",
    "reit_or_unit_trust_non_etf": "HKEX REIT stock code allocation range: 87000-87099.",
    "prc_mof_bond": "HKEX Stock Code Allocation Plan PRC Ministry of Finance bond range.",
    "derivative_warrant": "HKEX structured products stock code allocation range for derivative warrants: 10000-29999.",
    "inline_warrant": "HKEX structured products stock code allocation range for inline warrants: 47000-48999.",
    "cbbc": "HKEX structured products stock code allocation range for CBBCs: 49500-69999.",
    "stock_connect_security": "HKEX Stock Code Allocation Plan Stock Connect range: 90000-99999.",
}
RANGE_NOTES_BY_START = {89200: "HKEX Stock Code Allocation Plan RMB derivative warrant range: 89200-89599."}
#: What a profile says of where a family and a candidate status come from.
RANGE_SOURCE, NO_SOURCE = "hkex_stock_code_allocation_plan", "raw_universe_only_unclassified"
UNCLASSIFIED_NOTE = "Current upstream can prove this instrument exists in the raw universe, but cannot yet safely separate it as ordinary equity vs fund/REIT/other listed security."
CANDIDATE = ("candidate_from_low_code_listed_security_unclassified", "Conservative stock research candidate lane: low-code listed security not yet classified as ETF/REIT/structured product/debt by current upstream references. This is not pure common-equity proof.")
NO_CANDIDATE = ("not_in_stock_research_candidate_lane", "Either already classified as non-stock/special product, or not in the current low-code candidate lane.")
PROFILE_SOURCE_LAYER, PROFILE_LAYER, SEED_LABEL = "raw_zip_member_universe", "instrument_profile_sidecar", "instrument_profile_seed"

#: Security types of reference snapshots and the family each names.
TYPE_FAMILIES = {"ETF": "exchange_traded_fund", "WARRANT": "derivative_warrant", "CBBC": "cbbc", "BOND": "debt_security_public"}

#: Status of each information-theoretic method by time grade, and the fields' lanes.
METHOD_RULES = [
    ("coarse_only", "entropy", "allowed_with_caveat"),
    ("coarse_only", "mutual_information", "allowed_with_caveat"),
    ("coarse_only", "transfer_entropy", "blocked"),
    ("fine_ok", "entropy", "allowed"),
    ("fine_ok", "mutual_information", "allowed"),
    ("fine_ok", "transfer_entropy", "allowed_with_caveat"),
]
FIELD_LANES = [
    *[(f, "default") for f in ("Price", "Volume", "instrument_key", "Time", "SendTime", "OrderId", "TickID", "SeqNum")],
    *[(f, "caveat") for f in ("Dir", "OrderType", "OrderSideVendor", "Type")],
    *[(f, "blocked") for f in ("BrokerNo", "Level", "VolumePre", "BidOrderID", "AskOrderID", "Ext")],
]
