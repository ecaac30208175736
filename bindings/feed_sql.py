"""The booking feed and warehouse star schema, stated once for both engines.

Each feed column is an SQL expression over ``orders ⋈ customer`` written in
the subset shared by Spark SQL and DuckDB (CASE, ||, CAST … AS STRING, %,
substr, lpad). Only the date helpers differ per engine (``HELPERS_*``). Spark
evaluates these with ``selectExpr``, DuckDB inside the oracle SQL, so both
sides read identical inputs and the comparison tests the operators only.
"""

from __future__ import annotations


def _sqlval(v):
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("'", "''") + "'"


def pick(idx: str, values: list) -> str:
    """CASE over ``idx % len(values)`` choosing one literal."""
    arms = " ".join(f"WHEN {i} THEN {_sqlval(v)}" for i, v in enumerate(values))
    return f"(CASE ({idx}) % {len(values)} {arms} END)"


# Helper columns (k, c, st, pr, pd, tp, seg, nat, cname + date texts).
HELPERS_SPARK = """
o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
substr(o_orderpriority, 1, 1) AS pd, o_totalprice AS tp, c_mktsegment AS seg,
c_nationkey AS nat, c_name AS cname,
date_format(trunc(o_orderdate, 'MM'), 'yyMMdd') AS date_in_txt,
date_format(date_add(trunc(o_orderdate, 'MM'), CAST(1 + o_orderkey % 3 AS INT)), 'yyMMdd') AS date_out_txt,
date_format(o_orderdate, 'yyMMdd') AS created_txt,
date_format(timestampadd(HOUR, CAST(o_orderkey % 3 AS INT), CAST(trunc(o_orderdate, 'MM') AS TIMESTAMP_NTZ)), 'yyMMdd HH:mm:ss') AS lastmod_txt,
date_format(timestampadd(MINUTE, CAST(o_orderkey % 1440 AS INT), o_orderdate), 'yyMMdd HH:mm:ss') AS event_txt,
date_format(timestampadd(HOUR, 30, o_orderdate), 'yyMMdd HH:mm:ss') AS later_txt
"""

HELPERS_DUCKDB = """
o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
substr(o_orderpriority, 1, 1) AS pd, o_totalprice AS tp, c_mktsegment AS seg,
c_nationkey AS nat, c_name AS cname,
strftime(date_trunc('month', o_orderdate), '%y%m%d') AS date_in_txt,
strftime(date_trunc('month', o_orderdate) + to_days(CAST(1 + o_orderkey % 3 AS INTEGER)), '%y%m%d') AS date_out_txt,
strftime(o_orderdate, '%y%m%d') AS created_txt,
strftime(date_trunc('month', o_orderdate) + to_hours(CAST(o_orderkey % 3 AS INTEGER)), '%y%m%d %H:%M:%S') AS lastmod_txt,
strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)), '%y%m%d %H:%M:%S') AS event_txt,
strftime(o_orderdate + to_hours(30), '%y%m%d %H:%M:%S') AS later_txt
"""

_AMOUNT = "CAST(CAST(floor(tp) AS BIGINT) % 997 AS STRING) || '.' || CAST(k % 100 AS STRING)"
_INT_TEXTS = lambda shift: pick(
    f"k + {shift}", ["@k100", "@k100.7", "@neg", ".5", "1e3", "99999999999", "", "abc", "0.99999999999", "12.99999999999", "\t12", "-.5", "7.x", "."]
)


def _int_text(shift: int) -> str:
    base = _INT_TEXTS(shift)
    return (
        base.replace("'@k100.7'", "CAST(k % 100 AS STRING) || '.7'")
        .replace("'@k100'", "CAST(k % 100 AS STRING)")
        .replace("'@neg'", "'-' || CAST(k % 10 AS STRING) || '.9'")
    )


# Fixed test vocabulary: phrases that reach each classifier rule.
RATE_DESCRIPTIONS = [
    "Client Value Rate", "CWV special", "Carlson value deal", "ROOMIT flexi", "Room It saver",
    "CRS negotiated", "CWV CRS", "Client negotiated", "Carlson partner", "Consortia rate",
    "Worldwide best", "Room rac", "Room pro promo", "Bed flexible rate", "Beds flexible rate",
    "CORPORATE", "GOV RATE", "NEG RATE CLT", "ACORN DECOR", "Government", "std cor",
    "std cor rate", "AAA member", "SPG Member", "Best available", None, "zeta2 weekend", "",
]
CONTENT_SOURCES = [
    "BOOKING.COM", "EAN HOTEL COLLECT", "SABRE", "AMADEUS", "GALILEO", "APOLLO", "HOTELHUB",
    "PREMIER INN - PI", "CHL", "DESIYA HOTELS", "LOCAL AGGREGATOR", "HOTELHUB", "HOTELHUB",
    "OTHER SRC", None, "HOTELHUB", "EANX", "PREMIER", "BOOKING.COM CASHONLY",
]
GDS_SHOPPED = ["SABRE", "APOLLO", "AMADEUS", "GALILEO", None, "OTHER"]
RATE_BUCKETS = [
    "CLIENT RATE", "ROOMIT", "PUBLIC", "PUBLIC RATE", "U", "KUNDEN", "REQUEST", "ANFRAGE", "",
    None, "BEST AVAILABLE", "DEMANDE", "PETICION", "ROOMIT CLIENT",
]
ACCESS_CODES = ["CWV", "CLIENT", "SC", "COR", "", None, "XYZ"]
COMMISSION_TEXTS = ["NON COMM", "NOT COMMISSIONABLE", "NO COMMISSION", "COMM 0.00%", "UNKNOWN", "10 PCT", "", None, "NOC"]
CHANNELS = {"AUTOMOBILE": "CYTRIC", "BUILDING": "CONCUR", "MACHINERY": "GETTHERE", "FURNITURE": "OFFLINE"}

_HEADER_ROW = "(pr = '2-HIGH' AND st = 'P' AND seg = 'HOUSEHOLD')"
_SHORT_DATE = "(pr = '1-URGENT' AND st = 'P' AND seg = 'FURNITURE')"
_LOCATOR = "CAST(c % 40 AS STRING)"

# (raw feed column, expression). Raw names of the renamed columns are used.
FEED: list[tuple[str, str]] = [
    ("booking_status", "CASE st WHEN 'F' THEN 'CFD' WHEN 'O' THEN 'CNX' ELSE 'PND' END"),
    ("hotelhub_booking_ref", "CASE WHEN pr = '5-LOW' AND seg = 'HOUSEHOLD' THEN CAST(NULL AS STRING) ELSE 'HB' || CAST(c AS STRING) || '-' || substr(created_txt, 1, 2) END"),
    ("confirmation_ref", "'CF' || CAST(k AS STRING)"),
    ("cancellation_ref", "CASE WHEN st = 'O' THEN 'CX' || CAST(k AS STRING) END"),
    ("pnr", f"CASE WHEN pr = '3-MEDIUM' AND seg IN ('MACHINERY', 'AUTOMOBILE') THEN CAST(NULL AS STRING) ELSE 'PN-' || {_LOCATOR} END"),
    ("pnr_type", "CASE WHEN st = 'F' THEN 'GDS' ELSE 'OBT' END"),
    ("hotelhub_mode", pick("k", ["ONLINE", "OFFLINE"])),
    ("market", "'M' || CAST(nat AS STRING)"),
    ("client_client_top_name", "CASE WHEN k % 29 = 0 THEN '' ELSE 'Zeta' || CAST(c % 5 AS STRING) END"),
    ("client_sub_unit_client_name", "cname"),
    ("customer_agency_name", "'AGENCY' || CAST(nat % 5 AS STRING)"),
    ("hotel_name", "'Hotel ' || CAST(k % 97 AS STRING)"),
    ("city", "'CITY' || CAST(nat AS STRING)"),
    ("country", "'C' || CAST(nat AS STRING)"),
    ("star_rating", "CAST(1 + k % 5 AS STRING)"),
    ("date_in", "date_in_txt"),
    ("date_out", "date_out_txt"),
    ("nights", "CAST(1 + k % 3 AS STRING)"),
    ("num_of_rooms", "'1'"),
    ("num_of_guest", "CAST(1 + k % 4 AS STRING)"),
    ("out_policy_reason", "CAST(NULL AS STRING)"),
    ("booking_source", "'WEB'"),
    ("rate_description", pick("k", RATE_DESCRIPTIONS)),
    ("cancellation_policy", "CAST(NULL AS STRING)"),
    ("rateperday_amount", f"CASE WHEN k % 13 = 0 THEN 'n/a' ELSE {_AMOUNT} END"),
    ("rateperday_currcode", "'EUR'"),
    ("agency_priority", "pd"),
    ("customer_priority", "pd"),
    ("payment_mode", "'CC'"),
    ("rateperday_eur", _AMOUNT),
    ("rateperday_gbp", f"CASE WHEN k % 17 = 0 THEN '' ELSE {_AMOUNT} END"),
    ("rateperday_usd", "CAST(CAST(floor(tp) AS BIGINT) AS STRING)"),
    ("totalamount_booked_currcode", "'EUR'"),
    ("totalamount_booked", _AMOUNT),
    ("local_currency_code", "'EUR'"),
    ("rateperday_lcc", "'-' || " + _AMOUNT),
    ("totalamount_eur", _AMOUNT),
    ("totalamount_gbp", "CASE WHEN k % 7 = 0 THEN CAST(NULL AS STRING) ELSE " + _AMOUNT + " END"),
    ("totalamount_usd", "'1e3'"),
    ("totalamount_lcc", "' ' || " + _AMOUNT + " || ' '"),
    ("booked_rate_type_code", "CASE WHEN k % 19 = 0 THEN CAST(NULL AS STRING) ELSE 'RT' || CAST(k % 4 AS STRING) END"),
    ("content_source", pick("k", CONTENT_SOURCES)),
    ("gds_chain_name", "'CHAIN' || CAST(k % 9 AS STRING)"),
    ("created_date", f"CASE WHEN {_SHORT_DATE} THEN '1905' ELSE created_txt END"),
    ("createdby_user", "'U' || CAST(c % 10 AS STRING)"),
    ("confirmedby_user", "'U' || CAST(c % 10 AS STRING)"),
    ("cancel_datetime", "CASE WHEN st = 'O' THEN event_txt WHEN st = 'F' THEN '' WHEN k % 2 = 0 THEN 'garbage' END"),
    ("abandon_by_user", "CAST(NULL AS STRING)"),
    ("obt_pnr", f"CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING') THEN 'OB-' || {_LOCATOR} END"),
    ("client_booking_channel", "CASE seg " + " ".join(f"WHEN '{s}' THEN '{ch}'" for s, ch in CHANNELS.items()) + " END"),
    ("rate_access_code_booked", pick("k + 3", ACCESS_CODES)),
    ("commission_type", "'PCT'"),
    ("commission_currency", "'EUR'"),
    ("commission_amount", _AMOUNT),
    ("estimated_income_due", _AMOUNT),
    ("rate_access_code_shopped", "CAST(NULL AS STRING)"),
    ("hotelhub_property_id", "'HP' || CAST(k % 500 AS STRING)"),
    ("harp_property_id_no", "CASE WHEN pr = '4-NOT SPECIFIED' AND seg = 'BUILDING' THEN CAST(NULL AS STRING) WHEN c % 23 = 7 THEN '-1' ELSE 'HR' || CAST(c % 23 AS STRING) || pd END"),
    ("content_source_property_id", "CAST(NULL AS STRING)"),
    ("aggregator_booking_commission", "CAST(NULL AS STRING)"),
    ("aggregator_revenue_value", _AMOUNT),
    ("aggregator_revenue_share", "CAST(NULL AS STRING)"),
    ("aggregator_currency", "'EUR'"),
    ("rate_change", "'N'"),
    ("rate_access_code_returned", "CAST(NULL AS STRING)"),
    ("back_office_account_number", "'BO' || CAST(nat AS STRING)"),
    ("traveller_portrait_guid", "CASE WHEN seg = 'FURNITURE' AND pr = '1-URGENT' THEN '' WHEN seg = 'HOUSEHOLD' AND pr = '3-MEDIUM' THEN CAST(NULL AS STRING) WHEN c % 2 = 0 THEN 'G-' || CAST(c AS STRING) || '-' || CAST(nat AS STRING) ELSE 'G' || CAST(c AS STRING) END"),
    ("booking_start_dttm", "CASE WHEN k % 11 = 0 THEN '' ELSE event_txt END"),
    ("booking_end_dttm", "later_txt"),
    ("step0_time", _int_text(0)),
    ("step1_time", _int_text(1)),
    ("step2_time", _int_text(2)),
    ("step3_time", _int_text(3)),
    ("step4_time", _int_text(4)),
    ("gds_shopped_for_rate", pick("k + 1", GDS_SHOPPED)),
    ("cheap_client_neg_rate", _int_text(5)),
    ("cheap_client_neg_rate_currcode", "'EUR'"),
    ("cheap_client_neg_rate_description", "CAST(NULL AS STRING)"),
    ("cheap_client_or_cwv_rate", _int_text(6)),
    ("cheap_client_or_cwv_neg_rate_currcode", "'EUR'"),
    ("cheap_client_or_cwv_rate_description", "CAST(NULL AS STRING)"),
    ("cheap_gds_published_rate", _int_text(7)),
    ("cheap_gds_neg_rate_currcode", "'EUR'"),
    ("cheap_gds_published_rate_description", "CAST(NULL AS STRING)"),
    ("cheap_aggregator_rate", "CAST(CAST(floor(tp) AS BIGINT) % 500 AS STRING)"),
    ("cheap_aggregator_rate_currcode", "'EUR'"),
    ("cheap_aggregator_rate_description", "'AGG' || CAST(k % 3 AS STRING)"),
    ("branch_iata", "'1234'"),
    ("on_request_indicator", "'N'"),
    ("lastmodified_datetime", "CASE WHEN pr = '5-LOW' AND st = 'F' THEN '' WHEN pr = '5-LOW' AND st = 'O' THEN CAST(NULL AS STRING) ELSE lastmod_txt END"),
    ("modified_count", "CAST(k % 4 AS STRING)"),
    ("booking_time_duration", "CAST(NULL AS STRING)"),
    ("rate_bucket", pick("k + 5", RATE_BUCKETS)),
    ("back_office", "'BO'"),
    ("client_sub_unit_client_id", "'SU' || CAST(c AS STRING)"),
    ("missed_saving", _int_text(2)),
    ("realised_saving", _int_text(3)),
    ("popular_hotel", pick("k", ["Y", "N"])),
    ("hotel_rank", "CAST(k % 10 AS STRING)"),
    ("hotel_total", "CAST(10 + k % 90 AS STRING)"),
    ("agency_source_name", "'AG'"),
    ("client_client_top_id", "'TOP' || CAST(c % 5 AS STRING)"),
    ("err_desc", "CAST(NULL AS STRING)"),
    ("aggregator_property_type", "CAST(NULL AS STRING)"),
    ("hotel_bucket_simplified", "CAST(NULL AS STRING)"),
    ("gds_commission_text", pick("k + 2", COMMISSION_TEXTS)),
    ("avlb_htl_count", "CAST(k % 50 AS STRING)"),
    ("offer", "CAST(NULL AS STRING)"),
    ("aaa_rate", "'N'"),
    ("error_code", "CAST(NULL AS STRING)"),
    ("payment_type_used", "'CC'"),
    ("sessionid", "'SS' || CAST(k AS STRING)"),
    ("derived_commission%", _AMOUNT),
]

FEED_NAMES = [name for name, _ in FEED]


def feed_select_list() -> list[str]:
    """Feed columns; rows flagged as a repeated header carry the column names."""
    return [f"CASE WHEN {_HEADER_ROW} THEN '{name}' ELSE ({expr}) END AS `{name}`" for name, expr in FEED]


def feed_select_sql_duckdb() -> str:
    return ",\n".join(
        f"CASE WHEN {_HEADER_ROW} THEN '{name}' ELSE ({expr}) END AS \"{name}\"" for name, expr in FEED
    )


# ---------------------------------------------------------------------------
# Warehouse star schema derived from the same orders. Facts: orders of
# priority 5 are left out; priority 4 facts point to another traveller
# (full key differs → level 3), priority 3 to another property (→ level 2).
# ---------------------------------------------------------------------------
FACT = [
    ("fact_hotel_id", "CAST(k AS DECIMAL(10,0))"),
    ("start_date", "start_ts"),
    ("end_date", "end_ts"),
    ("effective_date", "eff_ts"),
    ("dim_booking_id", "k"),
    ("dim_supplier_id", "CASE WHEN pr = '3-MEDIUM' THEN ((c + 1) % 23) * 10 + CAST(pd AS BIGINT) ELSE (c % 23) * 10 + CAST(pd AS BIGINT) END"),
    ("dim_traveler_profile_id", "CASE WHEN pr = '4-NOT SPECIFIED' THEN c + 1 ELSE c END"),
    ("issuing_country_id", "(nat + k % 2) % 25"),
]
FACT_FILTER = "pr <> '5-LOW'"

HELPERS_FACT_SPARK = """
CAST(trunc(o_orderdate, 'MM') AS TIMESTAMP_NTZ) AS start_ts,
CAST(date_add(trunc(o_orderdate, 'MM'), CAST(1 + o_orderkey % 3 AS INT)) AS TIMESTAMP_NTZ) AS end_ts,
timestampadd(HOUR, CAST(o_orderkey % 4 AS INT), o_orderdate) AS eff_ts
"""
HELPERS_FACT_DUCKDB = """
date_trunc('month', o_orderdate) AS start_ts,
date_trunc('month', o_orderdate) + to_days(CAST(1 + o_orderkey % 3 AS INTEGER)) AS end_ts,
o_orderdate + to_hours(CAST(o_orderkey % 4 AS INTEGER)) AS eff_ts
"""

# dim_booking: the booking's effective locator; NULL locators are filtered by the job.
DIM_BOOKING = [
    ("dim_booking_id", "k"),
    ("booking_locator", "CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN (CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING') THEN 'OB-' || " + _LOCATOR + " END) ELSE (CASE WHEN pr = '3-MEDIUM' AND seg IN ('MACHINERY', 'AUTOMOBILE') THEN CAST(NULL AS STRING) ELSE 'PN-' || " + _LOCATOR + " END) END"),
]
# dim_supplier: one row per property id; property 5 is discontinued.
DIM_SUPPLIER = [
    ("dim_supplier_id", "(c % 23) * 10 + CAST(pd AS BIGINT)"),
    ("harp_key", "CASE WHEN c % 23 = 7 THEN '-1' ELSE 'HR' || CAST(c % 23 AS STRING) || pd END"),
    ("discontinue_date", "CASE WHEN c % 23 = 5 THEN '2015-06-30' WHEN c % 23 = 9 THEN '2000-01-01' ELSE '2999-12-31' END"),
]
# dim_traveler_profile: one row per customer; customers in debit are missing.
DIM_TRAVELER = [
    ("dim_traveler_profile_id", "c_custkey"),
    ("traveler_guid", "CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey % 3 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 13 = 0 THEN 'UNKNOWN' WHEN c_custkey % 2 = 0 THEN 'G:' || CAST(c_custkey AS STRING) || ':' || CAST(c_nationkey AS STRING) ELSE 'G' || CAST(c_custkey AS STRING) END"),
    ("country_code", "'C' || CAST(c_nationkey AS STRING)"),
]
DIM_TRAVELER_FILTER = "c_acctbal >= 0"
# dim_location: nations; the nations of region 3 are missing.
DIM_LOCATION = [
    ("dim_location_id", "n_nationkey"),
    ("country_code", "'C' || CAST(n_nationkey AS STRING)"),
]
DIM_LOCATION_FILTER = "n_regionkey <> 3"
