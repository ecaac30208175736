"""DuckDB statements of the booking keys.

The cascade is stated literally (three key joins with anti joins on the
booking reference), so it checks the pair-free Spark formulation.
"""

from __future__ import annotations

from bindings import feed_sql as FS
from ratelake.contracts import BASE_PROJECTION, EXPORT_CONTRACT

_ENDS = r"'^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$'"


def lenient_int_sql(x: str, typ: str = "INTEGER") -> str:
    """The digits before the point; what follows it only has to be digits."""
    t = f"regexp_replace({x}, {_ENDS}, '', 'g')"
    return (
        f"(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+([.][0-9]*)?') "
        f"THEN TRY_CAST(regexp_extract({t}, '^[+-]?[0-9]+') AS {typ}) "
        f"WHEN regexp_full_match({t}, '[+-]?[.][0-9]+') THEN 0 END)"
    )


def compact_ts_sql(x: str, n: int) -> str:
    return f"TRY_CAST(concat_ws('-', '20' || substr({x}, 1, 2), substr({x}, 3, 2), substr({x}, 5, {n})) AS TIMESTAMP)"


FEED = f"""
h AS (SELECT {FS.HELPERS_DUCKDB} FROM orders JOIN customer ON o_custkey = c_custkey),
feed AS (SELECT {FS.feed_select_sql_duckdb()} FROM h),
raw AS (
  SELECT * RENAME (cheap_aggregator_rate AS CHEAP_BOOKINGCOM_RATE,
                   cheap_aggregator_rate_currcode AS CHEAP_BOOKINGCOM_RATE_CURRCODE,
                   cheap_aggregator_rate_description AS CHEAP_BOOKINGCOM_RATE_DESCRIPTION,
                   "derived_commission%" AS DERIVED_COMMISSION),
         '20' || substr(created_date, 1, 2) AS date_created_year,
         substr(created_date, 3, 2) AS date_created_month,
         substr(created_date, 5, 2) AS date_created_day
  FROM feed WHERE {lenient_int_sql('created_date')} IS NOT NULL
)"""

# Prefix of the content source, prefix of the shopped source ('' = any), code;
# the first row that fits gives the channel.
CHANNEL_ROWS = [
    ("BOOKING", "", "BC"), ("EAN", "", "EH"), ("DESIYA", "", "DH"), ("PREMIER", "", "PI"), ("CHL", "", "CM"),
    ("SABR", "", "S"), ("AMAD", "", "A"), ("GALI", "", "G"), ("APO", "", "1V"),
    ("HOTELH", "SABR", "S"), ("HOTELH", "APO", "1V"), ("HOTELH", "AMAD", "A"), ("HOTELH", "GALI", "G"),
]
_CHANNEL_LIST = ", ".join(f"{{'head': '{a}', 'shopped': '{b}', 'code': '{c}'}}" for a, b, c in CHANNEL_ROWS)
CHANNEL = f"""coalesce(list_filter([{_CHANNEL_LIST}], lambda r: starts_with(content_source, r.head)
  AND (r.shopped = '' OR coalesce(starts_with(gds_shopped_for_rate, r.shopped), false)))[1].code, 'XX')"""

# Classifier inputs as named flags, then the ordered decision.
FLAGS = """
flags AS (
  SELECT *,
    instr(lower(rate_description), 'client value') <> 0 OR instr(lower(rate_description), 'cwv') <> 0 AS f_cv,
    (rate_bucket LIKE '%CLIENT%' OR rate_bucket LIKE '%ROOMIT%') AS f_rbc,
    (gds_commission_text LIKE '%NON%' OR gds_commission_text LIKE '%NOT%' OR gds_commission_text LIKE '%NO C%'
       OR gds_commission_text LIKE '% 0.00%') AS f_noc,
    (rate_bucket LIKE '%REQUEST%' OR rate_bucket LIKE '%ANFRAGE%' OR rate_bucket LIKE '%DEMANDE%'
       OR rate_bucket LIKE '%PETICI%' OR rate_bucket LIKE 'PUBLIC%' OR rate_bucket IS NULL OR rate_bucket = '') AS f_req,
    (instr(lower(rate_description), 'corn') = 0 AND instr(lower(rate_description), 'decor') = 0
       AND instr(lower(rate_description), 'corri') = 0) AS f_safe,
    (rate_access_code_booked IS NULL OR rate_access_code_booked = '') AS f_rac_blank,
    (gds_commission_text IS NULL OR gds_commission_text = '') AS f_ct_blank,
    instr(lower(rate_description), 'client') <> 0 AS f_client,
    instr(lower(rate_description), 'carlson') <> 0 AS f_carlson,
    instr(lower(rate_description), 'value') <> 0 AS f_value
  FROM raw
)"""

BUCKET = """CASE
  WHEN content_source IN ('BOOKING.COM', 'EAN HOTEL COLLECT', 'BOOKING.COM CASHONLY', 'DESIYA HOTELS', 'LOCAL AGGREGATOR') THEN 'AGG RATE'
  WHEN content_source = 'PREMIER INN - PI' THEN 'PUB - DIRECT CONNECT'
  WHEN f_rbc AND rate_access_code_booked = 'CWV' THEN 'ROOMIT (CWV)'
  WHEN f_rbc AND f_cv THEN 'ROOMIT (CWV)'
  WHEN (rate_access_code_booked = 'CWV' OR f_rac_blank) AND f_cv THEN 'ROOMIT (CWV)'
  WHEN (f_client AND f_value) OR (f_carlson AND f_value) OR instr(lower(rate_description), 'roomit') <> 0
       OR instr(lower(rate_description), 'room it') <> 0 THEN 'ROOMIT (CWV)'
  WHEN NOT (rate_description LIKE 'CWV%') AND instr(lower(rate_description), 'crs') <> 0 THEN 'CLIENT'
  WHEN f_rbc AND rate_access_code_booked = 'CLIENT' THEN 'ROOMIT (CLIENT)'
  WHEN (rate_access_code_booked = 'CLIENT' OR f_rac_blank) AND (f_client OR f_carlson) THEN 'ROOMIT (CLIENT)'
  WHEN (f_client AND NOT f_value) OR (f_carlson AND NOT f_value) OR instr(lower(rate_description), 'consortia') > 0 THEN 'ROOMIT (CLIENT)'
  WHEN rate_bucket LIKE '%PUBLIC%' AND instr(lower(rate_description), 'worldwide') > 0 THEN 'PUB'
  WHEN instr(lower(rate_description), 'room rac') > 0 OR instr(lower(rate_description), 'room pro') > 0
       OR instr(lower(rate_description), 'bed flexible rate') > 0 OR instr(lower(rate_description), 'beds flexible rate') > 0 THEN 'PUB'
  WHEN rate_bucket LIKE '%CLIENT%' OR rate_bucket LIKE '%KUNDEN%' THEN 'CLIENT'
  WHEN f_req AND (gds_commission_text LIKE 'NO%' OR f_ct_blank) THEN 'CLIENT'
  WHEN (rate_bucket LIKE '%PUBLIC%' OR rate_bucket = 'U') AND f_noc THEN 'CLIENT'
  WHEN (f_noc OR gds_commission_text LIKE '%UNK%')
       AND (rate_description LIKE '%COR%' OR rate_description LIKE '%CLT' OR rate_description LIKE '%GOV%' OR rate_description LIKE '%NEG%')
       AND f_safe THEN 'CLIENT'
  WHEN f_ct_blank AND f_req AND (rate_description LIKE '%CLT' OR rate_description LIKE '%COR%' OR rate_description LIKE '%NEG%') AND f_safe THEN 'CLIENT'
  WHEN f_ct_blank AND rate_description LIKE '%COR' THEN 'CLIENT'
  WHEN f_noc THEN 'CLIENT'
  WHEN instr(lower(rate_description), 'corporate') <> 0 OR instr(lower(rate_description), 'government') <> 0 THEN 'CLIENT'
  WHEN (f_rac_blank OR rate_access_code_booked IN ('SC', 'COR'))
       AND (instr(lower(rate_description), ' cor') > 0 OR instr(lower(rate_description), ' clt') > 0) THEN 'CLIENT'
  WHEN instr(lower(rate_description), lower(client_client_top_name)) > 0 THEN 'CLIENT'
  WHEN instr(lower(rate_description), 'aaa') > 0 OR instr(lower(rate_description), 'caa') > 0
       OR instr(lower(rate_description), 'aarp') > 0 OR instr(lower(rate_description), 'spg member') > 0 THEN 'CLIENT'
  ELSE 'PUB' END"""


def _base_expr(out: str, kind: str, src: str) -> str:
    if kind == "pass":
        return src
    if kind == "double":
        return f"TRY_CAST({src} AS DOUBLE)"
    if kind == "int":
        return lenient_int_sql(src)
    if kind == "date":
        return compact_ts_sql(src, 2)
    if kind == "dtext":
        return f"(CASE WHEN length({src}) = 0 THEN '' ELSE CAST({compact_ts_sql(src, 11)} AS VARCHAR) END)"
    if kind == "guid":
        return f"(CASE WHEN {src} = '' THEN 'UNKNOWN' WHEN {src} LIKE '%-%' THEN replace({src}, '-', ':') ELSE {src} END)"
    if kind == "channel":
        return f"({CHANNEL})"
    if kind == "rate_id":
        return f"(hotelhub_property_id || rate_access_code_booked || booked_rate_type_code || ({CHANNEL}))"
    if kind == "rate_bucket":
        return f"({BUCKET})"
    raise ValueError(kind)


BASE_SELECT = ",\n  ".join(f"{_base_expr(o, k, s)} AS {o}" for o, k, s in BASE_PROJECTION)

OBT = "('CYTRIC', 'TRVDOO', 'KDSS', 'GETTHERE', 'CONCUR', 'BOOK2GO', 'SERKO', 'ZILLIOUS')"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '[^a-zA-Z0-9]+', '', 'g')"


BOOKINGS = f"""
{FEED},
{FLAGS},
base AS (SELECT
  {BASE_SELECT}
  FROM flags),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hotelhub_booking_ref
      ORDER BY lastmodified_datetime DESC NULLS LAST, confirmation_ref DESC NULLS LAST, sessionid DESC NULLS LAST) AS rn
    FROM base) WHERE rn = 1
),
mk0 AS (
  SELECT *, CASE WHEN client_booking_channel IN {OBT} THEN obt_pnr ELSE pnr END AS loc,
         CAST(date_in AS VARCHAR) || CAST(date_out AS VARCHAR) AS dates
  FROM latest
  WHERE booking_status IN ('CFD', 'CNX') AND (pnr IS NOT NULL OR obt_pnr IS NOT NULL)
),
mk AS (
  SELECT * EXCLUDE (loc, dates),
    {_strip("dates || loc || harp_property_id_no || traveller_portrait_guid")} AS full_mk,
    {_strip("dates || loc || harp_property_id_no")} AS prop_mk,
    {_strip("dates || loc")} AS pnr_mk,
    sha256({_strip("dates || loc")}) AS dedupe_key
  FROM mk0
),
keyed AS (
  SELECT * EXCLUDE (rk), CAST(rk AS INTEGER) AS rk, 9999 AS row_num FROM (
    SELECT *, rank() OVER (PARTITION BY dedupe_key ORDER BY lastmodified_datetime DESC NULLS LAST) AS rk FROM mk
  ) WHERE rk = 1
)"""

STAR = f"""
hf AS (SELECT {FS.HELPERS_DUCKDB}, {FS.HELPERS_FACT_DUCKDB} FROM orders JOIN customer ON o_custkey = c_custkey),
fact_hotel AS (SELECT {", ".join(f"{e} AS {n}" for n, e in FS.FACT)} FROM hf WHERE {FS.FACT_FILTER}),
dim_booking AS (SELECT {", ".join(f"{e} AS {n}" for n, e in FS.DIM_BOOKING)} FROM hf),
dim_supplier AS (SELECT DISTINCT {", ".join(f"{e} AS {n}" for n, e in FS.DIM_SUPPLIER)} FROM hf),
dim_traveler AS (SELECT {", ".join(f"{e} AS {n}" for n, e in FS.DIM_TRAVELER)} FROM customer WHERE {FS.DIM_TRAVELER_FILTER}),
dim_location AS (SELECT {", ".join(f"{e} AS {n}" for n, e in FS.DIM_LOCATION)} FROM nation WHERE {FS.DIM_LOCATION_FILTER}),
dwh AS (
  SELECT f.fact_hotel_id, f.start_date, f.end_date, f.effective_date, b.booking_locator, s.harp_key, t.traveler_guid,
         t.country_code AS trav_country, l.country_code AS loc_country,
         CASE WHEN t.country_code = l.country_code THEN 'N' ELSE 'Y' END AS emulation_flag
  FROM fact_hotel f
  JOIN dim_booking b ON f.dim_booking_id = b.dim_booking_id AND b.booking_locator IS NOT NULL
  JOIN dim_supplier s ON f.dim_supplier_id = s.dim_supplier_id AND s.discontinue_date IN ('2000-01-01', '2999-12-31')
  JOIN dim_traveler t ON f.dim_traveler_profile_id = t.dim_traveler_profile_id
  LEFT JOIN dim_location l ON f.issuing_country_id = l.dim_location_id
  WHERE f.start_date >= TIMESTAMP '1996-01-01'
),
dwh_k AS (
  SELECT *,
    {_strip("CAST(start_date AS VARCHAR) || CAST(end_date AS VARCHAR) || booking_locator || harp_key || traveler_guid")} AS full_mk,
    {_strip("CAST(start_date AS VARCHAR) || CAST(end_date AS VARCHAR) || booking_locator || harp_key")} AS prop_mk,
    {_strip("CAST(start_date AS VARCHAR) || CAST(end_date AS VARCHAR) || booking_locator")} AS pnr_mk
  FROM dwh
),
mapping AS (
  SELECT DISTINCT * EXCLUDE (rk),
    CAST(year(effective_date) AS INTEGER) AS effective_date_year,
    CAST(month(effective_date) AS INTEGER) AS effective_date_month,
    CAST(day(effective_date) AS INTEGER) AS effective_date_day
  FROM (
    SELECT *, rank() OVER (PARTITION BY full_mk ORDER BY effective_date DESC NULLS LAST, fact_hotel_id DESC NULLS LAST) AS rk
    FROM dwh_k
  ) WHERE rk = 1
)"""

_ANTI = "NOT EXISTS (SELECT 1 FROM {t} x WHERE x.hotelhub_booking_ref = k.hotelhub_booking_ref)"

CASCADE = f"""
t4 AS (
  SELECT k.*, m.fact_hotel_id, m.emulation_flag, 4 AS match_level FROM keyed k JOIN mapping m ON k.full_mk = m.full_mk
  WHERE k.traveller_portrait_guid IS NOT NULL AND k.harp_property_id_no IS NOT NULL
    AND m.traveler_guid <> 'UNKNOWN' AND m.harp_key <> '-1'
),
t3 AS (
  SELECT k.*, m.fact_hotel_id, m.emulation_flag, 3 AS match_level FROM keyed k JOIN mapping m ON k.prop_mk = m.prop_mk
  WHERE k.harp_property_id_no IS NOT NULL AND m.harp_key <> '-1' AND {_ANTI.format(t="t4")}
),
t2 AS (
  SELECT k.*, m.fact_hotel_id, m.emulation_flag, 2 AS match_level FROM keyed k JOIN mapping m ON k.pnr_mk = m.pnr_mk
  WHERE {_ANTI.format(t="t4")} AND {_ANTI.format(t="t3")}
),
t0 AS (
  SELECT k.* FROM keyed k WHERE {_ANTI.format(t="t4")} AND {_ANTI.format(t="t3")} AND {_ANTI.format(t="t2")}
),
tiers AS (SELECT * FROM t4 UNION ALL SELECT * FROM t3 UNION ALL SELECT * FROM t2),
fin_a AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY fact_hotel_id ORDER BY lastmodified_datetime DESC NULLS LAST,
      match_level DESC, confirmation_ref DESC NULLS LAST, sessionid DESC NULLS LAST) AS rn FROM tiers
  ) WHERE rn = 1
),
fin_b AS (
  SELECT * EXCLUDE (rn), CAST(-1 AS DECIMAL(10,0)) AS fact_hotel_id, 'N' AS emulation_flag, -1 AS match_level FROM (
    SELECT *, row_number() OVER (PARTITION BY hotelhub_booking_ref ORDER BY confirmation_ref DESC NULLS LAST,
      sessionid DESC NULLS LAST) AS rn FROM t0
  ) k WHERE rn = 1 AND {_ANTI.format(t="fin_a")}
),
resolved AS (
  SELECT * EXCLUDE (rnk), 1 AS rk_f, 1 AS rnk_f, client_booking_channel AS device_type FROM (
    SELECT *, rank() OVER (PARTITION BY hotelhub_booking_ref ORDER BY fact_hotel_id DESC NULLS LAST, match_level DESC) AS rnk
    FROM (SELECT * FROM fin_a UNION ALL BY NAME SELECT * FROM fin_b)
  ) WHERE rnk = 1
)"""

# Source types after the pipeline, to state the export casts in DuckDB.
_STRING_KINDS = {"pass", "dtext", "guid", "channel", "rate_id", "rate_bucket"}
_SOURCE_IS_TEXT = {o for o, k, _ in BASE_PROJECTION if k in _STRING_KINDS} | {
    "full_mk", "prop_mk", "pnr_mk", "dedupe_key", "emulation_flag", "device_type",
}
_INT_TYPES = {"smallint": "SMALLINT", "bigint": "BIGINT", "tinyint": "TINYINT"}


def export_select(renames: dict[str, str] | None = None) -> str:
    renames = renames or {}
    cols = []
    for name, cast in EXPORT_CONTRACT:
        out = renames.get(name, name)
        if cast is None:
            e = name
        elif cast.startswith("null:"):
            e = f"CAST(NULL AS {_INT_TYPES[cast[5:]]})"
        elif cast == "string":
            e = f"CAST({name} AS VARCHAR)"
        elif cast == "timestamp":
            e = f"TRY_CAST({name} AS TIMESTAMP)"
        elif name in _SOURCE_IS_TEXT:
            e = lenient_int_sql(name, _INT_TYPES[cast])
        else:
            e = f"TRY_CAST({name} AS {_INT_TYPES[cast]})"
        cols.append(f"{e} AS {out}")
    return ",\n  ".join(cols)


def yesterday_sql(today: str) -> str:
    return f"""
y_src AS (
  SELECT * REPLACE (CASE WHEN rate_access_code_booked = 'SC' THEN 'OLD BUCKET' ELSE new_rate_bucket END AS new_rate_bucket)
  FROM {today} WHERE client_booking_channel IS NULL OR client_booking_channel <> 'OFFLINE'
  UNION ALL BY NAME
  SELECT * REPLACE (pnr_mk || 'OLD' AS pnr_mk, confirmation_ref || '-OLD' AS confirmation_ref)
  FROM {today} WHERE content_source = 'SABRE'
),
yest AS (
  SELECT {export_select()} FROM (
    SELECT * REPLACE (1 AS rk, 1 AS rk_f), DATE '2002-01-14' AS dl_last_modified_date FROM y_src
  )
)"""


DELTA_ON = """x.lastmodified_datetime = TRY_CAST(t.lastmodified_datetime AS TIMESTAMP) AND x.full_mk = t.full_mk
  AND x.prop_mk = t.prop_mk AND x.pnr_mk = t.pnr_mk AND x.match_level = t.match_level AND x.new_rate_bucket = t.new_rate_bucket"""


def delta_sql(today: str, yesterday: str | None, renames: dict[str, str] | None = None) -> str:
    t = f"(SELECT * REPLACE (1 AS rk, 1 AS rk_f), DATE '2002-01-15' AS dl_last_modified_date FROM {today})"
    if yesterday is None:
        carried, fresh = "", f"SELECT {export_select()} FROM {t} t"
    else:
        carried = f"""SELECT x.* FROM (SELECT * FROM {yesterday}
            WHERE full_mk IS NOT NULL AND prop_mk IS NOT NULL AND pnr_mk IS NOT NULL) x
          WHERE EXISTS (SELECT 1 FROM {t} t WHERE {DELTA_ON})
          UNION ALL BY NAME """
        fresh = f"""SELECT {export_select()} FROM {t} t
          WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {yesterday}
            WHERE full_mk IS NOT NULL AND prop_mk IS NOT NULL AND pnr_mk IS NOT NULL) x WHERE {DELTA_ON})"""
    final_cols = ", ".join(
        f"{n} AS {renames[n]}" if renames and n in renames else n for n, _ in EXPORT_CONTRACT
    )
    return f"""
SELECT {final_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY pnr_mk ORDER BY dl_last_modified_date ASC NULLS FIRST,
    hotelhub_booking_ref ASC NULLS FIRST, confirmation_ref ASC NULLS FIRST, fact_hotel_id DESC NULLS LAST) AS rn
  FROM ({carried}{fresh})
) WHERE rn = 1"""


RENAMES = {"rate_bucket": "original_rate_bucket", "new_rate_bucket": "rate_bucket"}
_WITH_ALL = f"WITH {BOOKINGS},\n{STAR},\n{CASCADE}"

BOOKING_ORACLE: dict[str, str] = {
    "feed_ingest": f"WITH {FEED}\nSELECT * FROM raw",
    "feed_ingest_stream": f"WITH {FEED}\nSELECT * REPLACE (NULLIF(date_created_day, '') AS date_created_day) FROM raw",
    "base_projection": f"WITH {BOOKINGS}\nSELECT * FROM base",
    "parse_compact_dates": f"""WITH {FEED}
SELECT confirmation_ref, {compact_ts_sql('date_in', 2)} AS date_in, {compact_ts_sql('date_out', 2)} AS date_out,
  {compact_ts_sql('created_date', 2)} AS created_date,
  {_base_expr('', 'dtext', 'cancel_datetime')} AS cancel_datetime,
  {_base_expr('', 'dtext', 'booking_start_dttm')} AS booking_st_tm,
  {_base_expr('', 'dtext', 'lastmodified_datetime')} AS lastmodified_datetime
FROM raw""",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
  CAST(day(o_orderdate) AS INTEGER) AS order_day
FROM orders""",
    "typed_casts": f"""WITH {FEED}
SELECT confirmation_ref,
  TRY_CAST(rateperday_amount AS DOUBLE) AS rateperday_amount, TRY_CAST(rateperday_gbp AS DOUBLE) AS rateperday_gbp,
  TRY_CAST(rateperday_lcc AS DOUBLE) AS rateperday_lcc, TRY_CAST(totalamount_gbp AS DOUBLE) AS totalamount_gbp,
  TRY_CAST(totalamount_usd AS DOUBLE) AS totalamount_usd, TRY_CAST(totalamount_lcc AS DOUBLE) AS totalamount_lcc,
  {lenient_int_sql('step0_time')} AS step0_time, {lenient_int_sql('step1_time')} AS step1_time,
  {lenient_int_sql('step2_time')} AS step2_time, {lenient_int_sql('step3_time')} AS step3_time,
  {lenient_int_sql('step4_time')} AS step4_time, {lenient_int_sql('hotel_total')} AS hotel_total
FROM raw""",
    "normalise_id": f"""WITH {FEED}
SELECT confirmation_ref, traveller_portrait_guid AS raw_guid, {_base_expr('', 'guid', 'traveller_portrait_guid')} AS traveller_portrait_guid
FROM raw""",
    "channel_type": f"""WITH {FEED}
SELECT confirmation_ref, content_source, gds_shopped_for_rate, {CHANNEL} AS channel_type FROM raw""",
    "rate_id": f"""WITH {FEED}
SELECT confirmation_ref, {_base_expr('', 'rate_id', '')} AS rate_id FROM raw""",
    "rate_bucket_rules": f"""WITH {FEED}, {FLAGS}
SELECT confirmation_ref, content_source, rate_bucket, rate_access_code_booked, rate_description, gds_commission_text,
  client_client_top_name, {BUCKET} AS new_rate_bucket
FROM flags""",
    "rate_bucket_documents": f"""WITH raw AS (
  SELECT doc_id, lang, source, source AS content_source, lang AS rate_bucket,
         CAST(NULL AS VARCHAR) AS rate_access_code_booked, text AS rate_description,
         CAST(NULL AS VARCHAR) AS gds_commission_text, CAST(NULL AS VARCHAR) AS client_client_top_name
  FROM documents
), {FLAGS}
SELECT doc_id, lang, source, {BUCKET} AS new_rate_bucket FROM flags""",
    "sql_view_projection": f"""WITH {FEED}
SELECT booking_status, hotelhub_booking_ref, confirmation_ref, CAST(nights AS INTEGER) AS nights,
  upper(content_source) AS content_source, date_created_year, date_created_month, date_created_day
FROM raw WHERE booking_status IN ('CFD', 'CNX')""",
    "latest_per_key": f"WITH {BOOKINGS}\nSELECT hotelhub_booking_ref, lastmodified_datetime, confirmation_ref FROM latest",
    "latest_per_key_ties": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CAST(rk AS INTEGER) AS rk FROM (
  SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST) AS rk FROM lineitem
) WHERE rk = 1""",
    "any_per_key": """
SELECT user_id, event_type, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id ASC NULLS FIRST) AS rn FROM events
) WHERE rn = 1""",
    "match_keys": f"WITH {BOOKINGS}\nSELECT confirmation_ref, full_mk, prop_mk, pnr_mk FROM mk",
    "dedupe_key_hash": f"""WITH {BOOKINGS}
SELECT confirmation_ref, hotelhub_booking_ref, dedupe_key, lastmodified_datetime, rk, row_num FROM keyed""",
    "dwh_mapping": f"WITH {STAR}\nSELECT * FROM mapping",
    "match_cascade": f"""{_WITH_ALL}
SELECT hotelhub_booking_ref, confirmation_ref, lastmodified_datetime, full_mk, prop_mk, pnr_mk, match_level,
  count(*) AS candidate_facts
FROM tiers GROUP BY ALL
UNION ALL
SELECT hotelhub_booking_ref, confirmation_ref, lastmodified_datetime, full_mk, prop_mk, pnr_mk, -1 AS match_level,
  CAST(0 AS BIGINT) AS candidate_facts
FROM t0""",
    "match_resolve": f"""{_WITH_ALL}
SELECT hotelhub_booking_ref, confirmation_ref, lastmodified_datetime, pnr_mk, fact_hotel_id, emulation_flag,
  match_level, device_type, rk_f, rnk_f
FROM resolved""",
    "snapshot_delta": f"""{_WITH_ALL},
{yesterday_sql('resolved')}
{delta_sql('resolved', 'yest')}""",
    "consumer_export": f"""{_WITH_ALL},
{yesterday_sql('resolved')}
{delta_sql('resolved', 'yest', RENAMES)}""",
    "booking_pipeline": f"""{_WITH_ALL}
{delta_sql('resolved', None, RENAMES)}""",
    "merge_schema_scan": """
SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS o_priority_rank
FROM orders""",
    "table_sink_roundtrip": "SELECT * FROM customer",
    "staged_overwrite": "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal * 2, 2) AS s_acctbal FROM supplier",
    "write_audit": "SELECT count(*) AS rows_written FROM lineitem",
    # Bookings that differ only in which column is NULL (see ``match_null_rows``).
    "match_null_rows": """
WITH c2 AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'P' || CAST(c_custkey % 50 AS VARCHAR) END AS mk FROM customer),
b AS (
  SELECT 'X' || CAST(c_custkey AS VARCHAR) AS ref, NULL::VARCHAR AS confirmation_ref, mk FROM c2
  UNION SELECT NULL, 'X' || CAST(c_custkey AS VARCHAR), mk FROM c2),
m AS (SELECT CAST(s_suppkey AS DECIMAL(10,0)) AS fact_hotel_id, 'P' || CAST(s_suppkey % 50 AS VARCHAR) AS mk, f AS emulation_flag
      FROM supplier, (VALUES ('Y'), ('N')) v(f)),
t AS (SELECT b.*, m.fact_hotel_id, m.emulation_flag, 2 AS match_level FROM b JOIN m ON b.mk = m.mk),
a AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY fact_hotel_id
        ORDER BY confirmation_ref DESC NULLS LAST, ref DESC NULLS LAST, emulation_flag) AS n FROM t) WHERE n = 1),
u AS (SELECT * EXCLUDE (n), CAST(-1 AS DECIMAL(10,0)) AS fact_hotel_id, 'N' AS emulation_flag, -1 AS match_level FROM (
        SELECT *, row_number() OVER (PARTITION BY ref ORDER BY confirmation_ref DESC NULLS LAST, ref DESC NULLS LAST) AS n
        FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.ref = b.ref)) WHERE n = 1),
r AS (SELECT *, rank() OVER (PARTITION BY ref ORDER BY fact_hotel_id DESC, match_level DESC) AS n
      FROM (SELECT * FROM a UNION ALL SELECT * FROM u))
SELECT ref, confirmation_ref, mk AS pnr_mk, fact_hotel_id, emulation_flag, match_level FROM r WHERE n = 1""",
    "binary_text_scan": """
SELECT c_custkey, c_name AS name_text, c_mktsegment AS segment_text FROM customer""",
    "load_date_default": f"""{_WITH_ALL}
SELECT pnr_mk, confirmation_ref, CAST(0 AS INTEGER) AS days_since_load FROM ({delta_sql('resolved', None)})""",
    "booking_two_days": f"""{_WITH_ALL},
{yesterday_sql('resolved')}
{delta_sql('resolved', 'yest', RENAMES)}""",
    "stage_audit": f"""{_WITH_ALL}
SELECT 'base' AS stage, count(*) AS rows FROM latest UNION ALL SELECT 'keyed', count(*) FROM keyed
UNION ALL SELECT 'mapping', count(*) FROM mapping UNION ALL SELECT 'matched', count(*) FROM resolved
UNION ALL SELECT 'raw', count(*) FROM raw""",
    # Day one publishes rows of which every 16th key had another bucket value.
    "snapshot_buckets": f"""{_WITH_ALL},
before AS (
  SELECT * REPLACE (CASE WHEN substr(md5(pnr_mk), 1, 1) = '0' THEN 'OLD BUCKET' ELSE new_rate_bucket END AS new_rate_bucket)
  FROM resolved
),
yest AS ({delta_sql('before', None).replace('2002-01-15', '2002-01-14')}
)
{delta_sql('resolved', 'yest')}""",
    # The second of two runs on one feed.
    "booking_pipeline_versions": f"""{_WITH_ALL},
yest AS ({delta_sql('resolved', None).replace('2002-01-15', '2002-01-14')}
)
{delta_sql('resolved', 'yest', RENAMES)}""",
    "latest_state_days": f"WITH {BOOKINGS}\nSELECT hotelhub_booking_ref, lastmodified_datetime, confirmation_ref FROM latest",
    "versioned_publish": "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal * 2, 2) AS s_acctbal FROM supplier",
    "partition_rerun": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag
FROM lineitem""",
    "feed_quarantine": """
SELECT CASE WHEN c_custkey % 10 = 7 THEN 'id' ELSE CAST(c_custkey AS VARCHAR) END AS id,
  CASE c_custkey % 10 WHEN 7 THEN 'created_date' WHEN 3 THEN 'n/a' ELSE '190524' END AS created_date,
  CASE c_custkey % 10 WHEN 7 THEN 'segment' WHEN 0 THEN NULL ELSE c_mktsegment END AS segment,
  CASE c_custkey % 10 WHEN 7 THEN 'header' WHEN 0 THEN 'fields' WHEN 1 THEN 'fields' WHEN 3 THEN 'not a number' ELSE 'kept' END AS verdict
FROM customer""",
    "widened_schema_scan": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1.0::DOUBLE ELSE CAST(o_totalprice AS DOUBLE) END AS o_rank,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN CAST(year(o_orderdate) AS INTEGER) END AS o_year
FROM orders""",
    "write_observed_audit": "SELECT count(*) AS rows_seen, count(*) AS rows_stored, true AS agree FROM lineitem",
}
