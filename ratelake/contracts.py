"""Column contracts of the booking feed, its typed base table and the export.

Fixed values: names, order and types below must equal the published contract
of the booking data (downstream consumers read these columns by name).
One column per line.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Base projection of the raw feed, in output order.
#   (output name, kind, source column of the raw feed)
# kinds: pass (as read) | double | int | date (yyMMdd → timestamp)
#        | dtext (yyMMdd HH:mm:ss → canonical text, '' kept) | guid (normalised id)
#        | rate_id | rate_bucket | channel (classifiers, computed)
# ---------------------------------------------------------------------------
BASE_PROJECTION: list[tuple[str, str, str]] = [
    ("booking_status", "pass", "booking_status"),
    ("hotelhub_booking_ref", "pass", "hotelhub_booking_ref"),
    ("confirmation_ref", "pass", "confirmation_ref"),
    ("cancellation_ref", "pass", "cancellation_ref"),
    ("pnr", "pass", "pnr"),
    ("pnr_type", "pass", "pnr_type"),
    ("hotelhub_mode", "pass", "hotelhub_mode"),
    ("market", "pass", "market"),
    ("client_client_top_name", "pass", "client_client_top_name"),
    ("client_sub_unit_client_name", "pass", "client_sub_unit_client_name"),
    ("customer_agency_name", "pass", "customer_agency_name"),
    ("hotel_name", "pass", "hotel_name"),
    ("city", "pass", "city"),
    ("country", "pass", "country"),
    ("star_rating", "pass", "star_rating"),
    ("date_in", "date", "date_in"),
    ("date_out", "date", "date_out"),
    ("nights", "pass", "nights"),
    ("num_of_rooms", "pass", "num_of_rooms"),
    ("num_of_guest", "pass", "num_of_guest"),
    ("out_policy_reason", "pass", "out_policy_reason"),
    ("booking_source", "pass", "booking_source"),
    ("rate_description", "pass", "rate_description"),
    ("cancellation_policy", "pass", "cancellation_policy"),
    ("rateperday_amount", "double", "rateperday_amount"),
    ("rateperday_currcode", "pass", "rateperday_currcode"),
    ("agency_priority", "pass", "agency_priority"),
    ("customer_priority", "pass", "customer_priority"),
    ("payment_mode", "pass", "payment_mode"),
    ("rateperday_eur", "double", "rateperday_eur"),
    ("rateperday_gbp", "double", "rateperday_gbp"),
    ("rateperday_usd", "double", "rateperday_usd"),
    ("totalamount_booked_currcode", "pass", "totalamount_booked_currcode"),
    ("totalamount_booked", "pass", "totalamount_booked"),
    ("local_currency_code", "pass", "local_currency_code"),
    ("rateperday_lcc", "double", "rateperday_lcc"),
    ("totalamount_eur", "double", "totalamount_eur"),
    ("totalamount_gbp", "double", "totalamount_gbp"),
    ("totalamount_usd", "double", "totalamount_usd"),
    ("totalamount_lcc", "double", "totalamount_lcc"),
    ("booked_rate_type_code", "pass", "booked_rate_type_code"),
    ("content_source", "pass", "content_source"),
    ("gds_chain_name", "pass", "gds_chain_name"),
    ("created_date", "date", "created_date"),
    ("createdby_user", "pass", "createdby_user"),
    ("confirmedby_user", "pass", "confirmedby_user"),
    ("cancel_datetime", "dtext", "cancel_datetime"),
    ("abandon_by_user", "pass", "abandon_by_user"),
    ("obt_pnr", "pass", "obt_pnr"),
    ("client_booking_channel", "pass", "client_booking_channel"),
    ("rate_access_code_booked", "pass", "rate_access_code_booked"),
    ("commission_type", "pass", "commission_type"),
    ("commission_currency", "pass", "commission_currency"),
    ("commission_amount", "pass", "commission_amount"),
    ("estimated_income_due", "pass", "estimated_income_due"),
    ("rate_access_code_shopped", "pass", "rate_access_code_shopped"),
    ("hotelhub_property_id", "pass", "hotelhub_property_id"),
    ("harp_property_id_no", "pass", "harp_property_id_no"),
    ("content_source_property_id", "pass", "content_source_property_id"),
    ("aggregator_booking_commission", "pass", "aggregator_booking_commission"),
    ("aggregator_revenue_value", "pass", "aggregator_revenue_value"),
    ("aggregator_revenue_share", "pass", "aggregator_revenue_share"),
    ("aggregator_currency", "pass", "aggregator_currency"),
    ("rate_change", "pass", "rate_change"),
    ("rate_access_code_returned", "pass", "rate_access_code_returned"),
    ("back_office_account_number", "pass", "back_office_account_number"),
    ("traveller_portrait_guid", "guid", "traveller_portrait_guid"),
    ("booking_st_tm", "dtext", "booking_start_dttm"),
    ("booking_en_tm", "dtext", "booking_end_dttm"),
    ("step0_time", "int", "step0_time"),
    ("step1_time", "int", "step1_time"),
    ("step2_time", "int", "step2_time"),
    ("step3_time", "int", "step3_time"),
    ("step4_time", "int", "step4_time"),
    ("gds_shopped_for_rate", "pass", "gds_shopped_for_rate"),
    ("cheap_client_neg_rate", "int", "cheap_client_neg_rate"),
    ("cheap_client_neg_rate_currcode", "pass", "cheap_client_neg_rate_currcode"),
    ("cheap_client_neg_rate_description", "pass", "cheap_client_neg_rate_description"),
    ("cheap_client_or_cwv_rate", "int", "cheap_client_or_cwv_rate"),
    ("cheap_client_or_cwv_neg_rate_currcode", "pass", "cheap_client_or_cwv_neg_rate_currcode"),
    ("cheap_client_or_cwv_rate_description", "pass", "cheap_client_or_cwv_rate_description"),
    ("cheap_gds_published_rate", "int", "cheap_gds_published_rate"),
    ("cheap_gds_neg_rate_currcode", "pass", "cheap_gds_neg_rate_currcode"),
    ("cheap_gds_published_rate_description", "pass", "cheap_gds_published_rate_description"),
    ("cheap_bookingcom_rate", "int", "cheap_bookingcom_rate"),
    ("cheap_bookingcom_rate_currcode", "pass", "cheap_bookingcom_rate_currcode"),
    ("cheap_bookingcom_rate_description", "pass", "cheap_bookingcom_rate_description"),
    ("branch_iata", "pass", "branch_iata"),
    ("on_request_indicator", "pass", "on_request_indicator"),
    ("lastmodified_datetime", "dtext", "lastmodified_datetime"),
    ("modified_count", "pass", "modified_count"),
    ("booking_time_duration", "pass", "booking_time_duration"),
    ("rate_bucket", "pass", "rate_bucket"),
    ("back_office", "pass", "back_office"),
    ("client_sub_unit_client_id", "pass", "client_sub_unit_client_id"),
    ("missed_saving", "int", "missed_saving"),
    ("realised_saving", "int", "realised_saving"),
    ("popular_hotel", "pass", "popular_hotel"),
    ("hotel_rank", "pass", "hotel_rank"),
    ("hotel_total", "int", "hotel_total"),
    ("agency_source_name", "pass", "agency_source_name"),
    ("client_client_top_id", "pass", "client_client_top_id"),
    ("err_desc", "pass", "err_desc"),
    ("aggregator_property_type", "pass", "aggregator_property_type"),
    ("hotel_bucket_simplified", "pass", "hotel_bucket_simplified"),
    ("gds_commission_text", "pass", "gds_commission_text"),
    ("avlb_htl_count", "pass", "avlb_htl_count"),
    ("offer", "pass", "offer"),
    ("aaa_rate", "pass", "aaa_rate"),
    ("error_code", "pass", "error_code"),
    ("rate_id", "rate_id", "rate_id"),
    ("new_rate_bucket", "rate_bucket", "new_rate_bucket"),
    ("payment_type_used", "pass", "payment_type_used"),
    ("channel_type", "channel", "channel_type"),
    ("sessionid", "pass", "sessionid"),
    ("date_created_year", "int", "date_created_year"),
    ("date_created_month", "int", "date_created_month"),
    ("date_created_day", "int", "date_created_day"),
]

# ---------------------------------------------------------------------------
# Renames applied at ingest (feed name → stored name).
# ---------------------------------------------------------------------------
FEED_RENAMES = {
    "CHEAP_AGGREGATOR_RATE": "CHEAP_BOOKINGCOM_RATE",
    "CHEAP_AGGREGATOR_RATE_CURRCODE": "CHEAP_BOOKINGCOM_RATE_CURRCODE",
    "CHEAP_AGGREGATOR_RATE_DESCRIPTION": "CHEAP_BOOKINGCOM_RATE_DESCRIPTION",
    "DERIVED_COMMISSION%": "DERIVED_COMMISSION",
}
CREATED_PARTS = ["date_created_year", "date_created_month", "date_created_day"]

# ---------------------------------------------------------------------------
# Export contract, in order: (name, type or None). A type means an
# explicit cast, ``null:<type>`` a typed NULL column.
# ---------------------------------------------------------------------------
EXPORT_CONTRACT: list[tuple[str, str | None]] = [
    ("booking_status", None),
    ("hotelhub_booking_ref", None),
    ("confirmation_ref", None),
    ("cancellation_ref", None),
    ("pnr", None),
    ("pnr_type", None),
    ("hotelhub_mode", None),
    ("market", None),
    ("client_client_top_name", None),
    ("client_sub_unit_client_name", None),
    ("customer_agency_name", None),
    ("hotel_name", None),
    ("city", None),
    ("country", None),
    ("star_rating", None),
    ("date_in", None),
    ("date_out", None),
    ("nights", "string"),
    ("num_of_rooms", "string"),
    ("num_of_guest", "string"),
    ("out_policy_reason", None),
    ("booking_source", None),
    ("rate_description", None),
    ("cancellation_policy", None),
    ("rateperday_amount", None),
    ("rateperday_currcode", None),
    ("agency_priority", "string"),
    ("customer_priority", "string"),
    ("payment_mode", None),
    ("rateperday_eur", None),
    ("rateperday_gbp", None),
    ("rateperday_usd", None),
    ("totalamount_booked_currcode", None),
    ("totalamount_booked", "string"),
    ("local_currency_code", None),
    ("rateperday_lcc", None),
    ("totalamount_eur", None),
    ("totalamount_gbp", None),
    ("totalamount_usd", None),
    ("totalamount_lcc", None),
    ("booked_rate_type_code", None),
    ("content_source", None),
    ("gds_chain_name", None),
    ("created_date", None),
    ("createdby_user", None),
    ("confirmedby_user", None),
    ("cancel_datetime", "timestamp"),
    ("abandon_by_user", None),
    ("obt_pnr", None),
    ("client_booking_channel", None),
    ("rate_access_code_booked", None),
    ("commission_type", None),
    ("commission_currency", None),
    ("commission_amount", "string"),
    ("estimated_income_due", "string"),
    ("rate_access_code_shopped", None),
    ("hotelhub_property_id", None),
    ("harp_property_id_no", "string"),
    ("content_source_property_id", None),
    ("aggregator_booking_commission", "string"),
    ("aggregator_revenue_value", "string"),
    ("aggregator_revenue_share", "string"),
    ("aggregator_currency", None),
    ("rate_change", None),
    ("rate_access_code_returned", None),
    ("back_office_account_number", None),
    ("traveller_portrait_guid", None),
    ("booking_st_tm", "timestamp"),
    ("booking_en_tm", "timestamp"),
    ("step0_time", None),
    ("step1_time", None),
    ("step2_time", None),
    ("step3_time", None),
    ("step4_time", None),
    ("gds_shopped_for_rate", None),
    ("cheap_client_neg_rate", None),
    ("cheap_client_neg_rate_currcode", None),
    ("cheap_client_neg_rate_description", None),
    ("cheap_client_or_cwv_rate", None),
    ("cheap_client_or_cwv_neg_rate_currcode", None),
    ("cheap_client_or_cwv_rate_description", None),
    ("cheap_gds_published_rate", None),
    ("cheap_gds_neg_rate_currcode", None),
    ("cheap_gds_published_rate_description", None),
    ("cheap_bookingcom_rate", None),
    ("cheap_bookingcom_rate_currcode", None),
    ("cheap_bookingcom_rate_description", None),
    ("branch_iata", "string"),
    ("on_request_indicator", None),
    ("lastmodified_datetime", "timestamp"),
    ("modified_count", "string"),
    ("booking_time_duration", None),
    ("rate_bucket", None),
    ("back_office", None),
    ("client_sub_unit_client_id", None),
    ("missed_saving", None),
    ("realised_saving", None),
    ("popular_hotel", "string"),
    ("hotel_rank", None),
    ("hotel_total", None),
    ("agency_source_name", None),
    ("client_client_top_id", None),
    ("err_desc", None),
    ("aggregator_property_type", None),
    ("hotel_bucket_simplified", "string"),
    ("gds_commission_text", None),
    ("avlb_htl_count", "string"),
    ("offer", None),
    ("aaa_rate", None),
    ("error_code", None),
    ("rate_id", None),
    ("new_rate_bucket", None),
    ("payment_type_used", None),
    ("channel_type", None),
    ("rw_num", "null:bigint"),
    ("nrk", "null:bigint"),
    ("full_mk", None),
    ("prop_mk", None),
    ("pnr_mk", None),
    ("row_num", "smallint"),
    ("dedupe_key", "bigint"),
    ("rk", "bigint"),
    ("fact_hotel_id", None),
    ("emulation_flag", None),
    ("match_level", "tinyint"),
    ("rk_f", "bigint"),
    ("rnk_f", "null:bigint"),
    ("device_type", None),
    ("dl_last_modified_date", "timestamp"),
]

# Raw feed columns (lower case) read by the base projection, plus the renamed
# and derived ones; the computed classifier outputs are not feed columns.
_COMPUTED_KINDS = {"rate_id", "rate_bucket", "channel"}
FEED_COLUMNS: list[str] = [src for _, kind, src in BASE_PROJECTION if kind not in _COMPUTED_KINDS and src not in CREATED_PARTS]
