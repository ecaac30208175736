"""Query keys of the booking pipeline (feed, base table, keys, match, delta)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import feed_sql as FS
from bindings import inputs
from ratelake.contracts import CREATED_PARTS
from ratelake.functions.casts import compact_date, compact_datetime_text, date_parts, lenient_double, lenient_int
from ratelake.functions.rules import RATE_BUCKET_DEFAULT, RATE_BUCKET_RULES, channel_type, classify, rate_id
from ratelake.functions.text import normalise_id
from ratelake.operators.dedupe import any_per_key, latest_per_key
from ratelake.operators.delta import snapshot_delta
from ratelake.operators.export import CONSUMER_RENAMES, renamed_for_consumer, to_contract
from ratelake.operators.match import match_tiers, resolve_matches
from ratelake.plans import bookings as B
from ratelake.plans.snapshots import carry_latest, publish_snapshot
from ratelake.session import scratch_path
from ratelake.sources.feeds import (
    compact_date_partition_parts,
    drop_bad_rows,
    quarantine_bad_rows,
    read_delimited_feed,
    rename_columns,
    schema_from_json,
)
from ratelake.sources.parquet import read_evolved, read_parquet
from ratelake.sources.sinks import (
    materialize,
    overwrite_partitions,
    save_as_table,
    staged_overwrite,
    write_observed,
    write_parquet,
    written_rows,
)
from ratelake.sources.versions import publish
from ratelake.contracts import FEED_RENAMES

RUN_DATE = "2002-01-15"
YESTERDAY = "2002-01-14"
FACTS_FROM = "1996-01-01"
EXPORT_ROWS = 100_000


# -- feed and base table -----------------------------------------------------

def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed after the ingest filters (in memory, no text round trip)."""
    feed = inputs.booking_feed(spark, sf_dir)
    feed = rename_columns(drop_bad_rows(feed, "created_date"), FEED_RENAMES)
    y, m, d = compact_date_partition_parts("created_date")
    return feed.withColumns({CREATED_PARTS[0]: y, CREATED_PARTS[1]: m, CREATED_PARTS[2]: d})


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.base_projection(_raw(spark, sf_dir))


def _export(feed: DataFrame, path: str, packed: str = "lz4") -> None:
    """Feed rows as tab-separated files: packed, and short, as packed files are read whole."""
    feed.write.mode("overwrite").option("maxRecordsPerFile", EXPORT_ROWS).csv(
        path, sep="\t", header=True, nullValue="\\N", compression=packed,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def feed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed written as two tab-separated exports (``\\N`` nulls), read back."""
    feed = inputs.booking_feed(spark, sf_dir)
    root = scratch_path(spark, "feed")
    recent = F.col("created_date") >= F.lit("99")
    for sub, cond in (("daily", recent), ("history", ~recent | F.col("created_date").isNull())):
        _export(feed.filter(cond), f"{root}/{sub}")
    # The feed's schema document (JSON), as shipped next to the exports.
    schema_doc = B.feed_schema(FS.FEED_NAMES).json()
    schema = schema_from_json(schema_doc)
    return B.ingest_feed(spark, [f"{root}/daily/*.csv.lz4", f"{root}/history/*.csv.lz4"], schema)


def feed_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed, landed as two daily drops and ingested incrementally."""
    from ratelake.streaming import ingest_new_feed_files

    feed = inputs.booking_feed(spark, sf_dir)
    root = scratch_path(spark, "feed_stream")
    raw, ckpt = f"{root}/raw", f"{root}/checkpoint"
    recent = F.col("created_date") >= F.lit("99")
    for day, cond in (("day1", ~recent | F.col("created_date").isNull()), ("day2", recent)):
        # each day's drop lands, then that day's run picks up only new files
        # (Drops stay where they landed, beside the raw stage: packed closer than fast.)
        _export(feed.filter(cond), f"{root}/landing/{day}", packed="gzip")
        ingest_new_feed_files(spark, f"{root}/landing/*", FS.FEED_NAMES, raw, ckpt, file_glob="*.csv.gz")
    # Read back with the text schema, so '05' stays '05' (no partition type
    # inference); an empty day is stored as the default partition (NULL).
    schema = B.feed_schema([*[n for n in FS.FEED_NAMES], *CREATED_PARTS])
    schema = rename_columns(spark.createDataFrame([], schema), FEED_RENAMES).schema
    return spark.read.schema(schema).parquet(raw)


def base_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir)


def parse_compact_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return raw.select(
        "confirmation_ref",
        compact_date("date_in").alias("date_in"),
        compact_date("date_out").alias("date_out"),
        compact_date("created_date").alias("created_date"),
        compact_datetime_text("cancel_datetime").alias("cancel_datetime"),
        compact_datetime_text("booking_start_dttm").alias("booking_st_tm"),
        compact_datetime_text("lastmodified_datetime").alias("lastmodified_datetime"),
    )


def date_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, m, d = date_parts("o_orderdate")
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", y.alias("order_year"), m.alias("order_month"), d.alias("order_day"))


_TYPED = {
    "rateperday_amount": "double",
    "rateperday_gbp": "double",
    "rateperday_lcc": "double",
    "totalamount_gbp": "double",
    "totalamount_usd": "double",
    "totalamount_lcc": "double",
    "step0_time": "int",
    "step1_time": "int",
    "step2_time": "int",
    "step3_time": "int",
    "step4_time": "int",
    "hotel_total": "int",
}


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    cols = [lenient_double(c).alias(c) if t == "double" else lenient_int(c).alias(c) for c, t in _TYPED.items()]
    return raw.select("confirmation_ref", *cols)


def normalise_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return raw.select(
        "confirmation_ref",
        F.col("traveller_portrait_guid").alias("raw_guid"),
        normalise_id("traveller_portrait_guid").alias("traveller_portrait_guid"),
    )


def channel_type_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return raw.select("confirmation_ref", "content_source", "gds_shopped_for_rate", channel_type().alias("channel_type"))


def rate_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return raw.select(
        "confirmation_ref",
        rate_id("hotelhub_property_id", "rate_access_code_booked", "booked_rate_type_code", channel_type()).alias("rate_id"),
    )


def rate_bucket_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    out = classify(raw, RATE_BUCKET_RULES, RATE_BUCKET_DEFAULT, "new_rate_bucket")
    return out.select(
        "confirmation_ref",
        "content_source",
        "rate_bucket",
        "rate_access_code_booked",
        "rate_description",
        "gds_commission_text",
        "client_client_top_name",
        "new_rate_bucket",
    )


# Roles of the rate-bucket table mapped onto the documents table.
DOCUMENT_ROLES = {
    "content_source": "source",
    "rate_bucket": "lang",
    "rate_access_code_booked": "no_code",
    "rate_description": "text",
    "gds_commission_text": "no_commission",
    "client_client_top_name": "no_client",
}


def rate_bucket_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domain rule table over whole document texts (four languages)."""
    docs = inputs.table(spark, sf_dir, "documents").withColumns(
        {c: F.lit(None).cast("string") for c in ("no_code", "no_commission", "no_client")}
    )
    out = classify(docs, RATE_BUCKET_RULES, RATE_BUCKET_DEFAULT, "new_rate_bucket", columns=DOCUMENT_ROLES)
    return out.select("doc_id", "lang", "source", "new_rate_bucket")


def sql_view_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"raw_feed_{uuid.uuid4().hex[:8]}"
    _raw(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(
        f"""
        SELECT booking_status, hotelhub_booking_ref, confirmation_ref,
               CAST(nights AS INT) AS nights, upper(content_source) AS content_source,
               date_created_year, date_created_month, date_created_day
        FROM {view}
        WHERE booking_status IN ('CFD', 'CNX')
        """
    )


# -- dedupe and keys -----------------------------------------------------------

def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = B.latest_bookings(base(spark, sf_dir))
    return latest.select("hotelhub_booking_ref", "lastmodified_datetime", "confirmation_ref")


def latest_per_key_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = inputs.table(spark, sf_dir, "lineitem")
    top = latest_per_key(li, ["l_orderkey"], [("l_shipdate", "desc")], ties="all", rank_column="rk")
    return top.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "rk")


def any_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = inputs.table(spark, sf_dir, "events")
    one = any_per_key(ev, ["user_id", "event_type"], tie_break=[("event_id", "asc")])
    return one.select("user_id", "event_type", "event_id", "ts")


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.latest_bookings(base(spark, sf_dir))


def match_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = B.with_match_keys(_latest(spark, sf_dir))
    return keyed.select("confirmation_ref", "full_mk", "prop_mk", "pnr_mk")


def dedupe_key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = B.keyed_bookings(_latest(spark, sf_dir))
    return keyed.select("confirmation_ref", "hotelhub_booking_ref", "dedupe_key", "lastmodified_datetime", "rk", "row_num")


# -- warehouse mapping, match, delta ---------------------------------------------

def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = inputs.star_schema(spark, sf_dir)
    return B.dwh_mapping(
        star["fact_hotel"], star["dim_booking"], star["dim_supplier"], star["dim_traveler_profile"], star["dim_location"],
        start_from=FACTS_FROM,
    )


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.keyed_from_raw(_staged(_raw(spark, sf_dir), "raw"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    # Stage barrier, as between the jobs of the pipeline: later stages start
    # from files on shared storage with a short plan.
    return materialize(df, scratch_path(df.sparkSession, name))


def keyed_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(keyed(spark, sf_dir), "keyed")


def mapping_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(mapping(spark, sf_dir), "mapping")


def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = match_tiers(keyed_staged(spark, sf_dir), mapping_staged(spark, sf_dir))
    return tiers.select(
        "hotelhub_booking_ref", "confirmation_ref", "lastmodified_datetime", "full_mk", "prop_mk", "pnr_mk",
        "match_level", "candidate_facts",
    )


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_matches(
        keyed_staged(spark, sf_dir), mapping_staged(spark, sf_dir), tie_break=B.DEFAULT_BOOKING_TIE_BREAK, stored=True
    )


def match_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).select(
        "hotelhub_booking_ref", "confirmation_ref", "lastmodified_datetime", "pnr_mk",
        "fact_hotel_id", "emulation_flag", "match_level", "device_type", "rk_f", "rnk_f",
    )


def yesterday_snapshot(today: DataFrame) -> DataFrame:
    """Yesterday's published table, derived from today's rows: FURNITURE-segment
    bookings are new today, bookings with access code SC had another bucket
    yesterday, SABRE bookings also had a booking since gone."""
    y = today.filter(F.col("client_booking_channel").isNull() | (F.col("client_booking_channel") != "OFFLINE"))
    y = y.withColumn(
        "new_rate_bucket",
        F.when(F.col("rate_access_code_booked") == "SC", F.lit("OLD BUCKET")).otherwise(F.col("new_rate_bucket")),
    )
    gone = today.filter(F.col("content_source") == "SABRE").withColumns(
        {"pnr_mk": F.concat(F.col("pnr_mk"), F.lit("OLD")), "confirmation_ref": F.concat(F.col("confirmation_ref"), F.lit("-OLD"))}
    )
    y = y.unionByName(gone).withColumns(
        {"dl_last_modified_date": F.lit(YESTERDAY).cast("date"), "rk": F.lit(1), "rk_f": F.lit(1)}
    )
    return to_contract(y)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = _staged(resolved(spark, sf_dir), "matched")
    yesterday = _staged(yesterday_snapshot(today), "yesterday")
    return snapshot_delta(today, yesterday, RUN_DATE, stored=("today", "yesterday"))


def snapshot_delta_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(spark, sf_dir)


def consumer_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish via a staging path, then the consumer copy with renamed columns."""
    root = scratch_path(spark, "publish")
    published = staged_overwrite(snapshot(spark, sf_dir), f"{root}/snapshot", f"{root}/staging")
    write_parquet(renamed_for_consumer(published, CONSUMER_RENAMES), f"{root}/consumer")
    return spark.read.parquet(f"{root}/consumer")


# -- sources and sinks -------------------------------------------------------------

def merge_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    root = scratch_path(spark, "orders_evolving")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    write_parquet(orders.filter(early), f"{root}/part=old")
    write_parquet(orders.filter(~early).withColumn("o_priority_rank", F.substring("o_orderpriority", 1, 1).cast("int")), f"{root}/part=new")
    merged = read_parquet(spark, root, merge_schema=True)
    return merged.drop("part")


def table_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inputs.table(spark, sf_dir, "customer")
    name = f"customer_copy_{uuid.uuid4().hex[:8]}"
    save_as_table(customer, name, scratch_path(spark, name), partition_by=["c_mktsegment"])
    return spark.table(name)


def staged_overwrite_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = inputs.table(spark, sf_dir, "supplier")
    root = scratch_path(spark, "supplier_snapshot")
    write_parquet(supplier, f"{root}/current")
    current = spark.read.parquet(f"{root}/current")
    # The new snapshot reads the path it replaces.
    updated = current.withColumn("s_acctbal", F.round(F.col("s_acctbal") * 2, 2))
    return staged_overwrite(updated, f"{root}/current", f"{root}/staging")


def write_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = inputs.table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "lineitem_by_flag")
    write_parquet(li, path, partition_by=["l_returnflag", "l_linestatus"])
    return written_rows(spark, path)


def _pipeline_inputs(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """The feed as text files and the star schema as Parquet under ``root``."""
    _export(inputs.booking_feed(spark, sf_dir), f"{root}/incoming")
    star_paths = {}
    for name, df in inputs.star_schema(spark, sf_dir).items():
        star_paths[name] = f"{root}/dwh/{name}"
        write_parquet(df, star_paths[name])
    return star_paths


def _run_pipeline(spark: SparkSession, root: str, star_paths: dict[str, str], **options) -> DataFrame:
    return B.run_booking_pipeline(
        spark, feed_paths=[f"{root}/incoming/*.csv.lz4"], star_paths=star_paths, root=f"{root}/stages",
        facts_from=FACTS_FROM, **{"feed_columns": FS.FEED_NAMES, "run_date": RUN_DATE, **options},
    )


def booking_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run: nothing published yet."""
    root = scratch_path(spark, "pipeline")
    tag = uuid.uuid4().hex[:8]
    tables = {"keyed": f"keyed_bookings_{tag}", "consumer": f"consumer_bookings_{tag}"}
    return _run_pipeline(spark, root, _pipeline_inputs(spark, sf_dir, root), tables=tables)


def booking_pipeline_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one feed, published in versions; the second keeps what it finds."""
    root = scratch_path(spark, "pipeline_versions")
    star_paths = _pipeline_inputs(spark, sf_dir, root)
    options = {"stage_parts": CREATED_PARTS[:1], "publish_buckets": 32}
    _run_pipeline(spark, root, star_paths, run_date=YESTERDAY, **options)
    return _run_pipeline(spark, root, star_paths, **options)


def booking_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run on what an earlier day published, tables included.

    The feed comes with its schema document. Day one publishes; what it
    published is then set to yesterday's state, and day two finds it by
    default at the publish path and replaces it.
    """
    root = scratch_path(spark, "two_days")
    tag = uuid.uuid4().hex[:8]
    options = {
        "feed_columns": B.feed_schema(FS.FEED_NAMES).json(),
        "tables": {"published": f"published_bookings_{tag}", "staging": f"staged_bookings_{tag}"},
        "stage_parts": CREATED_PARTS[:1],
    }
    star_paths = _pipeline_inputs(spark, sf_dir, root)
    _run_pipeline(spark, root, star_paths, run_date=YESTERDAY, **options)
    today = spark.read.parquet(f"{root}/stages/matched")
    staged_overwrite(yesterday_snapshot(today), f"{root}/stages/published", f"{root}/yesterday")
    return _run_pipeline(spark, root, star_paths, **options)


def stage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts the pipeline stores for its stages (those before publishing)."""
    root = scratch_path(spark, "audited")
    _run_pipeline(spark, root, _pipeline_inputs(spark, sf_dir, root), stage_parts=CREATED_PARTS[:1])
    audit = spark.read.parquet(f"{root}/stages/audit")
    return audit.where(F.col("stage").isin("raw", "base", "keyed", "mapping", "matched")).select("stage", "rows")


def load_date_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot delta without a run date: rows are loaded on the current date."""
    today = _staged(resolved(spark, sf_dir), "matched")
    out = snapshot_delta(today, yesterday_snapshot(today).limit(0), stored=["today"])
    days = F.date_diff(F.current_date(), F.col("dl_last_modified_date"))
    return out.select("pnr_mk", "confirmation_ref", days.alias("days_since_load"))


def match_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings equal but for the column that is NULL, and facts with two mapping rows."""
    c = inputs.table(spark, sf_dir, "customer")
    name = F.concat(F.lit("X"), F.col("c_custkey").cast("string"))
    mk = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("P"), (F.col("c_custkey") % 50).cast("string")))
    none = F.lit(None).cast("string")
    sides = F.explode(F.array(F.struct(name.alias("ref"), none.alias("confirmation_ref")), F.struct(none.alias("ref"), name.alias("confirmation_ref"))))
    rows = c.select(sides.alias("s"), mk.alias("pnr_mk")).select("s.*", "pnr_mk").withColumns(
        {"full_mk": none, "prop_mk": none, "client_booking_channel": none, "changed": F.lit(1)}
    )
    supplier = inputs.table(spark, sf_dir, "supplier")
    facts = supplier.select(
        F.col("s_suppkey").cast("decimal(10,0)").alias("fact_hotel_id"),
        F.concat(F.lit("P"), (F.col("s_suppkey") % 50).cast("string")).alias("pnr_mk"),
        F.explode(F.array(F.lit("Y"), F.lit("N"))).alias("emulation_flag"),
    ).withColumns({"full_mk": none, "prop_mk": none, "traveler_guid": F.lit("G"), "harp_key": F.lit("H")})
    out = resolve_matches(rows, facts, ref="ref", order=["changed"], tie_break=[("confirmation_ref", "desc"), ("ref", "desc")])
    return out.select("ref", "confirmation_ref", "pnr_mk", "fact_hotel_id", "emulation_flag", "match_level")


def binary_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text stored as plain BINARY columns reads as strings."""
    c = inputs.table(spark, sf_dir, "customer")
    path = scratch_path(spark, "binary_text")
    write_parquet(
        c.select("c_custkey", F.col("c_name").cast("binary").alias("name_text"), F.col("c_mktsegment").cast("binary").alias("segment_text")), path
    )
    return read_parquet(spark, path, binary_as_string=True)


# -- tables carried from day to day --------------------------------------------------

def snapshot_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of the versioned snapshot: on the second one every 16th key has
    another bucket value, and only the buckets of those keys are read and written."""
    today = _staged(resolved(spark, sf_dir), "matched")
    changed = F.substring(F.md5(F.col("pnr_mk").cast("binary")), 1, 1) == "0"
    before = today.withColumn("new_rate_bucket", F.when(changed, F.lit("OLD BUCKET")).otherwise(F.col("new_rate_bucket")))
    root = scratch_path(spark, "snapshots")
    publish_snapshot(before, root, YESTERDAY, buckets=64, stored=True)
    return publish_snapshot(today, root, RUN_DATE, stored=True)


def latest_state_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row per booking, carried over three days of feed rows."""
    rows = _staged(base(spark, sf_dir).select("hotelhub_booking_ref", "lastmodified_datetime", "confirmation_ref", "sessionid"), "base")
    day = F.pmod(F.crc32(F.coalesce("confirmation_ref", F.lit("")).cast("binary")), F.lit(3))
    root = scratch_path(spark, "latest")
    for d in range(3):
        state = carry_latest(
            rows.where(day == d), root, ["hotelhub_booking_ref"], ["lastmodified_datetime"], B.DEFAULT_BOOKING_TIE_BREAK, buckets=16
        )
    return state.drop("sessionid")


def versioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new version computed from the one it replaces."""
    root = scratch_path(spark, "supplier_versions")
    current = publish(inputs.table(spark, sf_dir, "supplier"), root)
    return publish(current.withColumn("s_acctbal", F.round(F.col("s_acctbal") * 2, 2)), root)


def partition_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition of a written table is run again with other rows."""
    li = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = scratch_path(spark, "lineitem_rerun")
    write_parquet(li, path, partition_by=["l_returnflag"])
    overwrite_partitions(li.where("l_returnflag = 'R'").withColumn("l_quantity", F.col("l_quantity") + 1), path, ["l_returnflag"])
    return spark.read.parquet(path)


def feed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a damaged export, kept or quarantined with its reason."""
    c = inputs.table(spark, sf_dir, "customer")
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 10
    created = F.when(kind == 3, F.lit("n/a")).otherwise(F.lit("190524"))
    line = (
        F.when(kind == 0, F.concat_ws("\t", key, created))
        .when(kind == 1, F.concat_ws("\t", key, created, "c_mktsegment", F.lit("more")))
        .when(kind == 7, F.concat_ws("\t", F.lit("id"), F.lit("created_date"), F.lit("segment")))
        .otherwise(F.concat_ws("\t", key, created, "c_mktsegment"))
    )
    root = scratch_path(spark, "damaged")
    c.select(line.alias("value")).write.text(f"{root}/lines")
    schema = B.feed_schema(["id", "created_date", "segment"])
    raw = read_delimited_feed(spark, f"{root}/lines", schema, header=False, corrupt_column="_line")
    kept, bad = quarantine_bad_rows(raw, "created_date", f"{root}/judged")
    return kept.select("id", "created_date", "segment", F.lit("kept").alias("verdict")).unionByName(
        bad.select("id", "created_date", "segment", F.col("reason").alias("verdict"))
    )


def widened_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of orders: the later one has wider types and a column more."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    root = scratch_path(spark, "orders_widened")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    narrow = {"o_orderkey": F.col("o_orderkey").cast("int"), "o_custkey": F.col("o_custkey").cast("int")}
    write_parquet(orders.filter(early).withColumns(narrow).withColumn("o_rank", F.lit(1).cast("int")), f"{root}/old")
    later = orders.filter(~early).withColumn("o_year", F.year("o_orderdate"))
    write_parquet(later.withColumn("o_rank", F.col("o_totalprice").cast("double")), f"{root}/new")
    return read_evolved(spark, f"{root}/old", f"{root}/new")


def write_observed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = inputs.table(spark, sf_dir, "lineitem")
    return write_observed(li, scratch_path(spark, "lineitem_observed"), partition_by=["l_linestatus"])


BOOKING_QUERIES = {
    "feed_ingest": feed_ingest,
    "feed_ingest_stream": feed_ingest_stream,
    "base_projection": base_projection,
    "parse_compact_dates": parse_compact_dates,
    "date_parts": date_parts_query,
    "typed_casts": typed_casts,
    "normalise_id": normalise_id_query,
    "channel_type": channel_type_query,
    "rate_id": rate_id_query,
    "rate_bucket_rules": rate_bucket_rules,
    "rate_bucket_documents": rate_bucket_documents,
    "sql_view_projection": sql_view_projection,
    "latest_per_key": latest_per_key_query,
    "latest_per_key_ties": latest_per_key_ties,
    "any_per_key": any_per_key_query,
    "match_keys": match_keys_query,
    "dedupe_key_hash": dedupe_key_hash,
    "dwh_mapping": mapping,
    "match_cascade": match_cascade,
    "match_resolve": match_resolve,
    "snapshot_delta": snapshot_delta_query,
    "consumer_export": consumer_export,
    "merge_schema_scan": merge_schema_scan,
    "table_sink_roundtrip": table_sink_roundtrip,
    "staged_overwrite": staged_overwrite_query,
    "write_audit": write_audit,
    "booking_pipeline": booking_pipeline,
    "booking_two_days": booking_two_days,
    "booking_pipeline_versions": booking_pipeline_versions,
    "stage_audit": stage_audit,
    "load_date_default": load_date_default,
    "match_null_rows": match_null_rows,
    "binary_text_scan": binary_text_scan,
    "snapshot_buckets": snapshot_buckets,
    "latest_state_days": latest_state_days,
    "versioned_publish": versioned_publish,
    "partition_rerun": partition_rerun,
    "feed_quarantine": feed_quarantine,
    "widened_schema_scan": widened_schema_scan,
    "write_observed_audit": write_observed_audit,
}
