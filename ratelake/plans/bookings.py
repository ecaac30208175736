"""Booking pipeline: ingest → typed base → latest per booking → match keys →
warehouse mapping → tiered match → snapshot delta → publish.

Stages communicate through Parquet datasets (``run_booking_pipeline``), so
each stage restarts from files and a lost executor never recomputes earlier
stages; every function below is also usable on its own, on DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.contracts import BASE_PROJECTION, CREATED_PARTS, FEED_RENAMES
from ratelake.functions.casts import (
    compact_date,
    compact_datetime_text,
    date_parts,
    int_of_integral_text,
    integral_text,
    lenient_double,
)
from ratelake.functions.keys import booking_locator, emulation_flag, hashed_key, match_keys
from ratelake.functions.rules import (
    RATE_BUCKET_DEFAULT,
    RATE_BUCKET_RULES,
    channel_type,
    rate_id,
    rules_column,
)
from ratelake.functions.text import normalise_id
from ratelake.operators.dedupe import OrderSpec, latest_per_key
from ratelake.operators.lookup import Dimension, star_join
from ratelake.operators.stored import PLACE, rows_at, with_place
from ratelake.session import scratch_path
from ratelake.sources.feeds import (
    compact_date_partition_parts,
    drop_bad_rows,
    read_delimited_feed,
    rename_columns,
    schema_from_json,
)
from ratelake.sources.sinks import materialize as store

# Booking statuses kept for matching; fact mapping filters.
MATCHED_STATUSES = ["CFD", "CNX"]
LIVE_SUPPLIER_DATES = ["2000-01-01", "2999-12-31"]
FACT_START_FROM = "2016-01-01"
KEYED_ROW_NUM = 9999
EFFECTIVE_PARTS = ["effective_date_year", "effective_date_month", "effective_date_day"]

DEFAULT_BOOKING_TIE_BREAK: list[OrderSpec] = [("confirmation_ref", "desc"), ("sessionid", "desc")]


def feed_schema(columns: Sequence[str]) -> T.StructType:
    """All-text schema for a delimited feed (typing happens in the base projection)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def ingest_feed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Read the feed files, drop header/torn rows, rename, add created-date parts."""
    raw = read_delimited_feed(spark, paths, schema)
    raw = drop_bad_rows(raw, "created_date")
    raw = rename_columns(raw, FEED_RENAMES)
    y, m, d = compact_date_partition_parts("created_date")
    return raw.withColumns({CREATED_PARTS[0]: y, CREATED_PARTS[1]: m, CREATED_PARTS[2]: d})


def base_projection(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed base table: 118 columns in contract order (lower-case names).

    Amounts read as DOUBLE, counters as INT (legacy truncation), ``yyMMdd``
    dates as timestamps, ``yyMMdd HH:mm:ss`` values as canonical text with the
    empty sentinel kept, traveller ids normalised, and the channel, rate id
    and rate bucket classified by the rule tables. One projection: repeated
    sub-expressions (``lower(rate_description)``, the channel) are evaluated
    once per row by Spark's subexpression elimination. ``carry`` names columns
    of ``raw`` that stay as they are.
    """
    channel = channel_type()
    # The part of a counter that reads as a number, in a projection below: the
    # cast uses it many times.
    counters = {src: f"__i_{src}" for _, kind, src in BASE_PROJECTION if kind == "int"}
    raw = raw.withColumns({tmp: integral_text(src) for src, tmp in counters.items()})
    bucket = rules_column(RATE_BUCKET_RULES, RATE_BUCKET_DEFAULT)
    exprs = []
    for out, kind, src in BASE_PROJECTION:
        if kind == "pass":
            e = F.col(src)
        elif kind == "double":
            e = lenient_double(src)
        elif kind == "int":
            e = int_of_integral_text(counters[src])
        elif kind == "date":
            e = compact_date(src)
        elif kind == "dtext":
            e = compact_datetime_text(src)
        elif kind == "guid":
            e = normalise_id(src)
        elif kind == "channel":
            e = channel
        elif kind == "rate_id":
            e = rate_id("hotelhub_property_id", "rate_access_code_booked", "booked_rate_type_code", channel)
        elif kind == "rate_bucket":
            e = bucket
        else:
            raise ValueError(kind)
        exprs.append(e.alias(out))
    return raw.select(*exprs, *carry)


def latest_bookings(base: DataFrame, tie_break: Sequence[OrderSpec] = DEFAULT_BOOKING_TIE_BREAK) -> DataFrame:
    """One row per booking reference: the last modified (W1)."""
    return latest_per_key(base, ["hotelhub_booking_ref"], ["lastmodified_datetime"], ties="one", tie_break=tie_break)


def latest_stored_bookings(raw: DataFrame, tie_break: Sequence[OrderSpec] = DEFAULT_BOOKING_TIE_BREAK) -> DataFrame:
    """``latest_bookings(base_projection(raw))`` of a raw table read from files.

    The pick is made on its keys alone, the wide rows are neither sorted nor shuffled.
    """
    placed = with_place(raw)
    return base_projection(rows_at(placed, latest_bookings(base_projection(placed, carry=PLACE), tie_break).select(*PLACE)))


def with_match_keys(bookings: DataFrame) -> DataFrame:
    """Bookings that can be matched, with their three keys and hashed dedupe key."""
    b = bookings.filter(F.col("booking_status").isin(MATCHED_STATUSES)).filter(
        F.col("pnr").isNotNull() | F.col("obt_pnr").isNotNull()
    )
    loc = booking_locator("client_booking_channel", "obt_pnr", "pnr")
    keys = match_keys("date_in", "date_out", loc, "harp_property_id_no", "traveller_portrait_guid")
    return b.withColumns(keys).withColumn("dedupe_key", hashed_key("pnr_mk"))


def keyed_bookings(bookings: DataFrame) -> DataFrame:
    """Match-ready bookings: latest per dedupe key, ties kept (W2); ``rk`` = 1."""
    keyed = with_match_keys(bookings)
    latest = latest_per_key(keyed, ["dedupe_key"], ["lastmodified_datetime"], ties="all", rank_column="rk")
    return latest.withColumn("row_num", F.lit(KEYED_ROW_NUM))


def _keyed(latest: DataFrame) -> DataFrame:
    return with_match_keys(latest).withColumns({"rk": F.lit(1), "row_num": F.lit(KEYED_ROW_NUM)})


def keyed_from_stored(latest: DataFrame) -> DataFrame:
    """``keyed_bookings`` of bookings read from files, without shuffling wide rows."""
    placed = with_place(latest)
    return _keyed(rows_at(placed, keyed_bookings(placed).select(*PLACE)))


def keyed_from_raw(raw: DataFrame, tie_break: Sequence[OrderSpec] = DEFAULT_BOOKING_TIE_BREAK) -> DataFrame:
    """``keyed_bookings(latest_bookings(base_projection(raw)))`` of a raw table read from files."""
    placed = with_place(raw)
    latest = latest_bookings(base_projection(placed, carry=PLACE), tie_break)
    return _keyed(base_projection(rows_at(placed, keyed_bookings(latest).select(*PLACE))))


# What the mapping takes from each dimension (columns by their name there).
MAPPING_FACT = {
    **{c: c for c in ("fact_hotel_id", "start_date", "end_date", "effective_date", "dim_booking_id", "dim_supplier_id")},
    "dim_traveler_profile_id": "dim_traveler_profile_id",
    "issuing_country_id": "dim_location_id",
}
MAPPING_DIMENSIONS = {
    "dim_booking": Dimension("dim_booking_id", {"booking_locator": "booking_locator"}, lambda: F.col("booking_locator").isNotNull()),
    "dim_supplier": Dimension("dim_supplier_id", {"harp_key": "harp_key"}, lambda: F.col("discontinue_date").isin(LIVE_SUPPLIER_DATES)),
    "dim_traveler_profile": Dimension("dim_traveler_profile_id", {"traveler_guid": "traveler_guid", "country_code": "trav_country"}),
    "dim_location": Dimension("dim_location_id", {"country_code": "loc_country"}, how="left"),
}


def dwh_mapping(
    fact_hotel: DataFrame,
    dim_booking: DataFrame,
    dim_supplier: DataFrame,
    dim_traveler_profile: DataFrame,
    dim_location: DataFrame,
    start_from: str = FACT_START_FROM,
) -> DataFrame:
    """Fact → dimensions, match keys, latest fact per full key (ties kept)."""
    dims = dict(zip(MAPPING_DIMENSIONS, (dim_booking, dim_supplier, dim_traveler_profile, dim_location)))
    fact = fact_hotel.filter(F.col("start_date") >= F.lit(start_from).cast("timestamp_ntz"))
    fact = fact.select(*[F.col(c).alias(n) for c, n in MAPPING_FACT.items()])
    wide = star_join(fact, dims, MAPPING_DIMENSIONS).withColumn("emulation_flag", emulation_flag("trav_country", "loc_country"))
    keys = match_keys("start_date", "end_date", "booking_locator", "harp_key", "traveler_guid")
    dwh = wide.drop(*[d.key for d in MAPPING_DIMENSIONS.values()]).withColumns(keys)
    newest = [("effective_date", "desc"), ("fact_hotel_id", "desc")]
    latest = latest_per_key(dwh, ["full_mk"], newest, ties="all").distinct()
    return latest.withColumns(dict(zip(EFFECTIVE_PARTS, date_parts("effective_date"))))


def _read_or_empty(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """Yesterday's snapshot; an empty table on the first run (no path yet)."""
    if path:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # a first run
                raise
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return store(none, scratch_path(spark, "no-yesterday"))


def run_booking_pipeline(
    spark: SparkSession,
    feed_paths: Sequence[str],
    feed_columns: Sequence[str] | T.StructType | str,
    star_paths: dict[str, str],
    root: str,
    run_date: str | None = None,
    facts_from: str = FACT_START_FROM,
    yesterday_path: str | None = None,
    publish_path: str | None = None,
    consumer_path: str | None = None,
    tie_break: Sequence[OrderSpec] = DEFAULT_BOOKING_TIE_BREAK,
    tables: dict[str, str] | None = None,
    stage_parts: Sequence[str] = CREATED_PARTS,
    publish_buckets: int | None = None,
) -> DataFrame:
    """The daily job. Each stage is written under ``root`` (shared storage) and
    the next one starts from its files; returns the published consumer copy.

    ``feed_columns`` is the feed's schema: column names (all text), a typed
    schema, or a schema document (JSON). ``yesterday_path`` defaults to
    ``publish_path``, so each run compares with what the last one published;
    on the first run there is nothing there yet. Every stage's stored rows are
    counted into ``{root}/audit`` (stage, rows). ``stage_parts`` are the
    partition columns of the booking stages, and as many of the mapping (by day; fewer for small feeds,
    where a directory per day means more files than rows are worth).

    ``star_paths`` maps fact_hotel, dim_booking, dim_supplier,
    dim_traveler_profile and dim_location to Parquet paths. ``tables`` maps
    stage names (raw, base, keyed, mapping, matched, staging,
    published, consumer) to catalog
    table names; those stages are written as external tables at their paths.
    ``run_date`` defaults to the current date.

    ``publish_buckets`` publishes in versions instead of rewriting the target
    (``plans.snapshots.publish_snapshot``): a crash leaves yesterday's rows,
    and only buckets that changed are read and written. Published and consumer
    rows are then read with ``sources.versions.read_published``; yesterday is
    what ``publish_path`` holds, and these stages are no catalog tables.
    """
    from ratelake.operators.delta import snapshot_delta
    from ratelake.operators.export import CONSUMER_RENAMES, renamed_for_consumer, to_contract
    from ratelake.operators.match import resolve_matches
    from ratelake.plans.snapshots import publish_snapshot
    from ratelake.sources.sinks import save_as_table, write_parquet
    from ratelake.sources.versions import publish

    publish_path = publish_path or f"{root}/published"
    yesterday_path = yesterday_path or publish_path
    consumer_path = consumer_path or f"{root}/consumer"
    tables = dict(tables or {})

    def materialize(
        df: DataFrame, path: str, parts: Sequence[str] | None = None, stage: str = "", cluster: bool = True
    ) -> DataFrame:
        stage = stage or path.rsplit("/", 1)[-1]
        if stage in tables:
            save_as_table(df, tables[stage], path, partition_by=parts, cluster=cluster)
        else:
            write_parquet(df, path, partition_by=parts, cluster=cluster)
        return audit(stage, spark.read.parquet(path))

    def audit(stage: str, stored: DataFrame) -> DataFrame:
        audited.append(stored.agg(F.count(F.lit(1)).alias("rows")).withColumn("stage", F.lit(stage)))
        return stored

    audited: list[DataFrame] = []
    if isinstance(feed_columns, str):
        schema = schema_from_json(feed_columns)
    elif isinstance(feed_columns, T.StructType):
        schema = feed_columns
    else:
        schema = feed_schema(feed_columns)

    # ingest: text → raw Parquet by created day (parts read back as INT)
    # By year only, every task holds rows of most partitions: bringing each year's rows
    # together first would shuffle whole rows, and saves few files.
    by_day = len(stage_parts) > 1
    materialize(ingest_feed(spark, feed_paths, schema), f"{root}/raw", stage_parts, cluster=by_day)
    raw = spark.read.option("mergeSchema", "true").parquet(f"{root}/raw")
    raw = raw.withColumns({c: F.col(c).try_cast("int") for c in CREATED_PARTS})

    # transform: typed base, latest per booking, keyed for matching
    latest = materialize(latest_stored_bookings(raw, tie_break), f"{root}/base", stage_parts)
    keyed = materialize(keyed_from_stored(latest), f"{root}/keyed", stage_parts)

    # warehouse mapping
    star = {name: spark.read.parquet(path) for name, path in star_paths.items()}
    mapping = materialize(
        dwh_mapping(
            star["fact_hotel"], star["dim_booking"], star["dim_supplier"],
            star["dim_traveler_profile"], star["dim_location"], start_from=facts_from,
        ),
        f"{root}/mapping",
        EFFECTIVE_PARTS[: len(stage_parts)],
    )

    # match and resolve
    matched = materialize(resolve_matches(keyed, mapping, tie_break=tie_break, stored=True), f"{root}/matched", stage_parts, cluster=by_day)

    # publish: delta against yesterday, staged swap (or a new version), consumer copy
    if publish_buckets:
        published = audit("published", publish_snapshot(matched, publish_path, run_date, buckets=publish_buckets, stored=True))
        consumer = audit("consumer", publish(renamed_for_consumer(published, CONSUMER_RENAMES), consumer_path))
    else:
        load_date = F.current_date() if run_date is None else F.lit(run_date).cast("date")
        stamped = matched.withColumns({"dl_last_modified_date": load_date, "rk": F.lit(1), "rk_f": F.lit(1)})
        yesterday = _read_or_empty(spark, yesterday_path, to_contract(stamped).schema)
        snapshot = snapshot_delta(matched, yesterday, run_date, stored=("today", "yesterday"))
        published = materialize(snapshot, f"{root}/publish_staging", stage="staging")
        # The snapshot reads the published path, so it is staged before that path is replaced.
        published = materialize(published, publish_path, stage="published")
        consumer = materialize(renamed_for_consumer(published, CONSUMER_RENAMES), consumer_path, stage="consumer")
    write_parquet(reduce(DataFrame.unionByName, audited).coalesce(1), f"{root}/audit")  # a row per stage
    return consumer
