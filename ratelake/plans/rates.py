"""Rate availability analysis: rate responses counted per search.

scan (pruned schema, partition filter) → left lookup of the rate bucket →
distinct → label pivot → top-3 flag → count per search; then a business
summary summed per day and written as one CSV.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.operators.flags import top_n_flag
from ratelake.operators.labels import pivot_labels, pivot_labels_per_row
from ratelake.operators.lookup import lookup_with_default
from ratelake.session import cut_lineage
from ratelake.sources.parquet import read_parquet
from ratelake.sources.sinks import write_csv, write_parquet

# Search-log fields read, label ids pivoted, defaults.
LABELS = "ratePlan_tpaExtensions_labels_label"
LABEL_STRUCT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
SEARCH_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("res_sessionID", T.StringType()),
        T.StructField("hotel_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField(LABELS, T.ArrayType(LABEL_STRUCT)),
    ]
)
RATE_TYPE = "CLIENT_RATE_TYPE"
SORTED_RANK = "CLIENT_RATE_SORTED_RANK"
PIVOT_LABELS = [RATE_TYPE, SORTED_RANK]
NO_BUCKET = "OTHER"
DAY_COLS = ["year", "month", "day"]
COUNT_KEYS = ["year", "month", "day", "res_sessionId", "hotel_id", "new_rate_bucket", RATE_TYPE, "top3_rate_flag"]
SUMMARY_KEYS = ["year", "month", "day", RATE_TYPE, "top3_rate_flag"]


def read_searches(spark: SparkSession, path: str, binary_as_string: bool = False) -> DataFrame:
    """Search log with only the fields used (nested label fields included)."""
    return read_parquet(spark, path, schema=SEARCH_SCHEMA, binary_as_string=binary_as_string)


def day_range(year: int, month: int, first_day: int, last_day: int) -> Column:
    """Partition predicate ``year = y AND month = m AND day BETWEEN a AND b``."""
    return (F.col("year") == year) & (F.col("month") == month) & F.col("day").between(first_day, last_day)


def distinct_responses(
    searches: DataFrame,
    rate_lookup: DataFrame,
    partition_filter: Column | None = None,
) -> DataFrame:
    """Responses with their rate bucket (``OTHER`` when unknown), made distinct."""
    s = searches if partition_filter is None else searches.filter(partition_filter)
    s = s.select(*DAY_COLS, "res_sessionID", "hotel_id", F.col("id").alias("rate_id"), LABELS)
    bucketed = lookup_with_default(
        s, rate_lookup, on="rate_id", defaults={"new_rate_bucket": NO_BUCKET}
    )
    return bucketed.select(
        *DAY_COLS, "res_sessionID", "rate_id", "hotel_id", "new_rate_bucket", LABELS
    ).distinct()


def rate_counts(
    searches: DataFrame,
    rate_lookup: DataFrame,
    partition_filter: Column | None = None,
    labels_method: str = "per_row",
    checkpoint: bool = False,
) -> DataFrame:
    """Responses per (day, session, hotel, bucket, rate type, top-3 flag).

    After the distinct every row is its own label group, so the pivot runs per
    row (``labels_method='per_row'``, no shuffle); ``'explode'`` runs the
    general explode + pivot and gives the same rows.
    """
    stage1 = cut_lineage(distinct_responses(searches, rate_lookup, partition_filter), checkpoint)
    if labels_method == "per_row":
        stage2 = pivot_labels_per_row(stage1, LABELS, PIVOT_LABELS)
    elif labels_method == "explode":
        groups = [*DAY_COLS, "res_sessionID", "hotel_id", "rate_id", "new_rate_bucket", LABELS]
        stage2 = pivot_labels(stage1, LABELS, PIVOT_LABELS, groups, order_by="rate_id")
    else:
        raise ValueError("labels_method must be 'per_row' or 'explode'")
    stage2 = cut_lineage(stage2, checkpoint)
    return (
        stage2.withColumnRenamed("res_sessionID", "res_sessionId")
        .withColumn("top3_rate_flag", top_n_flag(SORTED_RANK, 1, 3))
        .groupBy(*COUNT_KEYS)
        .agg(F.count(F.lit(1)).alias("responses"))
    )


def rate_summary(counts: DataFrame) -> DataFrame:
    """Total responses per (day, rate type, top-3 flag)."""
    return counts.groupBy(*SUMMARY_KEYS).agg(F.sum("responses").alias("total_responses"))


def run_availability_job(
    spark: SparkSession,
    searches_path: str,
    lookup_path: str,
    output_path: str,
    summary_path: str,
    partition_filter: Column | None = None,
    checkpoint: bool = False,
) -> DataFrame:
    """Whole job: counts written partitioned by day, summary as one sorted CSV."""
    searches = read_searches(spark, searches_path, binary_as_string=True)
    lookup = read_parquet(spark, lookup_path, binary_as_string=True)
    counts = rate_counts(searches, lookup, partition_filter, checkpoint=checkpoint)
    write_parquet(counts, output_path, partition_by=DAY_COLS)
    summary = rate_summary(spark.read.parquet(output_path))
    write_csv(summary, summary_path, order_by=SUMMARY_KEYS)
    return spark.read.csv(summary_path, header=True, schema=summary.schema)
