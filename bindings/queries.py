"""One callable per operator key: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import inputs
from ratelake.operators.flags import top_n_flag
from ratelake.operators.labels import pivot_labels, pivot_labels_per_row
from ratelake.operators.lookup import lookup_with_default
from ratelake.plans import rates
from ratelake.session import scratch_path
from ratelake.sources.parquet import read_parquet
from ratelake.sources.sinks import write_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

LINEITEM_PRUNED = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)


def scan_pruned_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet", schema=LINEITEM_PRUNED)


def lookup_left_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = inputs.search_log(spark, sf_dir).select(
        *rates.DAY_COLS, "res_sessionID", "hotel_id", F.col("id").alias("rate_id")
    )
    return lookup_with_default(s, inputs.rate_lookup(spark, sf_dir), "rate_id", {"new_rate_bucket": rates.NO_BUCKET})


def _labels_text(col: str) -> F.Column:
    # Render the label array as text for the comparison (after the distinct).
    item = F.transform(
        F.col(col),
        lambda l: F.concat_ws(":", F.coalesce(l["id"], F.lit("~")), F.coalesce(l["type"], F.lit("~")), F.coalesce(l["value"], F.lit("~"))),
    )
    return F.when(F.col(col).isNull(), F.lit(None)).otherwise(F.array_join(item, "|"))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = rates.distinct_responses(inputs.search_log(spark, sf_dir), inputs.rate_lookup(spark, sf_dir))
    return d.select(*[c for c in d.columns if c != rates.LABELS], _labels_text(rates.LABELS).alias("labels_text"))


def label_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = inputs.search_log(spark, sf_dir)
    groups = [*rates.DAY_COLS, "res_sessionID", "hotel_id", "id", rates.LABELS]
    p = pivot_labels(s, rates.LABELS, rates.PIVOT_LABELS, groups, order_by="id")
    return p.drop(rates.LABELS).withColumnRenamed("id", "rate_id")


def label_pivot_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label pivot with groups of several rows: first values of a whole session."""
    s = inputs.search_log(spark, sf_dir)
    s = s.withColumn("place", F.concat_ws("|", "id", "hotel_id", F.coalesce(_labels_text(rates.LABELS), F.lit("~"))))
    return pivot_labels(s, rates.LABELS, rates.PIVOT_LABELS, ["res_sessionID"], order_by="place")


def top_n_flag_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = rates.distinct_responses(inputs.search_log(spark, sf_dir), inputs.rate_lookup(spark, sf_dir))
    p = pivot_labels_per_row(d, rates.LABELS, rates.PIVOT_LABELS).drop(rates.LABELS)
    return p.withColumn("top3_rate_flag", top_n_flag(rates.SORTED_RANK, 1, 3))


def rate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_counts(inputs.search_log(spark, sf_dir), inputs.rate_lookup(spark, sf_dir))


def rate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_summary(rate_counts(spark, sf_dir))


def rate_summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = rate_summary(spark, sf_dir)
    path = scratch_path(spark, "rate_summary_csv")
    write_csv(summary, path, order_by=rates.SUMMARY_KEYS)
    return spark.read.csv(path, header=True, schema=summary.schema)


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rate_counts")
    write_parquet(rate_counts(spark, sf_dir), path, partition_by=rates.DAY_COLS)
    back = spark.read.parquet(path)
    # Partition columns come back typed from the directory names (INT here).
    return back.filter((F.col("year") >= 1997) & (F.col("month") <= 6) & F.col("day").between(10, 20))


def availability_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole analysis on a day-partitioned search log, with lineage cuts."""
    root = scratch_path(spark, "availability")
    write_parquet(inputs.search_log(spark, sf_dir), f"{root}/searches", partition_by=rates.DAY_COLS)
    write_parquet(inputs.rate_lookup(spark, sf_dir), f"{root}/lookup")
    return rates.run_availability_job(
        spark,
        f"{root}/searches",
        f"{root}/lookup",
        f"{root}/counts",
        f"{root}/summary",
        partition_filter=F.col("year").between(1996, 2000),
        checkpoint=True,
    )


QUERIES: dict[str, Query] = {
    "scan_pruned_schema": scan_pruned_schema,
    "lookup_left_default": lookup_left_default,
    "distinct_rows": distinct_rows,
    "label_pivot": label_pivot,
    "label_pivot_sessions": label_pivot_sessions,
    "top_n_flag": top_n_flag_query,
    "rate_counts": rate_counts,
    "rate_summary": rate_summary,
    "rate_summary_csv": rate_summary_csv,
    "partitioned_roundtrip": partitioned_roundtrip,
    "availability_job": availability_job,
}
