"""Daily feed ingest as a file stream: only files not seen before are read.

The batch job re-reads every feed file each day and rewrites the raw stage.
Here the same ingest (explicit all-text schema, ``\\N`` nulls, header/torn row
filter, renames, created-date parts) runs as a Structured Streaming query
over the landing folder with ``trigger(availableNow=True)``: each run picks up
the files that arrived since the last run, appends them to the partitioned raw
stage and stops. The stream's checkpoint (which files are done) lives on
shared storage, so a rerun after a failure neither skips nor repeats a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ratelake.contracts import CREATED_PARTS, FEED_RENAMES
from ratelake.plans.bookings import feed_schema
from ratelake.sources.feeds import (
    FEED_NULL_MARKER,
    compact_date_partition_parts,
    drop_bad_rows,
    rename_columns,
)
from ratelake.sources.sinks import clustered, shuffles_removed

# Fixed value: feed files that one micro-batch takes (as stored, so packed ones hold more rows).
# Its shuffle files and what its sorts spill are all the disk that a run needs beside its output.
MICRO_BATCH = 512 << 20

def _prepare(batch: DataFrame) -> DataFrame:
    b = rename_columns(drop_bad_rows(batch, "created_date"), FEED_RENAMES)
    y, m, d = compact_date_partition_parts("created_date")
    return b.withColumns({CREATED_PARTS[0]: y, CREATED_PARTS[1]: m, CREATED_PARTS[2]: d})


def ingest_new_feed_files(
    spark: SparkSession,
    landing: str,
    feed_columns: Sequence[str],
    raw_path: str,
    checkpoint: str,
    file_glob: str = "*",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = MICRO_BATCH,
) -> None:
    """Append the feed files that arrived in ``landing`` to the raw stage.

    Rows go through the same checks
    as the batch ingest; the sink is Parquet partitioned by created day.
    """
    reader = (
        spark.readStream.schema(feed_schema(feed_columns))
        .option("sep", "\t")
        .option("header", "true")
        .option("nullValue", FEED_NULL_MARKER)
        .option("pathGlobFilter", file_glob)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    # Without this every task writes a file of its own for every day it meets.
    stream = clustered(_prepare(reader.csv(landing)), CREATED_PARTS)
    with shuffles_removed(spark):
        query = (
            stream.writeStream.format("parquet")
            .option("path", raw_path)
            .option("checkpointLocation", checkpoint)
            .partitionBy(*CREATED_PARTS)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
