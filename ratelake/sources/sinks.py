"""Sinks: Parquet (plain / partitioned), catalog tables, one-file CSV, audits.

Writes overwrite a whole dataset, as the pipelines rewrite each stage, or only
the partitions they have rows for (``overwrite_partitions``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Shuffle files are otherwise kept until the driver's garbage collector meets the plan.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions (and streams started) in here remove their shuffle files when they end."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value together, for a write into few files."""
    # Bring rows of one partition value together before the write so each
    # value is written by few tasks (few files). REBALANCE instead of a plain
    # hash repartition: AQE splits a value that holds a large share of the
    # rows over several tasks and merges tiny ones, so one hot day does not
    # end up in a single task.
    return df.hint("rebalance", *partition_by)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    cluster: bool = True,
) -> None:
    """Write Parquet, optionally partitioned by columns (directory per value)."""
    writer_df = clustered(df, partition_by) if (partition_by and cluster) else df
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for.

    A rerun of one day replaces that day's directory and leaves the files of
    all other days as they are; a day without rows is not touched. Spark moves
    the new files in when the whole write has succeeded.
    """
    writer = clustered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def save_as_table(
    df: DataFrame,
    table: str,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    cluster: bool = True,
) -> None:
    """Catalog table whose files live at ``path`` (external table)."""
    writer_df = clustered(df, partition_by) if (partition_by and cluster) else df
    writer = writer_df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table, mode=mode, format="parquet", path=path)


def write_csv(
    df: DataFrame, path: str, order_by: Sequence[str | Column], header: bool = True, single_file: bool = False
) -> None:
    """CSV in ``order_by`` order over all files, first to last.

    Rows are range-partitioned and sorted, so a summary of any size is written
    by many tasks. ``single_file=True`` is for results known to be small: all
    rows then meet in one task.
    """
    if single_file:
        df = df.repartition(1).sortWithinPartitions(*order_by)
    else:
        df = df.orderBy(*order_by)
    df.write.mode("overwrite").csv(path, header=header)


def written_rows(spark: SparkSession, path: str, name: str = "rows_written") -> DataFrame:
    """Post-write audit: one row with the number of rows now stored at ``path``."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias(name))


def write_observed(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write Parquet and return one row: rows the write saw, rows now stored, whether they agree.

    The first number is gathered by the write itself (an ``Observation``), so
    a lost or doubled part file shows as a difference to the second.
    """
    seen = Observation("written")
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by=partition_by)
    stored = written_rows(df.sparkSession, path, "rows_stored")
    rows = F.lit(int(seen.get["rows"])).cast("bigint")
    return stored.select(rows.alias("rows_seen"), "rows_stored", (F.col("rows_stored") == rows).alias("agree"))


def materialize(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Stage barrier: write a stage, continue from its files.

    Cuts lineage on shared storage, so a lost executor later on never forces
    the stages before the barrier to run again.
    """
    write_parquet(df, path, partition_by=partition_by)
    return df.sparkSession.read.parquet(path)


def staged_overwrite(df: DataFrame, target: str, staging: str) -> DataFrame:
    """Overwrite ``target`` with ``df`` even when ``df`` reads from ``target``.

    Spark refuses to overwrite a path the same plan reads, so the rows go to a
    staging path first; the target is then rewritten from the staged files.
    """
    write_parquet(df, staging)
    staged = df.sparkSession.read.parquet(staging)
    write_parquet(staged, target)
    return df.sparkSession.read.parquet(target)
