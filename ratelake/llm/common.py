"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.session import checkpoint_root

#: Words of the corpus operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets`` (NULL id: fold 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % buckets, F.lit(0))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the files.

    Cuts lineage: executors lost later re-read files, not the plan above.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch` (through Spark's file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
