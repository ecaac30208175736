"""Delimited text feeds: explicit schema, ``\\N`` nulls, bad-row filtering."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.functions.casts import lenient_int

FEED_NULL_MARKER = "\\N"


def schema_from_json(doc: str | Mapping) -> T.StructType:
    """Schema document (Spark's JSON form, as produced by ``schema.json()``)."""
    if isinstance(doc, str):
        doc = json.loads(doc)
    return T.StructType.fromJson(dict(doc))


def read_delimited_feed(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = "\t",
    header: bool = True,
    null_value: str = FEED_NULL_MARKER,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read one or many delimited files (paths or globs) with a fixed schema.

    The header line of every file is skipped; the schema is never inferred, so
    the scan is a single pass and splits across files and blocks. Typing is
    left to later ``try_cast``s: feed columns should be declared as strings.
    ``corrupt_column`` adds a column with the whole line where a line has too
    few or too many fields (NULL otherwise).
    """
    options = {}
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.csv(
        list(paths),
        sep=sep,
        header=header,
        schema=schema,
        nullValue=null_value,
        mode="PERMISSIVE",
        **options,
    )


def quarantine_bad_rows(
    df: DataFrame, numeric_column: str, path: str, corrupt_column: str = "_line"
) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined) rows of a feed read with ``corrupt_column``.

    Rows are judged once and written to ``path`` by verdict, so both results
    add up to the rows read. Reasons: ``header`` (a repeated header line),
    ``fields`` (too few or too many fields), ``not a number``
    (``numeric_column`` does not read as one). ``drop_bad_rows`` would have kept
    a torn line whose ``numeric_column`` still reads as a number; here it goes
    to quarantine.
    """
    number = F.col(numeric_column)
    reason = (
        F.when(F.lower(number) == numeric_column.lower(), F.lit("header"))
        .when(F.col(corrupt_column).isNotNull(), F.lit("fields"))
        .when(lenient_int(number).isNull(), F.lit("not a number"))
    )
    judged = df.withColumns({"reason": reason, "bad": reason.isNotNull()})
    judged.write.mode("overwrite").partitionBy("bad").parquet(path)
    back = df.sparkSession.read.schema(judged.schema).parquet(path)
    kept = back.where(~F.col("bad")).drop("bad", "reason", corrupt_column)
    return kept, back.where("bad").drop("bad")


def drop_bad_rows(df: DataFrame, numeric_column: str) -> DataFrame:
    """Keep rows whose ``numeric_column`` reads as a number.

    Repeated header lines of concatenated exports and torn rows fail this test.
    The test follows the legacy (non-ANSI) integer cast, so ``'190524'`` and
    ``'12.5'`` pass while ``'created_date'`` or ``''`` do not.
    """
    return df.filter(lenient_int(F.col(numeric_column)).isNotNull())


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (names matched case-insensitively, as Spark resolves them);
    names not present are ignored (as ``withColumnRenamed``)."""
    by_lower = {c.lower(): c for c in df.columns}
    present = {by_lower[old.lower()]: new for old, new in mapping.items() if old.lower() in by_lower}
    return df.withColumnsRenamed(present) if present else df


def compact_date_partition_parts(
    compact: Column | str, century: str = "20"
) -> tuple[Column, Column, Column]:
    """Year / month / day text parts of a ``yyMMdd`` value (century fixed)."""
    c = F.col(compact) if isinstance(compact, str) else compact
    return (
        F.concat(F.lit(century), F.substring(c, 1, 2)),
        F.substring(c, 3, 2),
        F.substring(c, 5, 2),
    )
