"""Parquet scans: inferred, explicit (pruned, nested) and merged schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
    binary_as_string: bool = False,
) -> DataFrame:
    """Parquet scan.

    * ``schema`` — read only these (possibly nested) fields; the Parquet reader
      prunes every other column and nested field at the scan.
    * ``merge_schema`` — union the footers of all files (schema evolution).
    * ``binary_as_string`` — legacy writers store text as plain BINARY; cast
      such top-level columns to strings without touching the session config.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(*paths)
    return strings_for_binary(df) if binary_as_string else df


#: Types that widen into one another, narrow to wide.
_INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider_type(a: T.DataType, b: T.DataType, name: str = "") -> T.DataType:
    """The narrower of the types that hold both; an error where none does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _INTEGRAL and b in _INTEGRAL:
        return _INTEGRAL[max(_INTEGRAL.index(a), _INTEGRAL.index(b))]
    floats = (T.FloatType(), T.DoubleType())
    if (a in floats and b in floats) or (a in floats and b in _INTEGRAL[:3]) or (b in floats and a in _INTEGRAL[:3]):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return reconciled([a, b])
    raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} have no common type")


def reconciled(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for all: columns in order of their first appearance, types widened."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            types[f.name] = wider_type(types[f.name], f.dataType, f.name) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in types.items()])


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Folders written over time, whose columns were added or widened, as one table.

    Each folder's footers give its schema; the reconciled one is handed to a
    single scan, which widens while decoding and gives NULL for columns that a
    folder lacks. (``merge_schema`` takes added columns, but no change of type.)
    """
    folders = {p: spark.read.parquet(p).schema for p in paths}
    whole = reconciled(list(folders.values()))
    # The scan itself widens integral types; for other changes the folders of one schema are cast.
    direct = [p for p, s in folders.items() if all(_decodes(f.dataType, whole[f.name].dataType) for f in s.fields)]
    parts = [spark.read.schema(whole).parquet(*direct)] if direct else []
    for p, s in folders.items():
        if p not in direct:
            df = spark.read.parquet(p)
            have = {f.name for f in s.fields}
            cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole.fields]
            parts.append(df.select(*cols))
    return reduce(DataFrame.unionByName, parts)


def _decodes(stored: T.DataType, wanted: T.DataType) -> bool:
    return stored == wanted or (stored in _INTEGRAL and wanted in _INTEGRAL)


def strings_for_binary(df: DataFrame) -> DataFrame:
    """Cast top-level BINARY columns to STRING (UTF-8), keep the others."""
    binary = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)}
    if not binary:
        return df
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(c) if c in binary else F.col(f"`{c}`") for c in df.columns]
    )
