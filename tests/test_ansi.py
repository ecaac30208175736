"""Registered queries give the same rows with ANSI mode on and off."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

KEYS = [
    "rate_counts", "label_pivot", "typed_casts", "parse_compact_dates", "rate_bucket_rules",
    "base_projection", "dedupe_key_hash", "dwh_mapping", "rate_bucket_documents",
]


def _collect(spark, key, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = E.queries()[key](spark, SF_SMALL)
        return sorted((tuple(r) for r in df.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_with_ansi_on_and_off(spark, key):
    assert _collect(spark, key, "true") == _collect(spark, key, "false")
