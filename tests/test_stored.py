"""Rows fetched by their place: same rows as the plain form, no wide shuffle."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ratelake.contracts import BASE_PROJECTION, CREATED_PARTS
from ratelake.functions.text import strip_non_alnum
from ratelake.operators.stored import PLACE, rows_at, with_place
from ratelake.plans import bookings as B


def _raw(spark, path):
    """Raw rows with repeated and NULL references, in three files."""
    ids = spark.range(0, 900, 1, 3)
    special = {
        "booking_status": F.when(F.col("id") % 5 == 0, "PND").otherwise("CFD"),
        "hotelhub_booking_ref": F.when(F.col("id") % 7 != 0, F.concat(F.lit("HB"), (F.col("id") % 60).cast("string"))),
        "lastmodified_datetime": F.concat(F.lit("19052"), (F.col("id") % 4).cast("string"), F.lit(" 10:00:00")),
        "pnr": F.concat(F.lit("PN-"), (F.col("id") % 40).cast("string")),
        "date_in": F.lit("190601"),
        "date_out": F.lit("190602"),
        "step0_time": F.concat((F.col("id") % 9).cast("string"), F.lit(".75")),
    }
    sources = dict.fromkeys([*[src for _, _, src in BASE_PROJECTION if src], *CREATED_PARTS])
    text = F.col("id").cast("string")
    ids.select(*[special.get(c, text).alias(c) for c in sources]).write.parquet(path)
    return spark.read.parquet(path)


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_rows_at_gives_each_picked_row_once(spark, tmp_path):
    spark.range(0, 100000, 1, 2).union(spark.range(5)).write.parquet(f"{tmp_path}/t")
    placed = with_place(spark.read.parquet(f"{tmp_path}/t"))
    got = rows_at(placed, placed.where("id % 3 = 0").select(*PLACE))
    assert got.columns == ["id"]
    assert sorted(r[0] for r in got.collect()) == sorted([*range(0, 100000, 3), 0, 3])
    assert rows_at(placed, placed.where("id < 0").select(*PLACE)).count() == 0


def test_stored_forms_give_the_rows_of_the_plain_forms(spark, tmp_path):
    raw = _raw(spark, f"{tmp_path}/raw")
    latest = B.latest_bookings(B.base_projection(raw))
    assert _rows(B.latest_stored_bookings(raw)) == _rows(latest)
    assert B.keyed_from_raw(raw).columns == B.keyed_bookings(latest).columns
    assert _rows(B.keyed_from_raw(raw)) == _rows(B.keyed_bookings(latest))
    latest.write.parquet(f"{tmp_path}/latest")
    assert _rows(B.keyed_from_stored(spark.read.parquet(f"{tmp_path}/latest"))) == _rows(B.keyed_bookings(latest))


def test_wide_rows_are_not_shuffled(spark, tmp_path):
    raw = _raw(spark, f"{tmp_path}/raw")
    plan = B.keyed_from_raw(raw)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning", plan)
    assert "BroadcastHashJoin" in plan


def test_stripping_takes_no_regular_expression(spark):
    values = [("a-b c:9",), ("\x00é😀Z_z",), ("",), ("--",), (None,)]
    df = spark.createDataFrame(values, "v string").select(strip_non_alnum("v").alias("r"))
    assert [r.r for r in df.collect()] == ["abc9", "Zz", "", "", None]
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
