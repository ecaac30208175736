import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ratelake.contracts import EXPORT_CONTRACT
from ratelake.operators.delta import snapshot_delta
from ratelake.operators.export import to_contract

TEXT_INT = {"step0_time", "step1_time", "step2_time", "step3_time", "step4_time", "cheap_client_neg_rate",
            "cheap_client_or_cwv_rate", "cheap_gds_published_rate", "cheap_bookingcom_rate", "missed_saving",
            "realised_saving", "hotel_total", "rk", "rk_f", "rnk_f", "row_num", "match_level"}


def today_frame(spark, data):
    """Resolved bookings with every column the export contract reads."""
    base = {name for name, cast in EXPORT_CONTRACT if not (cast or "").startswith("null:")}
    base.discard("dl_last_modified_date")
    keyed = ["hotelhub_booking_ref", "lastmodified_datetime", "full_mk", "prop_mk", "pnr_mk", "match_level", "new_rate_bucket"]
    df = spark.createDataFrame(
        data, "hotelhub_booking_ref string, lastmodified_datetime string, full_mk string, prop_mk string, "
              "pnr_mk string, match_level int, new_rate_bucket string, confirmation_ref string"
    )
    extra = {}
    for c in sorted(base - set(keyed) - {"confirmation_ref"}):
        if c in TEXT_INT:
            extra[c] = F.lit(1)
        elif c == "fact_hotel_id":
            extra[c] = F.lit(5).cast("decimal(10,0)")
        elif c in ("date_in", "date_out", "created_date"):
            extra[c] = F.lit(None).cast("timestamp_ntz")
        elif c.startswith(("rateperday", "totalamount_eur", "totalamount_gbp", "totalamount_usd", "totalamount_lcc")):
            extra[c] = F.lit(1.5)
        else:
            extra[c] = F.lit("x")
    return df.withColumns(extra)


T0 = "2019-05-01 10:00:00"


def test_delta_cases(spark):
    today = today_frame(spark, [
        ("same", T0, "f1", "p1", "k1", 4, "PUB", "c1"),
        ("changed", T0, "f2", "p2", "k2", 4, "CLIENT", "c2"),
        ("nullkey", T0, None, "p3", "k3", 3, "PUB", "c3"),
        ("new", T0, "f4", "p4", "k4", 2, "PUB", "c4"),
        ("twin_a", T0, "f5", "p5", "k5", 4, "PUB", "c5"),
        ("twin_b", T0, "f6", "p6", "k5", 4, "PUB", "c6"),
    ])
    y_src = today.filter(F.col("hotelhub_booking_ref").isin("same", "changed", "nullkey")).withColumn(
        "new_rate_bucket", F.when(F.col("hotelhub_booking_ref") == "changed", "PUB").otherwise(F.col("new_rate_bucket"))
    )
    gone = today.filter(F.col("hotelhub_booking_ref") == "same").withColumns(
        {"hotelhub_booking_ref": F.lit("gone"), "pnr_mk": F.lit("k9"), "confirmation_ref": F.lit("c9")}
    )
    yesterday = to_contract(y_src.unionByName(gone).withColumn("dl_last_modified_date", F.lit("2019-12-31").cast("date")))
    out = snapshot_delta(today, yesterday, "2020-01-01")
    got = {r["hotelhub_booking_ref"]: r["dl_last_modified_date"] for r in out.collect()}
    old, new = dt.datetime(2019, 12, 31), dt.datetime(2020, 1, 1)
    assert got["same"] == old          # unchanged: keeps yesterday's load date
    assert got["changed"] == new       # a compared field changed
    assert got["nullkey"] == new       # NULL keys never carry over
    assert got["new"] == new
    assert "gone" not in got           # absent today → dropped
    assert len([k for k in got if k.startswith("twin")]) == 1  # one row per pnr key
    assert out.columns == [n for n, _ in EXPORT_CONTRACT]

    # Applying the delta again to its own output changes nothing.
    again = snapshot_delta(today, out, "2020-01-02")
    got2 = {r["hotelhub_booking_ref"]: r["dl_last_modified_date"] for r in again.collect()}
    assert got2["same"] == old and got2["changed"] == new and got2["new"] == new


def test_empty_yesterday(spark):
    today = today_frame(spark, [("a", T0, "f1", "p1", "k1", 4, "PUB", "c1")])
    stamped = today.withColumns({"dl_last_modified_date": F.lit("2020-01-01").cast("date")})
    empty = spark.createDataFrame([], to_contract(stamped).schema)
    out = snapshot_delta(today, empty, "2020-01-01")
    assert rows(out, "hotelhub_booking_ref") == [("a",)]


def test_wide_rows_are_neither_sorted_nor_shuffled(spark, tmp_path):
    data = [(f"r{i}", T0, f"f{i % 40}", f"p{i}", None if i % 9 == 0 else f"k{i % 50}", 4, "PUB", f"c{i}") for i in range(120)]
    today = today_frame(spark, data)
    stamped = today.withColumn("dl_last_modified_date", F.lit("2019-12-31").cast("date"))
    old = to_contract(stamped.where("hotelhub_booking_ref < 'r5'").withColumn("new_rate_bucket", F.expr("if(full_mk > 'f3', 'OLD', 'PUB')")))
    today.write.parquet(f"{tmp_path}/today")
    old.write.parquet(f"{tmp_path}/old")
    sides = [spark.read.parquet(f"{tmp_path}/{side}") for side in ("today", "old")]
    out = snapshot_delta(*sides, "2020-01-01", stored=("today", "yesterday"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort [" not in plan
    got = rows(out, "hotelhub_booking_ref", "pnr_mk", "dl_last_modified_date")
    # By hand: unchanged rows of yesterday first (older load date), then the smallest reference of a key.
    best = {}
    for ref, _, full, _, key, *_ in data:
        kept = key is not None and ref < "r5" and not full > "f3"
        best[key] = min(best.get(key, (2, "")), (0 if kept else 1, ref))
    day = {0: dt.datetime(2019, 12, 31), 1: dt.datetime(2020, 1, 1)}
    assert got == sorted(((ref, key, day[new]) for key, (new, ref) in best.items()), key=repr)
    assert rows(snapshot_delta(today, old, "2020-01-01"), "hotelhub_booking_ref", "pnr_mk", "dl_last_modified_date") == got
