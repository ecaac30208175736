"""Versioned tables: crash safety, buckets read and written, state and snapshots carried by day."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ratelake.operators.dedupe import latest_per_key
from ratelake.operators.delta import snapshot_delta
from ratelake.operators.export import to_contract
from ratelake.plans import snapshots
from ratelake.plans.snapshots import carry_latest, publish_snapshot
from ratelake.session import scratch_path
from ratelake.sources import versions
from ratelake.sources.parquet import read_evolved, reconciled
from ratelake.sources.sinks import overwrite_partitions, write_observed, write_parquet
from test_delta import today_frame


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)}


def test_a_crash_before_the_manifest_leaves_the_old_rows(spark, monkeypatch):
    root = scratch_path(spark, "crash")
    versions.publish(spark.range(5), root)

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "_write_manifest", crash)
    with pytest.raises(RuntimeError):
        versions.publish(spark.range(100), root)
    monkeypatch.undo()
    assert versions.read_published(spark, root).count() == 5
    assert versions.publish(versions.read_published(spark, root).selectExpr("id + 10 AS id"), root).agg(F.min("id")).first()[0] == 10


def test_two_writers_of_one_version(spark):
    root = scratch_path(spark, "writers")
    versions.publish(spark.range(3), root)
    manifest = versions.read_manifest(spark, root)
    with pytest.raises(RuntimeError):
        versions._write_manifest(spark, root, manifest)
    assert versions.read_published(spark, root).count() == 3


def test_buckets_keep_their_folders_and_old_versions_go(spark):
    root = scratch_path(spark, "buckets")
    df = spark.range(100).withColumn(versions.BUCKET, (F.col("id") % 4).cast("int"))
    versions.publish(df, root)
    old = files(f"{root}/versions")
    versions.publish(df.where(f"{versions.BUCKET} = 2").withColumn("id", F.col("id") + 1000), root, replaced=[2, 3])
    assert files(f"{root}/versions").items() >= old.items()
    got = sorted(r[0] for r in versions.read_published(spark, root).collect())
    assert got == sorted([i for i in range(100) if i % 4 < 2] + [i + 1000 for i in range(100) if i % 4 == 2])
    assert versions.read_published(spark, root, [3]).count() == 0
    plan = versions.read_published(spark, root, [1])._jdf.queryExecution().executedPlan().toString()
    assert "1 paths" in plan
    versions.drop_old_versions(spark, root, keep=1)
    assert sorted(r[0] for r in versions.read_published(spark, root).collect()) == got
    assert len(files(f"{root}/versions")) < len(old) + 1
    versions.publish(df.where("false"), root)
    assert versions.read_published(spark, root).collect() == []


def test_latest_rows_carried_over_days(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["a", "b", "c", None, "d"]) , rnd.randint(0, 9), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, t int, n int")
    root = scratch_path(spark, "carried")
    for d in range(4):
        out = carry_latest(df.where(F.col("n") % 4 == d), root, ["k"], ["t"], [("n", "desc")], buckets=8)
    assert rows(out) == rows(latest_per_key(df, ["k"], ["t"], tie_break=[("n", "desc")]))
    # A day with one key reads and writes that key's bucket only.
    before = files(f"{root}/versions")
    carry_latest(spark.createDataFrame([("a", 99, 999)], df.schema), root, ["k"], ["t"], [("n", "desc")])
    assert len(files(f"{root}/versions")) == len(before) + 1


KEYS = ["hotelhub_booking_ref", "confirmation_ref", "pnr_mk", "new_rate_bucket", "dl_last_modified_date"]


def day(spark, seed, n=60):
    """Rows of which a few change from day to day, some with NULLs or no time."""
    base, rnd = random.Random(1), random.Random(seed)
    data = []
    for i in range(n):
        row = [f"r{i}", base.choice(["2019-05-01 10:00:00", "2019-05-01 10:00:00", "", None]), f"f{i}", f"p{i}", base.choice([f"k{i}", f"k{i // 2}", None]), 4, "PUB", f"c{i}"]
        if rnd.random() < 0.1:
            row[rnd.choice([1, 2, 4, 6])] = rnd.choice([None, "2019-05-02 10:00:00", "X"])
        if rnd.random() > 0.05:
            data.append(tuple(row))
    return today_frame(spark, data)


def test_snapshot_by_bucket_equals_the_whole_delta(spark):
    root = scratch_path(spark, "by-bucket")
    first = day(spark, 0)
    stamped = first.withColumns({"dl_last_modified_date": F.current_date(), "rk": F.lit(1), "rk_f": F.lit(1)})
    whole = spark.createDataFrame([], to_contract(stamped).schema)
    for d in range(4):
        today = day(spark, d)
        run = f"2020-01-0{d + 1}"
        whole = spark.createDataFrame(snapshot_delta(today, whole, run).collect(), whole.schema)
        out = publish_snapshot(today, root, run, buckets=16)
        assert rows(out, *KEYS) == rows(whole, *KEYS)


def test_only_changed_buckets_are_read_and_written(spark, monkeypatch):
    root = scratch_path(spark, "changed")
    T0 = "2019-05-01 10:00:00"
    data = [(f"r{i}", T0, f"f{i}", f"p{i}", f"k{i}", 4, "PUB", f"c{i}") for i in range(100)]
    publish_snapshot(today_frame(spark, data), root, "2020-01-01", buckets=64)
    before = files(f"{root}/versions")
    read = []
    plain = snapshots.read_published
    monkeypatch.setattr(snapshots, "read_published", lambda s, r, b=None: read.append(set(b)) or plain(s, r, b))
    data[7] = data[7][:6] + ("CLIENT",) + data[7][7:]
    out = publish_snapshot(today_frame(spark, data), root, "2020-01-02")
    assert len(read) == 1 and len(read[0]) == 1
    assert len(files(f"{root}/versions")) - len(before) == 1
    fresh = out.where("dl_last_modified_date = '2020-01-02'").collect()
    assert [r.pnr_mk for r in fresh] == ["k7"] and out.count() == 100


def test_one_partition_is_overwritten(spark):
    path = scratch_path(spark, "dynamic")
    df = spark.range(40).select("id", (F.col("id") % 4).alias("day"))
    write_parquet(df, path, partition_by=["day"])
    before = files(path)
    overwrite_partitions(df.where("day = 2").limit(3), path, ["day"])
    after = files(path)
    assert {f: t for f, t in before.items() if "day=2/" not in f}.items() <= after.items()
    assert rows(spark.read.parquet(path).groupBy("day").count()) == [(0, 10), (1, 10), (2, 3), (3, 10)]


def test_observed_write(spark):
    r = write_observed(spark.range(123), scratch_path(spark, "seen")).first()
    assert (r.rows_seen, r.rows_stored, r.agree) == (123, 123, True)


def test_widened_columns(spark):
    root = scratch_path(spark, "widened")
    a = spark.sql("SELECT 1 AS i, CAST(2.5 AS FLOAT) AS f, CAST('1.25' AS DECIMAL(5,2)) AS d, DATE '2020-01-02' AS t, 'x' AS s, 7 AS n")
    b = spark.sql("SELECT 3000000000 AS i, 2.5D AS f, CAST('1.125' AS DECIMAL(9,3)) AS d, TIMESTAMP_NTZ '2020-01-02 03:00:00' AS t, 'y' AS s, 0.5D AS n, true AS more")
    write_parquet(a, f"{root}/a")
    write_parquet(b, f"{root}/b")
    out = read_evolved(spark, f"{root}/a", f"{root}/b")
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "double", "decimal(9,3)", "timestamp_ntz", "string", "double", "boolean"]
    got = sorted(tuple(map(str, r)) for r in out.collect())
    assert got == [
        ("1", "2.5", "1.250", "2020-01-02 00:00:00", "x", "7.0", "None"),
        ("3000000000", "2.5", "1.125", "2020-01-02 03:00:00", "y", "0.5", "True"),
    ]
    with pytest.raises(ValueError):
        reconciled([a.select("s").schema, b.selectExpr("true AS s").schema])
