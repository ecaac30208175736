import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from ratelake.plans import bookings as B
from ratelake.plans.bookings import feed_schema, ingest_feed
from ratelake.session import scratch_path
from ratelake.sources.feeds import schema_from_json
from ratelake.sources.parquet import read_parquet
from ratelake.sources.sinks import materialize, save_as_table, staged_overwrite, write_parquet, written_rows


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_feed_header_nulls_and_blanks(spark):
    d = tempfile.mkdtemp(prefix="feed-")
    cols = ["booking_status", "created_date", "cheap_aggregator_rate", "rate_description"]
    header = "\t".join(cols)
    _write(f"{d}/a.txt", header + "\nCFD\t190524\t12\t\\N\n" + header + "\nCNX\t1905\t\t\"\"\n")
    _write(f"{d}/b.txt", header + "\nPND\tn/a\t3\tx\n")
    df = ingest_feed(spark, [f"{d}/a.txt", f"{d}/b.txt"], feed_schema(cols))
    got = rows(df, "booking_status", "created_date", "CHEAP_BOOKINGCOM_RATE", "rate_description",
               "date_created_year", "date_created_month", "date_created_day")
    # repeated header and non-numeric created_date dropped; \N and an unquoted
    # empty field are NULL; a quoted "" is the empty string
    assert got == [
        ("CFD", "190524", "12", None, "2019", "05", "24"),
        ("CNX", "1905", None, "", "2019", "05", ""),
    ]


def test_schema_from_json():
    s = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert schema_from_json(s.json()) == s


def test_partition_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "parts")
    df = spark.range(200).select(
        (F.lit(2019) + F.col("id") % 2).alias("year"), F.lit(5).alias("month"), (F.col("id") % 30 + 1).alias("day"), "id"
    )
    write_parquet(df, path, partition_by=["year", "month", "day"])
    back = spark.read.parquet(path).filter("year = 2019 AND month = 5 AND day BETWEEN 24 AND 30")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day#" in plan.split("PartitionFilters")[1][:300]
    assert back.count() == df.filter("year = 2019 AND day BETWEEN 24 AND 30").count()
    assert dict(back.dtypes)["day"] == "int"


def test_staged_overwrite_of_an_input_path(spark):
    root = scratch_path(spark, "snap")
    write_parquet(spark.range(10), f"{root}/cur")
    cur = spark.read.parquet(f"{root}/cur")
    out = staged_overwrite(cur.withColumn("id", F.col("id") * 2), f"{root}/cur", f"{root}/stage")
    assert sorted(r[0] for r in out.collect()) == [i * 2 for i in range(10)]
    assert written_rows(spark, f"{root}/cur").first()[0] == 10


def test_merge_schema_and_pruned_schema(spark):
    root = scratch_path(spark, "evolve")
    write_parquet(spark.range(3).withColumn("a", F.lit("x")), f"{root}/p=1")
    write_parquet(spark.range(2).withColumn("a", F.lit("y")).withColumn("b", F.lit(7)), f"{root}/p=2")
    merged = read_parquet(spark, root, merge_schema=True)
    assert set(merged.columns) == {"id", "a", "b", "p"}
    assert rows(merged.filter("b IS NULL"), "a") == [("x",)] * 3
    pruned = read_parquet(spark, root, schema=T.StructType([T.StructField("a", T.StringType())]))
    # the directory partition column is still discovered and appended
    assert pruned.columns == ["a", "p"] and pruned.count() == 5


def test_binary_as_string(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),)], "v binary")
    path = scratch_path(spark, "bin")
    write_parquet(df, path)
    assert read_parquet(spark, path, binary_as_string=True).first()[0] == "abc"


def test_table_sink_and_materialize(spark):
    name = "t_" + os.urandom(4).hex()
    save_as_table(spark.range(5), name, scratch_path(spark, name))
    assert spark.table(name).count() == 5
    m = materialize(spark.range(4), scratch_path(spark, "m"))
    assert m.count() == 4


def test_single_csv_is_one_sorted_file(spark):
    import glob

    from ratelake.sources.sinks import write_csv

    path = scratch_path(spark, "csv").replace("file:", "")
    df = spark.range(0, 500, 1, 8).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b")).distinct()
    write_csv(df, path, order_by=["a", "b"], single_file=True)
    files = glob.glob(f"{path}/part-*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    body = [tuple(int(x) for x in l.split(",")) for l in lines[1:]]
    assert lines[0] == "a,b" and body == sorted(body) and len(body) == 35


def test_csv_is_sorted_over_its_files(spark):
    import glob

    from ratelake.sources.sinks import write_csv

    path = scratch_path(spark, "csv").replace("file:", "")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv(spark.range(0, 500, 1, 8).select((F.col("id") * 7919 % 500).alias("a")), path, order_by=["a"], header=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(glob.glob(f"{path}/part-*.csv"))
    body = [int(x) for f in files for x in open(f).read().split()]
    assert len(files) > 1 and body == list(range(500))


def test_feed_exports_are_packed_and_read_back_whole(spark, tmp_path, monkeypatch):
    import glob

    from bindings import booking_queries as Q

    monkeypatch.setattr(Q, "EXPORT_ROWS", 10)
    names = ["ref", "created_date", "note"]
    data = [(f"r{i}", "190524", [None, " a ", "tab\there", "é"][i % 4]) for i in range(35)]
    Q._export(spark.createDataFrame(data, B.feed_schema(names)).coalesce(1), f"{tmp_path}/feed")
    made = glob.glob(f"{tmp_path}/feed/*.csv.lz4")
    assert len(made) == 4
    back = B.ingest_feed(spark, f"{tmp_path}/feed/*.csv.lz4", B.feed_schema(names))
    assert rows(back, *names) == sorted(data, key=repr)
