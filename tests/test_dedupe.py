from pyspark.sql import functions as F

from conftest import rows
from ratelake.operators.dedupe import any_per_key, latest_per_key

DATA = [
    ("a", "2019-05-01 10:00:00", 1),
    ("a", "2019-05-02 10:00:00", 2),
    ("b", "2019-05-01 10:00:00", 3),
    ("b", "2019-05-01 10:00:00", 4),  # tie with 3
    ("c", "", 5),
    ("c", None, 6),  # '' sorts above NULL
    (None, "2019-01-01 00:00:00", 7),
    (None, "2019-02-01 00:00:00", 8),
    (None, "2019-02-01 00:00:00", 9),  # NULL keys form one group; tie with 8
]
SCHEMA = "k string, t string, id int"


def test_one_row_per_key_with_tie_break(ansi_spark):
    df = ansi_spark.createDataFrame(DATA, SCHEMA)
    out = latest_per_key(df, ["k"], ["t"], ties="one", tie_break=[("id", "desc")])
    assert rows(out, "k", "id") == sorted([("a", 2), ("b", 4), ("c", 5), (None, 9)], key=repr)


def test_ties_kept(ansi_spark):
    df = ansi_spark.createDataFrame(DATA, SCHEMA)
    out = latest_per_key(df, ["k"], ["t"], ties="all", rank_column="rk")
    assert rows(out, "k", "id", "rk") == sorted(
        [("a", 2, 1), ("b", 3, 1), ("b", 4, 1), ("c", 5, 1), (None, 8, 1), (None, 9, 1)], key=repr
    )


def test_ties_kept_all_null_order_in_null_group(spark):
    df = spark.createDataFrame([(None, None, 1), (None, None, 2), ("x", None, 3)], SCHEMA)
    out = latest_per_key(df, ["k"], ["t"], ties="all")
    assert rows(out, "id") == [(1,), (2,), (3,)]


def test_two_order_columns_desc(spark):
    df = spark.createDataFrame([("k", 1, 5), ("k", 2, 1), ("k", 2, 3), ("k", None, 9)], "k string, e int, id int")
    out = latest_per_key(df, ["k"], [("e", "desc"), ("id", "desc")], ties="all")
    assert rows(out, "id") == [(3,)]


def test_any_per_key(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = any_per_key(df, ["k"], tie_break=[("id", "asc")])
    assert rows(out, "k", "id") == sorted([("a", 1), ("b", 3), ("c", 5), (None, 7)], key=repr)


def test_top1_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], ["v"], ties="one")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
