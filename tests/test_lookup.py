from pyspark.sql import functions as F

from conftest import rows
from ratelake.operators.lookup import Dimension, lookup_with_default, star_join


def test_star_join_keeps_left_sides(spark):
    fact = spark.createDataFrame([(1, 1, 9), (2, 2, 9), (3, 1, 7)], "f int, a int, b int")
    tables = {
        "a": spark.createDataFrame([(1, "x", True), (2, "y", False)], "a int, name string, live boolean"),
        "b": spark.createDataFrame([(9, "nine")], "b int, name string"),
    }
    dims = {
        "a": Dimension("a", {"name": "a_name"}, lambda: F.col("live")),
        "b": Dimension("b", {"name": "b_name"}, how="left"),
    }
    out = star_join(fact, tables, dims)
    assert rows(out, "f", "a_name", "b_name") == [(1, "x", "nine"), (3, "x", None)]


def test_lookup_default_for_miss_and_null(ansi_spark):
    df = ansi_spark.createDataFrame([("r1",), ("r2",), ("r3",)], "rate_id string")
    lk = ansi_spark.createDataFrame([("r1", "CLIENT"), ("r2", None)], "rate_id string, new_rate_bucket string")
    out = lookup_with_default(df, lk, "rate_id", {"new_rate_bucket": "OTHER"})
    assert rows(out) == [("r1", "CLIENT"), ("r2", "OTHER"), ("r3", "OTHER")]
