from pyspark.sql import functions as F

from conftest import rows
from ratelake.operators.flags import top_n_flag
from ratelake.operators.labels import pivot_labels, pivot_labels_per_row

WANTED = ["CLIENT_RATE_TYPE", "CLIENT_RATE_SORTED_RANK"]
T, R = WANTED
SCHEMA = "s string, labels array<struct<id:string,type:string,value:string>>"
DATA = [
    ("two_good", [(T, T, "NEG"), (R, R, "2")]),
    ("null_id_only", [(None, "X", "v")]),
    ("two_null_ids", [(None, "X", "v"), (None, "Y", "w")]),
    ("empty", []),
    ("null_array", None),
    ("id_ne_type", [(T, "OTHER", "NEG"), (R, R, "3.0")]),
    ("unknown_only", [("OTHER", "OTHER", "x")]),
    ("first_null", [(T, T, None), (T, T, "CWV"), (R, R, "x")]),
    ("rank_null", [(R, R, None)]),
]
EXPECTED = sorted(
    [
        ("two_good", "NEG", "2", 1),
        ("null_id_only", None, None, 0),
        ("id_ne_type", None, "3.0", 1),
        ("first_null", "CWV", "x", 0),
        ("rank_null", None, None, 0),
    ],
    key=repr,
)


def test_per_row_and_explode_pivot_agree(ansi_spark):
    df = ansi_spark.createDataFrame(DATA, SCHEMA)
    per_row = pivot_labels_per_row(df, "labels", WANTED).withColumn("f", top_n_flag(R))
    general = pivot_labels(df, "labels", WANTED, ["s", "labels"], order_by="s").withColumn("f", top_n_flag(R))
    assert rows(per_row, "s", T, R, "f") == EXPECTED
    assert rows(general, "s", T, R, "f") == EXPECTED


def test_per_row_pivot_needs_no_shuffle(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    plan = pivot_labels_per_row(df, "labels", WANTED)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_top_n_flag(ansi_spark):
    df = ansi_spark.createDataFrame([("2",), ("3.0",), ("x",), (None,), ("0",), ("4",), ("1",)], "r string")
    assert [r[0] for r in df.select(top_n_flag("r")).collect()] == [1, 1, 0, 0, 0, 0, 1]


def test_multi_row_groups_take_first_by_order(spark):
    data = [
        ("g", 2, [(T, T, "LATE"), (R, R, "2")]),
        ("g", 1, [(T, T, None), (T, T, "EARLY")]),
        ("g", 3, [(R, R, "9")]),
    ]
    df = spark.createDataFrame(data, "s string, ord int, labels array<struct<id:string,type:string,value:string>>")
    out = pivot_labels(df, "labels", WANTED, ["s"], order_by="ord")
    assert rows(out, "s", T, R) == [("g", "EARLY", "2")]
