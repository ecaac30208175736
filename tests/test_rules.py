from pyspark.sql import functions as F

from ratelake.functions.rules import (
    CHANNEL_RULES,
    RATE_BUCKET_DEFAULT,
    RATE_BUCKET_RULES,
    channel_type,
    classify,
    rules_column,
)

COLS = "content_source string, rate_bucket string, rate_access_code_booked string, rate_description string, " \
       "gds_commission_text string, client_client_top_name string"

# One row per reachable rule (by position, 1-based), with the expected result.
RULE_ROWS = [
    (1, ("BOOKING.COM", None, None, None, None, None), "AGG RATE"),
    (2, ("PREMIER INN - PI", None, None, None, None, None), "PUB - DIRECT CONNECT"),
    (3, ("X", "CLIENT", "CWV", "plain", "10", "Q"), "ROOMIT (CWV)"),
    (4, ("X", "ROOMIT", "ZZ", "Client Value", "10", "Q"), "ROOMIT (CWV)"),
    (5, ("X", "PUBLIC", "", "cwv deal", "10", "Q"), "ROOMIT (CWV)"),
    (6, ("X", "PUBLIC", "ZZ", "room it now", "10", "Q"), "ROOMIT (CWV)"),
    (7, ("X", "PUBLIC", "ZZ", "CRS rate", "10", "Q"), "CLIENT"),
    (8, ("X", "CLIENT", "CLIENT", "plain", "10", "Q"), "ROOMIT (CLIENT)"),
    (9, ("X", "PUBLIC", None, "carlson", "10", "Q"), "ROOMIT (CLIENT)"),
    (10, ("X", "PUBLIC", "ZZ", "consortia", "10", "Q"), "ROOMIT (CLIENT)"),
    (11, ("X", "PUBLIC", "ZZ", "Worldwide", "10", "Q"), "PUB"),
    (12, ("X", "BAR", "ZZ", "Beds flexible rate", "10", "Q"), "PUB"),
    (13, ("X", "KUNDEN", "ZZ", "plain", "10", "Q"), "CLIENT"),
    (14, ("X", "REQUEST", "ZZ", "plain", "NO", "Q"), "CLIENT"),
    (15, ("X", "U", "ZZ", "plain", "NOT COMM", "Q"), "CLIENT"),
    (16, ("X", "BAR", "ZZ", "GOV", "UNK", "Q"), "CLIENT"),
    (18, ("X", "BAR", "ZZ", "XCOR", None, "Q"), "CLIENT"),
    (19, ("X", "BAR", "ZZ", "plain", "NON", "Q"), "CLIENT"),
    (20, ("X", "BAR", "ZZ", "Government", "10", "Q"), "CLIENT"),
    (21, ("X", "BAR", "SC", "std cor", "10", "Q"), "CLIENT"),
    (22, ("X", "BAR", "ZZ", "Zeta4 deal", "10", "zeta4"), "CLIENT"),
    (23, ("X", "BAR", "ZZ", "aarp", "10", "Q"), "CLIENT"),
    (24, ("X", "BAR", "ZZ", "plain", "10", "Q"), "PUB"),
]


def test_rate_bucket_one_row_per_rule(ansi_spark):
    df = ansi_spark.createDataFrame([r for _, r, _ in RULE_ROWS], COLS)
    out = classify(df, RATE_BUCKET_RULES, RATE_BUCKET_DEFAULT, "b")
    got = [r["b"] for r in out.collect()]
    # collect() keeps the order of a local, unshuffled frame
    assert got == [e for _, _, e in RULE_ROWS]
    assert len(RATE_BUCKET_RULES) == 23


def test_null_operand_skips_rule_and_empty_needle_matches(ansi_spark):
    df = ansi_spark.createDataFrame(
        [("X", None, None, None, None, None), ("X", "BAR", "ZZ", "anything", "10", "")], COLS
    )
    got = [r["b"] for r in classify(df, RATE_BUCKET_RULES, RATE_BUCKET_DEFAULT, "b").collect()]
    # NULL description: rules reading it are skipped; blank bucket and commission → rule 14
    assert got[0] == "CLIENT"
    # an empty client name is contained in every description → rule 22
    assert got[1] == "CLIENT"


def test_channel_rules(ansi_spark):
    cases = [
        ("BOOKING.COM", None, "BC"), ("EAN X", None, "EH"), ("DESIYA", None, "DH"), ("PREMIER", None, "PI"),
        ("CHL", None, "CM"), ("SABRE", None, "S"), ("AMADEUS", None, "A"), ("GALILEO", None, "G"),
        ("APOLLO", None, "1V"), ("HOTELHUB", "SABRE", "S"), ("HOTELHUB", "APOLLO", "1V"),
        ("HOTELHUB", "AMADEUS", "A"), ("HOTELHUB", "GALILEO", "G"), ("HOTELHUB", None, "XX"), (None, None, "XX"),
    ]
    df = ansi_spark.createDataFrame([(a, b) for a, b, _ in cases], "content_source string, gds_shopped_for_rate string")
    got = [r[0] for r in df.select(channel_type()).collect()]
    assert got == [c for _, _, c in cases]
    assert len(CHANNEL_RULES) == 13


def test_rules_compile_to_builtin_expression(spark):
    df = spark.createDataFrame([("A",)], "content_source string")
    plan = df.select(rules_column(CHANNEL_RULES, "XX", {"gds_shopped_for_rate": "content_source"}).alias("c"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in text and "Python" not in text
