"""Registered queries: contract, smoke run, plan properties."""

import __spark_entry__ as E
from conftest import SF_SMALL

NO_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def test_every_query_has_an_oracle():
    from bindings.booking_queries import BOOKING_QUERIES
    from bindings.queries import QUERIES

    own = {*QUERIES, *BOOKING_QUERIES}
    assert own <= set(E.queries()) and own <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries()) and len(own) >= 43


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "year", "month", "day", "res_sessionId", "hotel_id", "new_rate_bucket", "CLIENT_RATE_TYPE",
        "top3_rate_flag", "responses",
    ]
    assert df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_analytic_queries_stay_in_the_jvm(spark):
    qs = E.queries()
    for name in ["rate_counts", "base_projection", "rate_bucket_rules", "dwh_mapping", "latest_per_key", "label_pivot"]:
        plan = _plan(qs[name](spark, SF_SMALL))
        assert not any(p in plan for p in NO_PYTHON), name


def test_pruned_scan_pushes_filter_and_prunes(spark):
    df = E.queries()["scan_pruned_schema"](spark, SF_SMALL).where("l_quantity > 25")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,25.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string,l_ship" in plan
    assert "l_tax" not in plan and "l_extendedprice" not in plan


def test_rate_counts_rows_match_explode_form(spark):
    from bindings import inputs
    from ratelake.plans import rates

    s, lk = inputs.search_log(spark, SF_SMALL), inputs.rate_lookup(spark, SF_SMALL)
    a = rates.rate_counts(s, lk, labels_method="per_row")
    b = rates.rate_counts(s, lk, labels_method="explode")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
