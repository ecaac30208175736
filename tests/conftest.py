import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratelake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("ratelake-tests", cores="*", partitions=8)
    yield s


@pytest.fixture(params=[True, False], ids=["ansi", "legacy"])
def ansi_spark(spark, request):
    """Every result must be the same with ANSI mode on and off."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
