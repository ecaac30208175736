"""Two daily runs: yesterday's published path is today's input and target."""

import datetime as dt

from pyspark.sql import functions as F

from bindings import feed_sql as FS
from bindings import inputs
from conftest import SF_SMALL
from ratelake.plans.bookings import run_booking_pipeline
from ratelake.session import scratch_path
from ratelake.sources.sinks import write_parquet


def test_two_day_cycle_keeps_load_dates(spark):
    root = scratch_path(spark, "cycle")
    feed = inputs.booking_feed(spark, SF_SMALL)
    feed.write.mode("overwrite").csv(
        f"{root}/incoming", sep="\t", header=True, nullValue="\\N",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    star = {}
    for name, df in inputs.star_schema(spark, SF_SMALL).items():
        star[name] = f"{root}/dwh/{name}"
        write_parquet(df, star[name])
    common = dict(
        feed_paths=[f"{root}/incoming/*.csv"], feed_columns=FS.FEED_NAMES, star_paths=star,
        facts_from="1996-01-01", yesterday_path=f"{root}/published", publish_path=f"{root}/published",
    )
    day1 = run_booking_pipeline(spark, root=f"{root}/day1", run_date="2020-01-01", **common)
    n1 = day1.count()
    day2 = run_booking_pipeline(spark, root=f"{root}/day2", run_date="2020-01-02", **common)
    six = ["lastmodified_datetime", "full_mk", "prop_mk", "pnr_mk", "match_level", "rate_bucket"]
    complete = F.lit(True)
    for c in six:  # rate_bucket holds the derived bucket in the consumer copy
        complete = complete & F.col(c).isNotNull()
    got = day2.groupBy(complete, "dl_last_modified_date").count().collect()
    by = {(r[0], r[1]): r[2] for r in got}
    assert day2.count() == n1 > 0
    # unchanged rows with complete keys keep the first day's load date ...
    assert by.get((True, dt.datetime(2020, 1, 2)), 0) == 0
    assert by.get((True, dt.datetime(2020, 1, 1)), 0) > 0
    # ... rows with a NULL among the compared fields never carry over
    assert by.get((False, dt.datetime(2020, 1, 1)), 0) == 0
