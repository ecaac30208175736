import os

from conftest import rows
from ratelake.session import scratch_path
from ratelake.streaming import ingest_new_feed_files

COLS = ["booking_status", "created_date", "cheap_aggregator_rate"]


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\t".join(COLS) + "\n" + "\n".join(lines) + "\n")


def test_each_run_reads_only_new_files(spark):
    root = scratch_path(spark, "stream-test").replace("file:", "")
    landing, raw, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/ckpt"
    _drop(landing, "d1.csv", ["CFD\t190524\t12", "booking_status\tcreated_date\tcheap_aggregator_rate"])
    ingest_new_feed_files(spark, landing, COLS, raw, ckpt, file_glob="*.csv")
    first = spark.read.parquet(raw)
    assert rows(first, "booking_status", "CHEAP_BOOKINGCOM_RATE") == [("CFD", "12")]

    _drop(landing, "d2.csv", ["CNX\t190601\t7"])
    ingest_new_feed_files(spark, landing, COLS, raw, ckpt, file_glob="*.csv")
    both = spark.read.parquet(raw)
    assert rows(both, "booking_status", "date_created_month") == [("CFD", 5), ("CNX", 6)]

    # A rerun with nothing new appends nothing.
    ingest_new_feed_files(spark, landing, COLS, raw, ckpt, file_glob="*.csv")
    assert spark.read.parquet(raw).count() == 2


def test_a_day_is_written_into_few_files(spark):
    root = scratch_path(spark, "stream-test").replace("file:", "")
    landing, raw = f"{root}/landing", f"{root}/raw"
    for i in range(6):
        _drop(landing, f"d{i}.csv", [f"CFD\t190524\t{i}", f"CFD\t190525\t{i}"])
    ingest_new_feed_files(spark, landing, COLS, raw, f"{root}/ckpt", file_glob="*.csv")
    back = spark.read.parquet(raw)
    assert back.count() == 12
    assert len(back.inputFiles()) == 2  # a file a day, whichever files the rows came in


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_micro_batches_leave_no_shuffle_files(spark):
    root = scratch_path(spark, "stream-test").replace("file:", "")
    landing, raw = f"{root}/landing", f"{root}/raw"
    for i in range(6):
        _drop(landing, f"d{i}.csv", [f"CFD\t190524\t{i}", f"CFD\t190525\t{i}"])
    size = os.path.getsize(f"{landing}/d0.csv")
    before = _shuffle_files(spark)
    ingest_new_feed_files(spark, landing, COLS, raw, f"{root}/ckpt", file_glob="*.csv", max_bytes_per_trigger=2 * size)
    left = _shuffle_files(spark) - before
    assert len([f for f in os.listdir(f"{root}/ckpt/commits") if f.isdigit()]) == 3  # two files a batch
    assert spark.read.parquet(raw).count() == 12
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
