"""Helpers of the corpus operator tests."""

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def spark_rows(df):
    return [r.asDict() for r in df.collect()]


def oracle_rows(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.sql(sql)
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]
