"""Top-k search against brute force and SQL."""

import math

import numpy as np
from pyspark.sql import functions as F

from ratelake.llm import topk
from ratelake.llm.queries import op9_top_k
from tests.llm.util import SF, frame, oracle_rows, spark_rows


def literal(rows, k=5):
    good = []
    for i, e in rows:
        if i is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        good.append((i, [math.floor(256 * x) for x in e]))
    out = []
    for i, q in {(i, tuple(e)) for i, e in good if i % 50 == 0}:
        s = sorted((-sum(a * b for a, b in zip(q, e)), j) for j, e in good if j != i)[:k]
        out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in spark_rows(df))


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=6).round(1)]) for i in range(700)]
    rows += [(1000 + i, rows[50][1]) for i in range(30)]  # ties
    rows += [(100, rows[100][1]), (7, rows[0][1]), (7, rows[0][1])]  # repeated query, repeated candidates
    rows += [(2000, None), (2050, []), (2100, [1.0, None]), (2150, [float("nan")] * 6), (2200, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(3000, [1.0, 2.0]), (3001, [0.0] * 6)]
    df = frame(spark, [(e, i, 1) for i, e in rows], "embedding array<double>, vec_id long, shard int")
    assert got(topk.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=90, block_queries=5)) == literal(rows)


def test_few_rows_and_wide_values(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (50, [2.0]), (3, [-1.0])], [(0, [1e7, -3e7]), (1, [2e7, 5e6]), (2, [1.0, 1.0])]):
        df = frame(spark, rows, "vec_id long, embedding array<float>")
        assert got(topk.top_k(df, F.col("vec_id") % 50 == 0)) == literal(rows)


def test_query_against_sql(spark):
    cols = ("query_id", "rank", "vec_id", "score")
    want = sorted(tuple(r[c] for c in cols) for r in oracle_rows(topk.ORACLE_SQL))
    assert got(op9_top_k(spark, SF)) == want and len(want) == 50
