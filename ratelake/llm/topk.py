"""Exact top-k inner products by ball-tree branch and bound.

Rows are dealt to shards of bounded size. A shard's task builds a ball tree
over its integer vectors; for a query ``q`` a ball with center ``c`` and
radius ``r`` holds no inner product over ``q.c + |q| r``. Nodes are taken in
order of that bound, and the search of a query ends at the first node under
its current k-th score. Scores are shared in two steps: every query is first
searched in the shard it lies in, and the k-th score found there goes with it
to all other shards, which start pruning from it. Queries meet a shard in
blocks of bounded size.

Vectors are floor(256 * x) of each component as a double; scores are exact
integers (wide ones are summed as Python integers and cut to the range of a
long).

Defined cases: vectors that are NULL, empty, or hold a NULL or non-finite
component take no part; shorter vectors count as padded with zeros; rows
repeating an id are separate candidates, but never of a query with that id; equal query
rows are one query; NULL ids take no part; a query with fewer candidates than
``k`` returns all; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged

K, LEAF = 5, 64
SHARD_ROWS, BLOCK_QUERIES = 8192, 4096
_LONG = np.iinfo(np.int64)


def to_integers(column: pa.Array) -> np.ndarray:
    """floor(256 * x) per component as float64, padded with zeros."""
    rows = [np.asarray(r, np.float64) for r in column.to_numpy(zero_copy_only=False)]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = np.floor(256.0 * r)
    return out


def _pad(x: np.ndarray, d: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, d - x.shape[1])))


class BallTree:
    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        self.center, self.radius, self.span, self.kids = [], [], [], []
        self.order = np.arange(len(x))
        if len(x):
            self._build(0, len(x), leaf)
        self.points = x[self.order]
        self.center = np.array(self.center).reshape(-1, x.shape[1])
        self.radius = np.array(self.radius)

    def _build(self, lo: int, hi: int, leaf: int) -> int:
        rows = self.order[lo:hi]
        part = self.x[rows]
        c = part.mean(0)
        far = np.sqrt(((part - c) ** 2).sum(1))
        node = len(self.span)
        self.center.append(c)
        self.radius.append(far.max())
        self.span.append((lo, hi))
        self.kids.append(None)
        if hi - lo > leaf and far.max() > 0:
            a = part[far.argmax()]
            b = part[((part - a) ** 2).sum(1).argmax()]
            side = np.argsort(part @ (b - a), kind="stable")
            self.order[lo:hi] = rows[side]
            mid = (lo + hi) // 2
            self.kids[node] = (self._build(lo, mid, leaf), self._build(mid, hi, leaf))
        return node

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product per (query, node), with room for rounding."""
        norm = np.sqrt((q * q).sum(1))[:, None]
        size = np.sqrt((self.center * self.center).sum(1)) + self.radius
        return q @ self.center.T + norm * self.radius + 1e-9 * norm * size + 1e-6


def _products(points: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (points @ q).astype(np.int64)
    wide = [sum(int(a) * int(b) for a, b in zip(p, q)) for p in points]
    return np.array([min(max(w, _LONG.min), _LONG.max) for w in wide], np.int64)


def search(tree: BallTree, ids: np.ndarray, q: np.ndarray, own: np.ndarray, floor: list, k: int):
    """Per query up to ``k`` (score, id), none under the query's floor (None: no floor)."""
    ids = ids[tree.order]
    scale = (np.abs(tree.points).max(initial=0) * np.abs(q).max(initial=0)) * max(q.shape[1], 1)
    exact = bool(scale < 2.0**53)
    bounds = tree.bounds(q) if len(tree.span) else np.zeros((len(q), 0))
    found = []
    for i in range(len(q)):
        u = bounds[i]
        kth = floor[i]
        best_s, best_v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap = [(-u[0], 0)] if len(u) else []
        while heap:
            top, node = heapq.heappop(heap)
            if kth is not None and -top < kth and exact:
                break
            kids = tree.kids[node]
            if kids:
                for x in kids:
                    if kth is None or u[x] >= kth or not exact:
                        heapq.heappush(heap, (-u[x], x))
                continue
            lo, hi = tree.span[node]
            s = _products(tree.points[lo:hi], q[i], exact)
            v = ids[lo:hi]
            keep = v != own[i]
            if kth is not None:
                keep &= s >= kth
            if keep.any():
                best_s, best_v = np.concatenate([best_s, s[keep]]), np.concatenate([best_v, v[keep]])
                order = np.lexsort((best_v, -best_s))[:k]
                best_s, best_v = best_s[order], best_v[order]
                if len(best_s) == k:
                    kth = int(best_s[-1]) if kth is None else max(kth, int(best_s[-1]))
        found.append((best_s, best_v))
    return found


_HITS = "query_id bigint, q_row bigint, vec_id bigint, score bigint"


def _hits(query_id: np.ndarray, q_row: np.ndarray, found) -> pa.Table:
    n = [len(s) for s, _ in found]
    empty = [np.zeros(0, np.int64)]
    columns = [
        np.repeat(query_id, n),
        np.repeat(q_row, n),
        np.concatenate([v for _, v in found] or empty),
        np.concatenate([s for s, _ in found] or empty),
    ]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "q_row", "vec_id", "score"])


def top_k(
    vectors: DataFrame, is_query, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``is_query`` holds."""
    e = F.col(embedding).cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & (F.size(embedding) > 0) & fine)
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), e.alias("e"), is_query.alias("asks"))
    # Rows get numbers of their own, so a repeated id cannot fill one shard.
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // block_queries))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))

    def at_home(part: pa.Table) -> pa.Table:
        x = to_integers(part["e"].combine_chunks())
        ids = part["vec_id"].to_numpy()
        asks = part["asks"].to_numpy(zero_copy_only=False).astype(bool)
        if not asks.any():
            return _hits(ids[:0], ids[:0], [])
        found = search(BallTree(x), ids, x[asks], ids[asks], [None] * int(asks.sum()), k)
        return _hits(ids[asks], part["row"].to_numpy()[asks], found)

    home = staged(rows.select("shard", "row", "vec_id", "e", "asks").groupBy("shard").applyInArrow(at_home, _HITS), "topk-home")
    kth = home.groupBy("q_row").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k)
    queries = rows.where("asks").select("row", "vec_id", "e", "shard").join(kth.select(F.col("q_row").alias("row"), "kth"), "row", "left")
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)))
    # Each block of queries goes to every other shard once; shards go to each block once.
    away = queries.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("to != shard")
    away = away.select(F.col("to").cast("bigint").alias("shard"), F.col("block").cast("bigint").alias("block"), "row", "vec_id", "e", "kth")
    away = away.toDF(*away.columns)  # columns of its own, as both sides come from one table
    targets = rows.select("shard", "vec_id", "e").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))

    def elsewhere(left: pa.Table, right: pa.Table) -> pa.Table:
        own = right["vec_id"].to_numpy()
        if not left.num_rows or not right.num_rows:
            return _hits(own[:0], own[:0], [])
        x, q = (to_integers(t["e"].combine_chunks()) for t in (left, right))
        d = max(x.shape[1], q.shape[1])
        found = search(BallTree(_pad(x, d)), left["vec_id"].to_numpy(), _pad(q, d), own, right["kth"].to_pylist(), k)
        return _hits(own, right["row"].to_numpy(), found)

    both = targets.groupBy("shard", "block").cogroup(away.groupBy("shard", "block")).applyInArrow(elsewhere, _HITS)
    hits = home.unionByName(both)
    # Equal query rows ask the same; keep the first of them.
    same = rows.where("asks").groupBy("vec_id", "e").agg(F.min("row").alias("q_row")).select("q_row")
    hits = hits.join(same, "q_row", "left_semi")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The registered query (divisible ids ask) in DuckDB, by plain search.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id != c.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
