"""Mixing sources to target weights (hash-threshold histograms).

Which documents a source gives is decided by a hash of the id alone: a source
with budget ``T`` and size ``S`` gives every document ``floor(T / S)`` times
and, for the remainder, the documents whose hash lies under the source's
threshold once more. The threshold is found without sorting documents: sizes
are summed per (source, hash bucket); the running sum over a source's buckets
shows the one bucket in which the budget ends; only that bucket is split into
finer buckets, level after level, until single hash values are left.
Thresholds are nested: a larger budget always keeps what a smaller one took.

Defined cases: NULL text has size 0 and is taken 0 words; NULL source is a
source of its own, last in order; rows with one doc_id share a hash and are
taken or left together; an empty table gives an empty result; a source whose
documents are all empty has target 0. The document in which a budget ends is
taken when that brings the sum nearer to the budget, so a source misses its
target by at most half of the documents with that one hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import WORD, staged

#: Hash digits: 15 hex digits of md5 = 60 bits, split into levels of these widths.
HASH_BITS = 60
LEVELS = (12, 12, 12, 24)


def doc_size(text: str) -> Column:
    """Number of words (NULL text: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def doc_hash(doc_id: str) -> Column:
    """60 bits of md5 over the id's text, as BIGINT (NULL id: hash of 'null')."""
    h = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
) -> DataFrame:
    """(src, source_size, target) per source from (src, size) rows.

    Weights repeat over the sources in code point order, NULL last. A target
    stops at ``max_epochs`` times its source; what it cannot use is shared
    again by weight. That is a water level ``target = min(cap, level * weight)``;
    with sources in order of ``cap / weight``, the first ``k`` sources are at
    their cap where the level of the rest does not pass the next ratio. Windows
    here run over one row per source, never over documents.
    """
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("src").isNull(), F.col("src"))
    w = F.element_at(
        F.array(*[F.lit(float(x)) for x in weights]),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    per = per.withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = Window.orderBy("ratio", F.col("src").isNull(), "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (
        per.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("w_rest", F.sum("w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("w_rest"))
        # Of the levels no higher than their own source's ratio, the highest is the water level.
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return per.select("src", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(src, epochs, cut): documents with hash <= cut get one more epoch.

    ``sizes`` has (src, h, size). Each level sums sizes per (source, bucket)
    with map-side partial sums, then a window over the few buckets of one
    source finds where the remaining budget ends. Only rows of that bucket go
    on to the next level.
    """
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("bigint")
    state = targets.select(
        "src", epochs.alias("epochs"), (F.col("target") - epochs * size).alias("left"), F.lit(0).cast("bigint").alias("prefix")
    )
    cuts, shift = [], HASH_BITS
    for bits in LEVELS:
        up, shift = shift, shift - bits
        parent = F.lit(0).cast("bigint") if up == HASH_BITS else F.shiftright("h", up)
        inside = sizes.withColumn("p", parent).join(
            state.withColumnRenamed("src", "s"), F.col("src").eqNullSafe(F.col("s")) & (F.col("p") == F.col("prefix"))
        )
        buckets = inside.groupBy("src", "epochs", "left", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("n"))
        run = Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        buckets = buckets.withColumn("upto", F.sum("n").over(run))
        # The first bucket that reaches past the budget; if none does, the last one.
        end = buckets.groupBy("src", "epochs", "left").agg(
            F.min(F.when(F.col("upto") > F.col("left"), F.struct("b", "n", "upto"))).alias("e"),
            F.max("b").alias("top"),
        )
        end = staged(end, f"mix-level{shift}")  # one row per source
        # A source that ends before its budget does takes everything.
        whole = F.shiftleft(F.col("top") + 1, shift) - 1
        if shift:
            cuts.append(end.where("e IS NULL").select("src", "epochs", whole.alias("cut")))
            left = F.col("left") - (F.col("e.upto") - F.col("e.n"))
            state = end.where("e IS NOT NULL").select("src", "epochs", left.alias("left"), F.col("e.b").alias("prefix"))
        else:
            nearer = 2 * (F.col("e.upto") - F.col("left")) < F.col("e.n")
            cut = F.when(F.col("e").isNull(), whole).when(nearer, F.col("e.b")).otherwise(F.col("e.b") - 1)
            cuts.append(end.select("src", "epochs", cut.alias("cut")))
    return reduce(DataFrame.unionByName, cuts)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, repeats) per document."""
    # Texts are read once; later levels read ids, hashes and sizes only.
    sizes = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("src"),
            doc_hash(doc_id).alias("h"),
            doc_size(text).alias("size"),
        ),
        "mix-sizes",
    )
    targets = staged(source_targets(sizes, weights, share, max_epochs), "mix-targets")
    cuts = staged(thresholds(sizes, targets), "mix-cuts")
    plan = targets.join(
        cuts.select(F.col("src").alias("s"), "epochs", "cut"), F.col("src").eqNullSafe(F.col("s")), "left"
    ).select(F.col("src").alias("s"), "source_size", "target", F.coalesce("epochs", F.lit(0)).alias("epochs"), F.coalesce("cut", F.lit(-1)).alias("cut"))
    joined = sizes.join(plan, F.col("src").eqNullSafe(F.col("s")))
    repeats = F.least(F.col("epochs") + (F.col("h") <= F.col("cut")).cast("bigint"), F.lit(int(max_epochs)))
    return joined.select(
        "doc_id", F.col("src").alias("source"), "h", "size", "source_size", "target", repeats.alias("repeats")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it.

    The decision depends on source and id only, so it is joined back on those
    two with one row per pair.
    """
    plan = mix(docs, **options)
    doc_id, source = options.get("doc_id", "doc_id"), options.get("source", "source")
    plan = plan.groupBy(F.col("doc_id").alias("_i"), F.col("source").alias("_s")).agg(F.max("repeats").alias("_n"))
    plan = plan.where("_n > 0")
    out = docs.join(plan, docs[doc_id].eqNullSafe(F.col("_i")) & docs[source].cast("string").eqNullSafe(F.col("_s")))
    out = out.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return out.drop("_i", "_s", "_n", "_k")


#: The same rows in DuckDB: the exact cut by a running sum over sorted hashes.
ORACLE_SQL = r"""
WITH s AS (
  SELECT doc_id, source AS src,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
p AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY src),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY src IS NULL, src) - 1) % 3 + 1 AS INT)]::DOUBLE AS w FROM p),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS ratio FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM p) * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY ratio, src IS NULL, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY ratio, src IS NULL, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM r),
t AS (SELECT src, source_size, least(cap, coalesce((SELECT max(lv) FROM l WHERE lv <= ratio) * w, cap)) AS target FROM l),
e AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS epochs FROM t),
g AS (SELECT src, h, sum(size) AS n FROM s GROUP BY src, h),
c AS (SELECT g.src, g.h, g.n, sum(g.n) OVER (PARTITION BY g.src ORDER BY g.h) AS upto, e.target - e.epochs * e.source_size AS rest
      FROM g JOIN e ON g.src IS NOT DISTINCT FROM e.src),
f AS (SELECT src, h, n, upto, rest, min(CASE WHEN upto > rest THEN h END) OVER (PARTITION BY src) AS eh FROM c),
k AS (SELECT src, h, (eh IS NULL OR h < eh OR (h = eh AND 2 * (upto - rest) < n)) AS more FROM f)
SELECT s.doc_id, s.size, e.source_size, e.target,
       CAST(s.size * least(e.epochs + CASE WHEN k.more THEN 1 ELSE 0 END, 2) AS BIGINT) AS taken
FROM s JOIN e ON s.src IS NOT DISTINCT FROM e.src JOIN k ON s.src IS NOT DISTINCT FROM k.src AND s.h = k.h
"""
