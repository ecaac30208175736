"""Numbering, running totals and list ranking over tables of any size.

No step brings a whole table, key or list into one task: order is made by
range partitions, running totals by blocks of at most ``FAN`` rows and totals
of blocks, and a linked list is ranked by contraction: stretches of the list
that lie together are joined in the tasks that hold them, every 16th element
or so is kept, the others are linked to the next kept one by pointer doubling,
and the kept ones are ranked the same way. Only a rest of at most ``SMALL``
elements is walked in one task. Every round is written to the shared folder
and read again; written rounds are removed once nothing reads them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import drop_scratch, scratch

FAN = 4096
SMALL = 2048
#: One element in so many is kept in a round of list ranking.
KEEP = 16


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written to the shared folder, and their path."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def in_order(df: DataFrame, order: Sequence[str | Column], name: str) -> tuple[DataFrame, str]:
    """Rows in range partitions, with ``part`` and ``place`` (from 0 within the part).

    Rows equal in ``order`` may fall into two parts, so many equal rows are no
    one task's work; which of them comes first is open.
    """
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row").drop("_row")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stage(rows.withColumns({"part": F.spark_partition_id(), "place": place}), name)


def numbered(df: DataFrame, order: Sequence[str | Column], number: str, name: str) -> DataFrame:
    """Rows with their number (0, 1, 2, ...) in ``order``."""
    rows, _ = in_order(df, order, name)
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    parts = parts.select(F.col("part").alias("_p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_b"))
    out = rows.join(parts, F.col("part") == F.col("_p"))
    return out.withColumn(number, F.col("place") + F.col("_b")).drop("part", "place", "_p", "_b")


def running_totals(df: DataFrame, keys: Sequence[str], place: str, sums: Sequence[str], size: int, fan: int = FAN) -> DataFrame:
    """Each row with its key's sums up to and including its ``place``.

    A key's places are 0, 1, 2, ... without gaps, below ``size``. The
    totals of blocks of ``fan`` places are summed up the same way.
    """
    block = f"_{place}"  # blocks of blocks get longer names
    rows = df.withColumn(block, F.floor(F.col(place) / F.lit(fan)).cast("bigint"))
    upto = Window.partitionBy(*keys, block).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({c: F.sum(c).over(upto) for c in sums})
    if size <= fan:
        return out.drop(block)
    totals = rows.groupBy(*keys, block).agg(*[F.sum(c).alias(c) for c in sums])
    whole = running_totals(totals, keys, block, sums, -(-size // fan), fan)
    renamed = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]
    shifted = whole.select(*renamed, (F.col(block) + 1).alias("_after"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(sums)])
    same = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(keys)]
    out = out.join(shifted, [*same, F.col(block) == F.col("_after")], "left")
    added = {c: F.col(c) + F.coalesce(F.col(f"_t{i}"), F.lit(0).cast(df.schema[c].dataType)) for i, c in enumerate(sums)}
    return out.withColumns(added).select(*df.columns)


def followers(df: DataFrame, key: str, id_: str, size: int, fan: int = FAN) -> DataFrame:
    """(key, id, following): the next larger id under the same key (NULL: none).

    Ids are different whole numbers from 0 to ``size - 1``. A key with very
    many ids is worked on in stretches of ``fan`` numbers.
    """
    rows = df.select(F.col(key).alias("key"), F.col(id_).alias("id"))
    if size <= fan:
        return rows.withColumn("following", F.lead("id").over(Window.partitionBy("key").orderBy("id")))
    rows = rows.withColumn("block", F.floor(F.col("id") / F.lit(fan)).cast("bigint"))
    inner = Window.partitionBy("key", "block").orderBy("id")
    rows = rows.withColumn("following", F.lead("id").over(inner))
    firsts = rows.groupBy("key", "block").agg(F.min("id").alias("first"))
    after = followers(firsts, "key", "block", -(-size // fan), fan).where("following IS NOT NULL")
    first = firsts.select(F.col("key").alias("_k"), F.col("block").alias("_b"), "first")
    after = after.join(first, (F.col("key") == F.col("_k")) & (F.col("following") == F.col("_b")))
    after = after.select(F.col("key").alias("_k"), F.col("id").alias("_b"), "first")
    out = rows.join(after, (F.col("key") == F.col("_k")) & (F.col("block") == F.col("_b")) & F.col("following").isNull(), "left")
    return out.select("key", "id", F.coalesce("following", "first").alias("following"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that stay inside a batch are followed there.

    Each element gets the first element of its stretch (``head``) and its place
    in it; a head also gets the stretch's length and what comes after it.
    """
    for batch in batches:
        id_ = batch.column(0).to_numpy()
        order = np.argsort(id_, kind="stable")
        target = batch.column(1).to_numpy()
        at = np.minimum(np.searchsorted(id_, target, sorter=order), len(id_) - 1)
        inside = order[at]
        inside[id_[inside] != target] = -1
        has_before = np.zeros(len(id_), bool)
        has_before[inside[inside >= 0]] = True
        link, after = inside.tolist(), target.tolist()
        head, place = [0] * len(link), [0] * len(link)
        length, out = [0] * len(link), [-1] * len(link)
        for h in np.flatnonzero(~has_before).tolist():
            i, n = h, 0
            while i >= 0:
                head[i], place[i], last = h, n, i
                i, n = link[i], n + 1
            length[h], out[h] = n, after[last]
        made = [batch.column(0), pa.array(id_[np.array(head, np.int64)]), *[pa.array(x, pa.int64()) for x in (place, length, out)]]
        yield pa.RecordBatch.from_arrays(made, names=["id", "head", "place", "length", "next"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of a short list: the sum of ``length`` from each element to the end."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    whole = pa.Table.from_batches(parts)
    ids, targets, lengths = (c.to_pylist() for c in whole.columns)
    link, size = dict(zip(ids, targets)), dict(zip(ids, lengths))
    i, order = next(iter(link.keys() - set(targets))), []
    while i != -1:
        order.append(i)
        i = link[i]
    ranks = np.cumsum([size[i] for i in reversed(order)])[::-1]
    yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(ranks, pa.int64())], names=["id", "rank"])


def _kept(column: str, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), F.col(column)), F.lit(KEEP)) == 0


def rank_elements(links: DataFrame, size: int, small: int = SMALL, level: int = 0) -> DataFrame:
    """(id, rank): the sum of ``length`` from each element to the end of the list.

    ``links`` has (id, next, length) of one list without cycles; ``next`` of the last is -1.
    """
    if size <= small:
        return links.select("id", "next", "length").repartition(1).mapInArrow(_walk, "id bigint, rank bigint")
    spark = links.sparkSession
    state, path = stage(links.select("id", F.col("next").alias("target"), F.col("length").alias("dist")), "rank-links")
    ahead = (F.col("target") != -1) & ~_kept("target", level)
    while not state.where(ahead).isEmpty():
        going, there = state.where(ahead).alias("a"), state.alias("b")
        gone = going.join(there, F.col("a.target") == F.col("b.id")).select(
            F.col("a.id").alias("id"), F.col("b.target").alias("target"), (F.col("a.dist") + F.col("b.dist")).alias("dist")
        )
        older = path
        state, path = stage(state.where(~ahead).unionByName(gone), "rank-links")
        drop_scratch(spark, older)
    kept = state.where(_kept("id", level)).select("id", F.col("target").alias("next"), F.col("dist").alias("length"))
    above = rank_elements(kept, kept.count(), small, level + 1).select(F.col("id").alias("_i"), "rank")
    out = state.join(above, F.col("target") == F.col("_i"), "left")
    return out.select("id", (F.col("dist") + F.coalesce("rank", F.lit(0))).alias("rank"))


def list_places(links: DataFrame, size: int, small: int = SMALL) -> DataFrame:
    """(id, position): the place (0, 1, 2, ...) of each element of a linked list.

    ``links`` has (id, next); ``next`` of the last is -1; ids near each other
    should be near each other in the list where possible.
    """
    near = links.select("id", "next").repartitionByRange("id").sortWithinPartitions("id")
    inside, _ = stage(near.mapInArrow(_stretches, "id bigint, head bigint, place bigint, length bigint, next bigint"), "rank-stretches")
    heads = inside.where("place = 0").select("id", "next", "length")
    ranks = rank_elements(heads, heads.count(), small).select(F.col("id").alias("_h"), "rank")
    out = inside.join(ranks, F.col("head") == F.col("_h"))
    return out.select("id", (F.lit(size) - F.col("rank") + F.col("place")).alias("position"))
