"""Prefix trie of conversations by the Euler-tour technique.

Conversations that start with the same turns share them: a node of the trie is
a distinct sequence of first turns, its members are the conversations that
start with it. A node's sums over its subtree are found without walking the
trie: every node gets an *enter* and an *exit* arc, each arc knows the next one
of the tour (enter: the first child's enter, else the own exit; exit: the next
sibling's enter, else the parent's exit), the tour is ranked as a linked list
(``lists``), and with running totals at the arcs' positions a node's subtree
is the total at its exit less the total before its enter.

A node is known by its depth and the sum of 120-bit digests of (depth, turn)
over its turns; sums of digests are running totals, so a very long conversation
is worked on in blocks. Texts are read once, for digests and lengths.

:func:`rebuilt` mixes conversations so that some share first turns; the trie
takes any table of (conv_id, depth, digest, n_bytes).

Defined cases: turns are ordered by turn (NULL first), then by a digest of role
and text; repeated rows are turns of their own; NULL role or text is empty;
rows with a NULL conversation id belong to no conversation; a conversation
without turns is a member of the root alone; an empty table gives an empty
result. The ids of a node's ending conversations are hashed as they stream by,
sorted, in texts of at most ``ENDS`` ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.lists import FAN, SMALL, followers, in_order, list_places, numbered, running_totals

#: Conversations are rebuilt in groups of so many ids, from at most ``HEADS - 1`` turns of the first one.
GROUP, HEADS = 5, 9
ENDS = 512


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, digest, n_bytes): turns in order, depth from 1."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256).alias("digest"),
        F.octet_length(t).cast("bigint").alias("n_bytes"),
    )
    rows, _ = in_order(rows, ["conv_id", F.col("turn").asc_nulls_first(), "digest"], "turns")
    # Turns of a conversation before each range partition that it reaches into.
    parts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    upto = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "first", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")
    )
    out = rows.join(before, (F.col("conv_id") == F.col("_c")) & (F.col("part") == F.col("_p")))
    return out.select("conv_id", (F.col("place") - F.col("first") + F.col("before") + 1).alias("depth"), "digest", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) and turns of the rebuilt conversations.

    The first ``h`` turns of conversation ``c`` are those of ``c - c % 5``,
    where ``h`` is the CRC-32 of the id modulo 9; its own later turns follow.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = turns.groupBy("conv_id").agg(F.max("depth").alias("n")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % GROUP})
    base = convs.select(F.col("conv_id").alias("_b"), F.col("n").alias("n_base"))
    convs = convs.join(base, F.col("base") == F.col("_b"), "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = staged(convs.select("conv_id", "base", "h", "taken", "n_turns"), "convs")

    # At most eight turns of a first conversation go to at most nine others.
    shared = turns.where((F.col("depth") < HEADS) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "_b")
    heads = convs.join(shared, (F.col("base") == F.col("_b")) & (F.col("depth") <= F.col("h"))).select("conv_id", "depth", "digest", "n_bytes")
    own = turns.join(convs.select(F.col("conv_id").alias("_c"), "h", "taken"), F.col("conv_id") == F.col("_c")).where(F.col("depth") > F.col("h"))
    own = own.select("conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_bytes")
    return convs.select("conv_id", "n_turns"), heads.unionByName(own)


def _half(hexed: Column, at: int) -> Column:
    return F.conv(F.substring(hexed, at, 15), 16, 10).cast("decimal(20,0)")


def _nodes(convs: DataFrame, turns: DataFrame, longest: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """Nodes with a number, and the node key of every (conversation, depth)."""
    x = F.sha2(F.concat_ws(":", "depth", "digest").cast("binary"), 256)
    rows = turns.withColumns({"x": x, "place": F.col("depth") - 1})
    rows = rows.withColumns({"own_hi": _half(F.col("x"), 1), "own_lo": _half(F.col("x"), 16)})
    rows = rows.select("conv_id", "depth", "place", "n_bytes", "own_hi", "own_lo", F.col("own_hi").cast("decimal(38,0)").alias("hi"), F.col("own_lo").cast("decimal(38,0)").alias("lo"))
    paths = running_totals(rows, ["conv_id"], "place", ["hi", "lo"], longest, fan)
    up = [(F.col(k) - F.col(f"own_{k}")).cast("decimal(38,0)").alias(f"up_{k}") for k in ("hi", "lo")]
    paths = staged(paths.select("conv_id", "depth", "n_bytes", F.col("hi").cast("decimal(38,0)").alias("hi"), F.col("lo").cast("decimal(38,0)").alias("lo"), *up), "paths")
    nodes = paths.groupBy("depth", "hi", "lo").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("up_hi").alias("up_hi"),
        F.max("up_lo").alias("up_lo"),
    )
    zero = F.lit(0).cast("decimal(38,0)")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("conv_id IS NOT NULL")
    root = root.select(F.lit(0).cast("bigint").alias("depth"), zero.alias("hi"), zero.alias("lo"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("n_bytes"), *[F.lit(None).cast("decimal(38,0)").alias(c) for c in ("up_hi", "up_lo")])
    # In this order the nodes of one path stand together, the root first.
    return numbered(root.unionByName(nodes), ["conv_id", "depth"], "node", "nodes"), paths


def _ends(convs: DataFrame, paths: DataFrame, nodes: DataFrame, ends: int) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end."""
    last = paths.join(convs.select(F.col("conv_id").alias("_c"), "n_turns"), (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("n_turns")))
    key = nodes.select("node", F.col("depth").alias("_d"), F.col("hi").alias("_hi"), F.col("lo").alias("_lo"))
    last = last.join(key, (F.col("depth") == F.col("_d")) & (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo"))).select("node", "conv_id")
    rows = last.unionByName(convs.where("n_turns = 0").select(F.lit(0).cast("bigint").alias("node"), "conv_id"))
    rows = rows.groupBy("node", (F.col("conv_id") - F.pmod("conv_id", F.lit(ends))).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n == node:
                    state.update(b",")
                else:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256()
                state.update(ids.encode())
            yield _digests(done)
        if state:
            yield _digests([(node, state.hexdigest())])

    sorted_ = rows.repartition("node").sortWithinPartitions("node", "chunk")
    return sorted_.mapInArrow(run, "node bigint, ends_sha256 string")


def _digests(done: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n for n, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names=["node", "ends_sha256"]
    )


def prefix_trie(convs: DataFrame, turns: DataFrame, fan: int = FAN, small: int = SMALL, ends: int = ENDS) -> DataFrame:
    """One row per node of the trie.

    ``convs`` has (conv_id, n_turns), ``turns`` (conv_id, depth, digest,
    n_bytes) with depths from 1 to ``n_turns``.
    """
    turns = staged(turns, "rebuilt")
    longest = convs.agg(F.max("n_turns")).first()[0] or 0
    nodes, paths = _nodes(convs, turns, longest, fan)
    nodes = staged(nodes, "trie")
    size = nodes.count()

    up = nodes.select((F.col("depth") + 1).alias("_d"), F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    same = (F.col("depth") == F.col("_d")) & (F.col("up_hi") == F.col("_hi")) & (F.col("up_lo") == F.col("_lo"))
    tree = staged(nodes.join(up, same, "left").select("node", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "n_bytes"), "tree")
    below = tree.where("parent IS NOT NULL")
    children = below.groupBy(F.col("parent").alias("_v")).agg(F.count(F.lit(1)).alias("n_children"), F.min("node").alias("child"))
    beside = followers(below, "parent", "node", size, fan).select(F.col("id").alias("_s"), "following")
    tree = tree.join(children, F.col("node") == F.col("_v"), "left").join(beside, F.col("node") == F.col("_s"), "left")
    tree = staged(tree.withColumn("n_children", F.coalesce("n_children", F.lit(0))).drop("_v", "_s"), "tree-links")

    # Arcs 2v (enter) and 2v + 1 (exit), each with the next one of the tour.
    enter, leave = 2 * F.col("node"), 2 * F.col("node") + 1
    after_enter = F.coalesce(2 * F.col("child"), leave)
    after_leave = F.coalesce(2 * F.col("following"), 2 * F.col("parent") + 1, F.lit(-1).cast("bigint"))
    both = [F.struct(a.alias("id"), b.alias("next")) for a, b in ((enter, after_enter), (leave, after_leave))]
    arcs = tree.select(F.explode(F.array(*both)).alias("a")).select("a.id", "a.next")
    places = list_places(arcs, 2 * size, small)

    # A leaf and a node's own savings stand at its enter arc.
    gains = tree.select(
        (2 * F.col("node")).alias("_a"),
        (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    at = places.join(gains, F.col("id") == F.col("_a"), "left").select(
        "id", "position", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("leaves", "saved")]
    )
    at = staged(at, "tour")
    totals = running_totals(at.withColumns({"own_leaves": F.col("leaves"), "own_saved": F.col("saved")}), [], "position", ["leaves", "saved"], 2 * size, fan)
    entering = F.col("id") % 2 == 0
    sums = totals.groupBy(F.floor(F.col("id") / 2).cast("bigint").alias("_t")).agg(
        *[
            (F.max(F.when(~entering, F.col(c))) - F.max(F.when(entering, F.col(c) - F.col(f"own_{c}")))).alias(f"sum_{c}")
            for c in ("leaves", "saved")
        ]
    )
    ended = _ends(convs, paths, nodes, ends).withColumnRenamed("node", "_e")
    out = tree.join(sums, F.col("node") == F.col("_t")).join(ended, F.col("node") == F.col("_e"), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("sum_leaves").cast("bigint").alias("n_leaves"),
        F.col("sum_saved").cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, fan: int = FAN, small: int = SMALL, ends: int = ENDS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns = staged(ordered_turns(conversations), "ordered")
    return prefix_trie(*rebuilt(turns), fan=fan, small=small, ends=ends)


#: The same rows in DuckDB: every node with the list of its turns, subtrees by joins with all prefixes.
ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
               lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
             lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS later, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY later, pos) AS depth FROM r),
m AS (
  SELECT conv_id, depth, strlen(text) AS n_bytes,
         CAST(list(CAST(length(role) AS VARCHAR) || ':' || role || text) OVER (PARTITION BY conv_id ORDER BY depth) AS VARCHAR) AS path
  FROM d
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id),
n AS (
  SELECT m.depth, m.path, min(m.conv_id) AS conv_id, count(*) AS n_convs, max(m.n_bytes) AS n_bytes,
         sha256(coalesce(string_agg(CASE WHEN e.depth = m.depth THEN CAST(m.conv_id AS VARCHAR) END, ',' ORDER BY m.conv_id), '')) AS ends_sha256
  FROM m JOIN e ON m.conv_id = e.conv_id GROUP BY m.depth, m.path),
p AS (
  SELECT n.*, u.conv_id AS parent_conv_id FROM n JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth
  LEFT JOIN m w ON w.conv_id = n.conv_id AND w.depth = n.depth - 1
  LEFT JOIN n u ON u.depth = w.depth AND u.path = w.path),
k AS (SELECT p.conv_id, p.depth, count(q.conv_id) AS n_children
      FROM p LEFT JOIN p q ON q.parent_conv_id = p.conv_id AND q.depth = p.depth + 1 GROUP BY p.conv_id, p.depth),
s AS (
  SELECT v.conv_id, v.depth, CAST(sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum((p.n_convs - 1) * p.n_bytes) AS BIGINT) AS saved_tokens
  FROM p JOIN k ON k.conv_id = p.conv_id AND k.depth = p.depth
  JOIN m ON m.conv_id = p.conv_id AND m.depth <= p.depth
  JOIN n v ON v.depth = m.depth AND v.path = m.path GROUP BY v.conv_id, v.depth)
SELECT p.conv_id, CAST(p.depth AS BIGINT) AS depth, p.parent_conv_id, CAST(p.n_convs AS BIGINT) AS n_convs,
       CAST(k.n_children AS BIGINT) AS n_children, s.n_leaves, s.saved_tokens, p.ends_sha256
FROM p JOIN k ON k.conv_id = p.conv_id AND k.depth = p.depth JOIN s ON s.conv_id = p.conv_id AND s.depth = p.depth
"""
