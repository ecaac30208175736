"""MinHash near-duplicates by a multi-index Hamming join.

A document's set of distinct 5-word shingles has a signature of 48 minhash
values of 16 bits. Signatures are split into 8 chunks of 6 values. If two
signatures differ in at most 15 values, some chunk differs in at most one
(pigeonhole: 8 chunks with two errors each need 16), so the allowed chunk
errors are enumerated: every chunk is indexed 6 times, each time without one
of its values. All pairs within 15 of 48 values meet under some key. Two
documents at similarity 0.85 differ in 7.2 values on average; the chance that
such a pair meets under no key is under 0.00001. For other similarities the
number of chunks is the smallest that keeps this chance (11 at 0.80), and the
distance in the last step follows it.

Work per group of similar texts stays linear. Documents with equal sets are
one node. Under each key all nodes are first held against one node of the key,
pairs are confirmed on full sets, and confirmed links joined to components. Of
the nodes under one key that are still in different components only those go
on whose shingles found in any other such node would suffice. They get a
second, longer signature, by which a pair that is far below the similarity (5
standard deviations) is left out before it is written, and are held against
other nodes of their keys in two more rounds; what is then still in
different components under one key is held against each other. So no pair
inside a group that already hangs together is made, and no link that could
join two components is left out.

Defined cases: documents without words or text have an empty set and link with
nothing (own component); with fewer than 5 words the whole sequence is the one
shingle; equal rows are copies of one document; rows of one doc_id with
different texts are one document that has the links of each; a NULL doc_id
links with nothing and has component NULL; an empty table gives no rows.
Shingles are 64-bit hashes of whole word sequences.
"""

from __future__ import annotations

import math
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.components import components
from ratelake.llm.text import SMALL, Words, map_texts, mix64, shingles

#: Values of the second signature, one bit each, of nodes left after the first round.
FINE = 4096
#: Those that are compared first.
COARSE = 1024
#: Rounds against one node of a key; in the one after them all that are left meet.
LAST = 3
#: Ids of nodes that are not named by a document lie from here on.
UNNAMED = 1 << 62
#: Values of a chunk; highest chance that a pair at the similarity shares no key;
#: lowest percent (chunks needed grow steeply below).
WIDTH, MISSED, LEAST = 6, 1e-5, 50


def _far(values: int, p: float) -> int:
    """From how many differing values on a pair does not reach ``p`` (5 standard deviations)."""
    return math.ceil(values * (1 - p) + 5 * math.sqrt(values * p * (1 - p))) + 1


def _factors(values: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 62, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 62, values, dtype=np.uint64)


def _signature(flat: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """16 bits of the lowest hash of each set (sets start at ``at``) under each (a, b)."""
    sig = np.zeros((len(at), len(a)), np.uint16)
    for i in range(len(a)):
        low = np.minimum.reduceat((flat * a[i] + b[i]) >> np.uint64(16), at)
        sig[:, i] = (low & np.uint64(0xFFFF)).astype(np.uint16)
    return sig


class Plan(NamedTuple):
    """Signature for a similarity: chunks, hash factors, and from how many
    differing values on pairs do not reach it."""

    chunks: int
    values: int
    far: int
    a: np.ndarray
    b: np.ndarray
    key: np.ndarray


@cache
def plan_for(percent: int) -> Plan:
    if not LEAST <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST} to 100, not {percent}")
    p = percent / 100
    lost = 1 - p**WIDTH - WIDTH * (1 - p) * p ** (WIDTH - 1)  # more than one error in a chunk
    chunks = max(1, math.ceil(math.log(MISSED) / math.log(lost))) if lost > 1e-12 else 1
    values = chunks * WIDTH
    far = _far(values, p)
    rng = np.random.default_rng(20240229)
    a = rng.integers(1, 1 << 62, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 62, values, dtype=np.uint64)
    key = rng.integers(1, 1 << 62, (chunks, WIDTH, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return Plan(chunks, values, far, a, b, key)


_DESCRIBED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, sig binary"


def _sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    words = Words(texts)
    h, off = shingles(words.hashes(), words.off, k)
    return [np.unique(h[off[d] : off[d + 1]]) for d in range(words.n_docs)]


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and two fingerprints of sets; their elements in a row and where the full ones start."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    at = np.concatenate([[0], np.cumsum(n)])[np.flatnonzero(n)]
    a, b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    if len(at):
        a[n > 0] = np.add.reduceat(mix64(flat ^ np.uint64(0x5BD1E995)), at)
        b[n > 0] = np.add.reduceat(mix64(flat + np.uint64(0x27D4EB2F)), at)
    return n, a.view(np.int64), b.view(np.int64), flat, at


def describe(docs: DataFrame, plan: Plan, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """Per document: set size, two fingerprints of the set, signature."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        n, a, b, flat, at = _fingerprints(_sets(part.column(1), k))
        sig = np.zeros((len(n), plan.values), np.uint16)
        if len(at):
            sig[n > 0] = _signature(flat, at, plan.a, plan.b)
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n), pa.array(a), pa.array(b), pa.array([r.tobytes() for r in sig], pa.binary())],
            names=["doc_id", "n_shingles", "set_a", "set_b", "sig"],
        )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(map_texts(run, limit=SMALL), _DESCRIBED)


def _named(nodes: DataFrame) -> DataFrame:
    """``nodes`` (set_a, set_b, n_shingles, rep, ...) with ``node``: the id of the
    smallest document that has the set, or, where that one names another set
    already (it has several texts), a number from ``UNNAMED`` on."""
    print_ = F.struct("set_a", "set_b", "n_shingles")
    first = nodes.groupBy("rep").agg(F.min(print_).alias("_f"))
    other = F.xxhash64("set_a", "set_b", "n_shingles").bitwiseAND(F.lit(UNNAMED - 1)) + F.lit(UNNAMED)
    return nodes.join(first, "rep").withColumn("node", F.when(F.col("_f") == print_, F.col("rep")).otherwise(other)).drop("_f")


def chunk_keys(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(node, keys): every chunk of a signature without each of its values, a key each."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, plan.chunks, WIDTH)
            keys = np.empty((len(sig), plan.chunks, WIDTH), np.uint64)
            for out in range(WIDTH):
                weight = plan.key[:, out, :].copy()
                weight[:, out] = 0
                acc = ((sig.astype(np.uint64) + np.uint64(1)) * weight).sum(axis=2, dtype=np.uint64)
                keys[:, :, out] = mix64(acc ^ plan.key[:, out, out])
            off = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * plan.values)
            arrays = pa.ListArray.from_arrays(off, pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), arrays], names=["node", "keys"])

    return nodes.select("node", "sig").mapInArrow(run, "node bigint, keys array<bigint>")


def _full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(node, s): the full shingle sets of the wanted nodes."""
    wanted = staged(nodes.join(wanted, "node", "left_semi").select("node", "rep", "set_a", "set_b", "n_shingles"), "dup-wanted")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("rep"), F.col(text).cast("string").alias("text"))
    # The ids alone are a small table, so that texts need no shuffle where few are wanted.
    reps = staged(wanted.select("rep").distinct(), "dup-reps")
    rows = rows.join(reps, "rep", "left_semi").select("text")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(part.column(0), k)
        n, a, b, _, _ = _fingerprints(sets)
        made = [pa.array(n), pa.array(a), pa.array(b), pa.array([s.tobytes() for s in sets], pa.binary())]
        return pa.RecordBatch.from_arrays(made, names=["n_shingles", "set_a", "set_b", "s"])

    # A document may have several texts: each set goes to the node it belongs to.
    sets = rows.mapInArrow(map_texts(run, limit=SMALL), "n_shingles bigint, set_a bigint, set_b bigint, s binary")
    print_ = ["set_a", "set_b", "n_shingles"]
    return sets.join(wanted.drop("rep"), print_).dropDuplicates(print_).select("node", "s")


def confirm(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int, doc_id: str, text: str, k: int) -> DataFrame:
    """The (u, v) pairs whose full sets reach ``percent``: 100 * shared >= percent * union."""
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = staged(_full_sets(docs, nodes, wanted, doc_id, text, k), "dup-sets")
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("s").alias("su")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("s").alias("sv")), "v"
    )

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                ok = 0
                if len(small) * 100 >= percent * len(large) and len(small):
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    shared = int((large[at] == small).sum())
                    ok = 100 * shared >= percent * (len(p) + len(q) - shared)
                keep.append(bool(ok))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "su", "sv").mapInArrow(run, "u bigint, v bigint").distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, k: int = 5
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    plan = plan_for(percent)
    described = staged(describe(docs, plan, doc_id, text, k), "dup-described")
    full = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Documents with equal sets are one node.
    nodes = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    nodes = staged(_named(nodes), "dup-nodes")
    keys = chunk_keys(nodes, plan).select("node", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = staged(keys.join(shared, "key"), "dup-members")
    same = full.join(
        nodes.select("set_a", "set_b", "n_shingles", "node"), ["set_a", "set_b", "n_shingles"]
    ).select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    links, tested = same.where("u != v"), None
    label, fine = None, False
    for round_ in range(LAST + 1):
        rows = members.withColumn("component", F.col("node"))
        if label is not None:
            rows = members.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
            split = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
            rows = staged(rows.join(split.select("key"), "key", "left_semi"), "dup-split")
        if round_ == 1:
            rows = staged(_able(rows, nodes, docs, percent, doc_id, text, k), "dup-able")
            members, fine = rows.drop("component"), True
        if round_ < LAST:
            # First one node for as many keys as possible, then another one per key:
            # a node left over meets as many members of its group as it has keys.
            pick = F.xxhash64("node") if round_ == 0 else F.xxhash64("node", "key", F.lit(round_))
            taken = F.struct("node", "component", *(["bits"] if fine else []))
            hub = rows.groupBy("key").agg(F.min_by(taken, pick).alias("hub"))
            pairs = rows.join(hub, "key").where("component != hub.component")
            pairs = (pairs.where(_near("bits", "hub.bits", percent)) if fine else pairs).select(F.col("node").alias("u"), F.col("hub.node").alias("v"))
        else:
            pairs = _across(rows, nodes, percent)
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = staged(pairs, f"dup-pairs{round_}")
        if pairs.isEmpty():
            if round_ == 0:
                label = components(links)
            if round_ in (0, LAST) or rows.isEmpty():
                break
            continue
        found = staged(confirm(docs, nodes, pairs, percent, doc_id, text, k), f"dup-links{round_}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = links.unionByName(found)
        label = staged(components(links), f"dup-labels{round_}")
    out = described.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _able(rows: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, doc_id: str, text: str, k: int) -> DataFrame:
    """``rows`` of nodes that can still be similar to another one, with bounds and
    their second signatures (``bits``).

    A shingle that no other of these nodes holds is in no intersection. What is
    left of a set bounds all its intersections, which rules out most members of
    a loose group (copies with edits of their own) before pairs are made.
    """
    sets = staged(_full_sets(docs, nodes, rows.select("node").distinct(), doc_id, text, k), "dup-left")

    def flat(batches):
        for b in batches:
            for node, s in zip(b.column(0).to_pylist(), b.column(1)):
                s = np.frombuffer(s.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), node)), pa.array(s)], names=["node", "s"])

    held = sets.mapInArrow(flat, "node bigint, s bigint")
    alone = held.groupBy("s").agg(F.min("node").alias("node"), F.max("node").alias("hi")).where("node = hi")
    alone = alone.groupBy("node").agg(F.count("*").alias("alone"))
    size = nodes.select("node", F.col("n_shingles").alias("n")).join(alone, "node", "left")
    size = size.select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("most"))
    able = staged(size.where(100 * F.col("most") >= percent * F.col("n")), "dup-bounds")
    a, b = _factors(FINE, 20240301)

    def sign(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                sets_ = [np.frombuffer(s.as_buffer(), np.uint64) for s in part.column(1)]
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets_])])[:-1]
                low = _signature(np.concatenate(sets_), at, a, b) & np.uint16(1)
                bits = np.packbits(low.astype(np.uint8), axis=1).view(np.int64)
                off = pa.array(np.arange(len(sets_) + 1, dtype=np.int32) * bits.shape[1])
                arrays = pa.ListArray.from_arrays(off, pa.array(bits.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), arrays], names=["node", "bits"])

    left = sets.join(able.select("node"), "node", "left_semi").mapInArrow(sign, "node bigint, bits array<bigint>")
    left = staged(left, "dup-fine").join(able, "node")
    return rows.select("key", "node", "component").join(left, "node").select("key", "node", "component", "n", "most", "bits")


def _near(a: str, b: str, percent: int) -> Column:
    """Whether two second signatures are near enough: a value that differs shows in its bit half of the time."""
    p = 1 - (1 - percent / 100) / 2
    first = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(COARSE // 64)]
    differing = F.zip_with(F.col(a), F.col(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    total = F.aggregate(differing, F.lit(0), lambda n, x: n + x)
    return (sum(first[1:], first[0]) < _far(COARSE, p)) & (total < _far(FINE, p))


def _across(able: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes under one key but in different components, within their
    bounds and near by their second signatures; each pair under the first key it shares only."""
    own = chunk_keys(nodes.join(able.select("node").distinct(), "node", "left_semi"), plan_for(percent))
    rows = able.join(own, "node")
    rows = rows.withColumn("before", F.slice("keys", F.lit(1), F.array_position("keys", F.col("key")).cast("int") - 1)).drop("keys")
    a, b = rows.alias("a"), rows.alias("b")
    shared = F.least("a.most", "b.most")
    near = 100 * shared >= percent * (F.col("a.n") + F.col("b.n") - shared)
    first = ~F.coalesce(F.arrays_overlap("a.before", "b.before"), F.lit(False))
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") < F.col("b.component")) & near & first & _near("a.bits", "b.bits", percent))
    return pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One document of each group, all its columns; rows that repeat the kept id collapse to one, rows without an id stay."""
    found = near_duplicates(docs, doc_id, text, percent).where("kept AND doc_id IS NOT NULL")
    kept = found.select(F.col("doc_id").cast(docs.schema[doc_id].dataType).alias(doc_id)).distinct()
    one = docs.join(kept, doc_id, "left_semi")
    # Of several texts of one id the one with the smallest digest stays, whatever the order of rows.
    digest = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)
    first = F.row_number().over(Window.partitionBy(doc_id).orderBy(digest))
    one = one.withColumn("__first", first).where("__first = 1").select(docs.columns)
    return one.unionByName(docs.where(F.col(doc_id).isNull()))
