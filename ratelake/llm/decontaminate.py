"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of an item (all words of a shorter item). A
window is contained in a document only if all of its five-word shingles are,
so with shingles in order of rarity over the whole corpus, the window's rarest
shingle alone is its necessary prefix. Documents are joined to windows on that
one shingle; its position in the window then fixes where the window would lie,
which must be inside the document (length and positional bounds), and the
words there are compared one by one.

Benchmarks are read in slices of bounded size. Each slice's windows go to all
tasks and all documents are held against it, so neither side is shuffled, a
frequent passage costs each document its own matches only, and a larger
benchmark takes more passes, not more memory.

Defined cases: NULL or empty text has no words; items without words or
without id have no windows; equal windows of several items are compared once
and count for each item; items repeating an id are one item; repeated rows
stay; with an empty benchmark nothing is hit. Words are compared as 64-bit
hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.text import NOT_ALNUM, Words, grams, map_texts

WINDOW, SHINGLE = 10, 5
#: Words of items in one slice (8 bytes each in every task).
SLICE_WORDS = 1_000_000
_BITS = 20

_FOUND = "doc_id bigint, copy bigint, n_words bigint, marks array<bigint>, items array<string>"


class Index:
    """Windows of one slice of the benchmark."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW, shingle: int = SHINGLE):
        words = Words(pa.array(texts, pa.string()), NOT_ALNUM)
        h, self.items = words.hashes(), ids
        seen: dict[bytes, int] = {}
        rows, owners = [], []
        for item in range(len(ids)):
            w = h[words.off[item] : words.off[item + 1]]
            for s in range(max(1, len(w) - window + 1) if len(w) else 0):
                part = w[s : s + window]
                at = seen.setdefault(part.tobytes(), len(rows))
                if at == len(rows):
                    rows.append(part)
                    owners.append(set())
                owners[at].add(item)
        self.length = np.array([len(r) for r in rows], np.int64)
        self.words = np.zeros((len(rows), window), np.uint64)
        for i, r in enumerate(rows):
            self.words[i, : len(r)] = r
        self.owner_off = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)
        self.owners = np.array([x for o in owners for x in sorted(o)], np.int64)
        # Shingles by their number of words: (hash, window, place in the window).
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in {min(shingle, len(r)) for r in rows}:
            hs, ws, ps = [], [], []
            for i, r in enumerate(rows):
                if min(shingle, len(r)) == k:
                    g = grams(r, k)
                    hs.append(g)
                    ws.append(np.full(len(g), i))
                    ps.append(np.arange(len(g)))
            self.parts[k] = np.concatenate(hs), np.concatenate(ws), np.concatenate(ps)
        self.prefix: dict[int, tuple] = {}

    def vocabulary(self) -> dict[int, np.ndarray]:
        return {k: np.unique(v[0]) for k, v in self.parts.items()}

    def choose(self, counts: dict[int, dict[int, int]]) -> None:
        """Keep each window's rarest shingle (ties: smaller hash, then first place)."""
        for k, (h, w, p) in self.parts.items():
            n = np.array([counts.get(k, {}).get(int(x), 0) for x in h.view(np.int64)])
            order = np.lexsort((p, h, n, w))
            first = order[np.concatenate([[True], np.diff(w[order]) > 0])]
            first = first[np.argsort(h[first], kind="stable")]
            self.prefix[k] = h[first], w[first], p[first], _bitmap(h[first])
        self.parts = {}


def _bitmap(h: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << _BITS, bool)
    bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return bits


def _among(g: np.ndarray, known: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of ``g`` whose hash is in the sorted array ``known``."""
    maybe = np.flatnonzero(bits[(g >> np.uint64(64 - _BITS)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, g[maybe]), len(known) - 1)
    return maybe[known[at] == g[maybe]]


def _ends(words: Words, k: int, n: int) -> np.ndarray:
    """Whether the ``k`` words from each position on lie in one document."""
    last = np.repeat(words.off[1:], np.diff(words.off))[:n]
    return np.arange(n) + k <= last


def _count(docs: DataFrame, vocabulary: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """Occurrences of the slice's shingles over all documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({k: (v, _bitmap(v)) for k, v in vocabulary.items()})

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column(0), NOT_ALNUM)
        h = words.hashes()
        ks, hs, ns = [], [], []
        for k, (known, bits) in shared.value.items():
            g = grams(h, k)
            if len(g):
                at = _among(g, known, bits)
                at = at[_ends(words, k, len(g))[at]]
                u, n = np.unique(g[at], return_counts=True)
                ks.append(np.full(len(u), k))
                hs.append(u.view(np.int64))
                ns.append(n)
        empty = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or empty)) for x in (ks, hs, ns)], names=["k", "h", "n"])

    rows = docs.mapInArrow(map_texts(run), "k bigint, h bigint, n bigint")
    counts: dict[int, dict[int, int]] = {}
    # At most one row per shingle of the slice.
    for k, h, n in rows.groupBy("k", "h").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(k, {})[h] = n
    shared.unpersist()
    return counts


def _match(words: Words, h: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(first word position, window) of all occurrences of windows in documents."""
    starts, found = [], []
    end = np.repeat(words.off[1:], np.diff(words.off))
    begin = np.repeat(words.off[:-1], np.diff(words.off))
    for k, (known, window, place, bits) in index.prefix.items():
        g = grams(h, k)
        if not len(g) or not len(known):
            continue
        at = _among(g, known, bits)
        lo = np.searchsorted(known, g[at], "left")
        n = np.searchsorted(known, g[at], "right") - lo
        cand = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        pos = np.repeat(at, n)
        w = window[cand]
        s = pos - place[cand]
        length = index.length[w]
        ok = (s >= begin[pos]) & (s + length <= end[pos])  # positional and length bounds
        s, w, length = s[ok], w[ok], length[ok]
        same = np.ones(len(s), bool)
        for j in range(index.words.shape[1]):
            inside = j < length
            here = h[np.minimum(s + j, len(h) - 1)]
            same &= ~inside | (here == index.words[w, j])
        starts.append(s[same])
        found.append(w[same])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(found)


def _intervals(s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Merged [start, end) pairs, flat."""
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])
    return np.column_stack([s[new], e[last]]).ravel()


def _scan(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        index = shared.value
        words = Words(part.column(0), NOT_ALNUM)
        h = words.hashes()
        s, w = _match(words, h, index)
        doc = np.searchsorted(words.off, s, "right") - 1
        marks: list = [[]] * words.n_docs
        items: list = [[]] * words.n_docs
        for d in np.unique(doc):
            mine = doc == d
            first = s[mine] - words.off[d]
            marks[d] = _intervals(first, first + index.length[w[mine]])
            own = {index.items[x] for v in np.unique(w[mine]) for x in index.owners[index.owner_off[v] : index.owner_off[v + 1]]}
            items[d] = sorted(own)
        return pa.RecordBatch.from_arrays(
            [
                part.column(1),
                part.column(2),
                pa.array(np.diff(words.off).astype(np.int64)),
                pa.array(marks, pa.list_(pa.int64())),
                pa.array(items, pa.list_(pa.string())),
            ],
            names=["doc_id", "copy", "n_words", "marks", "items"],
        )

    return docs.mapInArrow(map_texts(run), _FOUND)


def _merge(slices: list[DataFrame]) -> DataFrame:
    """One row per input row from the same rows of every slice."""
    both = slices[0]
    for x in slices[1:]:
        both = both.unionByName(x)
    grouped = both.groupBy("doc_id", "copy").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_set("marks")).alias("marks"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        F.count("*").alias("rows"),
    )

    def run(batches):
        for b in batches:
            marks = []
            for m in b.column(3).to_pylist():
                m = np.array(m, np.int64).reshape(-1, 2)
                marks.append(_intervals(m[:, 0], m[:, 1]) if len(m) else [])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(marks, pa.list_(pa.int64())), *b.columns[4:]], names=b.schema.names
            )

    merged = grouped.mapInArrow(run, _FOUND + ", rows bigint")
    copies = F.array_repeat(F.lit(1), (F.col("rows") / len(slices)).cast("int"))
    return merged.withColumn("_", F.explode(copies)).drop("_", "rows")


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """(doc_id, copy, n_words, marks, items): hit word ranges and items per document."""
    rows = docs.select(
        F.col(text).cast("string").alias("text"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("copy"),
    )
    items = benchmark.where(F.col(item_id).isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col(item_id).cast("string").alias("id"), "text")
    # Words are at least two characters apart: a bound on the words of the benchmark.
    size = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    n = max(1, int(size // slice_words) + 1)
    found = []
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("id"), F.lit(n)) == i).collect()
        index = Index([r[0] for r in part], [r[1] for r in part])
        counts = _count(rows.select("text"), index.vocabulary()) if index.parts else {}
        index.choose(counts)
        found.append(_scan(rows, index) if n == 1 else staged(_scan(rows, index), "bench-slice"))
    return found[0] if n == 1 else _merge(found)


def digest_rows(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    marks = F.col("marks")
    spans = F.when(F.size(marks) > 0, F.sequence(F.lit(1), F.size(marks))).otherwise(F.array().cast("array<int>"))
    signed = F.zip_with(marks, spans, lambda m, i: F.when(i % 2 == 0, m).otherwise(-m))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size(marks) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    found = find_benchmark(docs, benchmark, doc_id, text).where(F.size("marks") > 0)
    bad = found.select(F.col("doc_id").alias("_i"), F.col("copy").alias("_c")).distinct()
    marked = docs.withColumn("_k", F.xxhash64(text))
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("_i")) & (F.col("_k") == F.col("_c"))
    return marked.join(bad, same, "left_anti").select(docs.columns)
