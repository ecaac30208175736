"""How far the sources of a language differ in their use of terms (in-mapper stripes).

Every task folds whole documents into *stripes*: per (language, term) the
number of documents that hold it and a small table of occurrences per source.
Stripes live in hash tables inside the task; past a bound on their entries
they are given out and started anew. A shuffle by (language, term) brings the
stripes of a term together, sorted, and they are merged as they stream by, one
term at a time. A merged stripe holds everything about its term, so once the
totals of the sources are known the stripes give the divergences directly.

For a language with ``V`` kept terms (in at least ``min_docs`` documents), a
group (language, source) gives every kept term the share
``p = 1 + floor(10^9 * (count + 5) / (N + 5 V))``; ``N`` sums its counts over
kept terms; the language as a whole gets shares the same way. Two outputs:

* ``pair``: for each two sources of a language, the sum of ``|p - q|`` over all
  kept terms;
* ``term``: for each source its ``top`` terms by ``p - q`` over the language's
  share ``q`` (terms that occur in the source and have ``p > q``).

Hot terms, sources and languages: a term gives at most a few rows per task to
the shuffle, whatever its frequency. Kept stripes are dealt by a hash of the
term to groups of about ``CHUNK`` terms and ``BLOCK`` own sources, so a
language or source that holds most rows is spread; the sums of the groups are
added up by key.

Defined cases: NULL text, language or source reads as ``''``; a group without
terms counts (all its counts are 0); a language without kept terms has pair
values 0 and no term rows; repeated rows and ids are documents of their own;
equal values rank by item in UTF-8 order; an empty table gives an empty result. All sums are whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.text import slices

#: Entries (term of a language, and term of a group) that a task holds before it gives its stripes out.
ENTRIES = 600_000
#: Kept terms, and own sources, of one group of the last step; cells of its dense table at a time.
CHUNK, BLOCK, CELLS = 4096, 256, 1 << 21
#: Longest part of a text that is split into terms at once.
STRETCH = 4 << 20
SCALE, SMOOTH = 1_000_000_000, 5

#: Fixed: terms are runs of ASCII letters and non-ASCII characters, only A-Z are lower-cased.
_FOLD = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
_STRIPES = "lang string, term string, n_docs bigint, sources array<string>, counts array<bigint>"
_NAMES = ["lang", "term", "n_docs", "sources", "counts"]


def _stretches(data: bytes) -> Iterator[bytes]:
    """Parts of a folded text, cut at spaces."""
    i = 0
    while len(data) - i > STRETCH:
        j = data.rfind(b" ", i, i + STRETCH)
        if j <= i:
            j = data.find(b" ", i + STRETCH)
            if j < 0:
                break
        yield data[i:j]
        i = j
    yield data[i:] if i else data


class Stripes:
    """Stripes of the documents folded so far."""

    def __init__(self):
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.groups: Counter = Counter()

    def add(self, lang: str, source: str, text: str) -> None:
        self.groups[lang, source] += 1
        held, seen = self.counts[lang, source], set()
        for part in _stretches(text.encode("utf-8").translate(_FOLD)):
            terms = part.split()
            held.update(terms)
            seen.update(terms)
        self.docs[lang].update(seen)

    def entries(self) -> int:
        return sum(map(len, self.docs.values())) + sum(len(c) + 8 for c in self.counts.values())

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row per (language, term); the empty term stands for the documents themselves."""
        of_lang = defaultdict(list)
        for lang, source in self.groups:
            of_lang[lang].append(source)
        for lang, sources in of_lang.items():
            docs = self.docs[lang]
            place = {t: i for i, t in enumerate(docs)}
            rows, codes, counts = [], [], []
            for k, source in enumerate(sources):
                held = self.counts[lang, source]
                rows.append(np.fromiter(map(place.__getitem__, held), np.int64, len(held)))
                codes.append(np.full(len(held), k))
                counts.append(np.fromiter(held.values(), np.int64, len(held)))
            # The documents of the groups, in a last row.
            rows.append(np.full(len(sources), len(docs)))
            codes.append(np.arange(len(sources)))
            counts.append(np.array([self.groups[lang, s] for s in sources], np.int64))
            n_docs = np.array([*docs.values(), sum(self.groups[lang, s] for s in sources)], np.int64)
            terms = pa.array([*docs, b""], pa.binary()).cast(pa.string())
            row, code, count = map(np.concatenate, (rows, codes, counts))
            yield from _rows(pa.array([lang] * len(n_docs), pa.string()), terms, n_docs, row, pa.array(sources, pa.string()), code, count)


def _rows(lang, term, n_docs, row, names, code, count, at_once: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches from entries (row, code of the source, count)."""
    order = np.argsort(row, kind="stable")
    code, count = code[order], count[order]
    off = np.searchsorted(row[order], np.arange(len(n_docs) + 1)).astype(np.int32)
    for i in range(0, len(n_docs), at_once):
        j = min(i + at_once, len(n_docs))
        a, b = off[i], off[j]
        o = pa.array(off[i : j + 1] - a)
        yield pa.RecordBatch.from_arrays(
            [
                lang.slice(i, j - i),
                term.slice(i, j - i),
                pa.array(n_docs[i:j]),
                pa.ListArray.from_arrays(o, names.take(pa.array(code[a:b]))),
                pa.ListArray.from_arrays(o, pa.array(count[a:b])),
            ],
            names=_NAMES,
        )


def _fold_documents(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                    held.add(lang, source, text)
                if held.entries() > entries:
                    yield from held.batches()
                    held = Stripes()
        yield from held.batches()

    return run


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows in (lang, term) order with the stripes of equal keys added up."""
    n = batch.num_rows
    lang, term, n_docs, sources, counts = batch.columns
    new = np.ones(n, bool)
    if n > 1:
        other = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in (lang, term)]
        new[1:] = other[0] | other[1]
    first = np.flatnonzero(new)
    key = np.cumsum(new) - 1
    names = sources.flatten().dictionary_encode()
    entry = np.repeat(key, sources.value_lengths().to_numpy(zero_copy_only=False)) * max(1, len(names.dictionary)) + names.indices.to_numpy()
    order = np.argsort(entry, kind="stable")
    entry, value = entry[order], counts.flatten().to_numpy()[order]
    at = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]])) if len(entry) else np.zeros(0, np.int64)
    sums = np.add.reduceat(value, at) if len(at) else value
    row, code = np.divmod(entry[at], max(1, len(names.dictionary)))
    picked = pa.array(first)
    docs = np.add.reduceat(n_docs.to_numpy(), first)
    parts = list(_rows(lang.take(picked), term.take(picked), docs, row, names.dictionary, code, sums, at_once=len(first)))
    return parts[0]


def _merge_stripes(min_docs: int):
    """Adds up stripes that come sorted by key; the last key of a batch waits for the next one."""

    def kept(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pc.or_(pc.greater_equal(b.column(2), min_docs), pc.equal(b.column(1), "")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch.cast(waiting.schema)]).combine_chunks().to_batches()[0]
            done = _merged(batch)
            waiting = done.slice(done.num_rows - 1)
            yield kept(done.slice(0, done.num_rows - 1))
        if waiting is not None:
            yield kept(waiting)

    return run


def stripes(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30, entries: int = ENTRIES
) -> DataFrame:
    """(lang, term, n_docs, sources, counts): merged stripes of kept terms.

    The term ``''`` of each language holds the documents of its groups.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    folded = rows.mapInArrow(_fold_documents(entries), _STRIPES)
    together = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return together.mapInArrow(_merge_stripes(min_docs), _STRIPES)


def _shares(count: np.ndarray, n, v: int) -> np.ndarray:
    if count.size and int(count.max()) + SMOOTH > (1 << 63) // SCALE - 1:
        whole = SCALE * (count.astype(object) + SMOOTH) // (np.asarray(n).astype(object) + SMOOTH * v)
        return 1 + whole.astype(np.int64)
    return 1 + SCALE * (count + SMOOTH) // (n + SMOOTH * v)


def _diverge(top: int):
    """Divergences that the stripes of one group of terms add for its own sources."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        sources = right.column("source").to_pylist()
        place = {s: i for i, s in enumerate(sources)}
        total = right.column("n").to_numpy()
        own = np.flatnonzero(right.column("mine").to_numpy(zero_copy_only=False))
        v = right.column("v")[0].as_py() if sources else 0
        n_lang = right.column("n_lang")[0].as_py() if sources else 0
        left = left.filter(pc.not_equal(left.column("term"), ""))
        by_term = sorted(range(left.num_rows), key=[t.encode("utf-8") for t in left.column("term").to_pylist()].__getitem__)
        left = left.take(pa.array(by_term, pa.int64())).combine_chunks()
        sums = np.zeros((len(own), len(sources)), np.int64)
        best: list[list[tuple[int, str]]] = [[] for _ in own]
        step = max(1, CELLS // max(1, len(sources)))
        for i in range(0, left.num_rows, step):
            part = left.slice(i, step)
            names = part.column("sources").combine_chunks().flatten().dictionary_encode()
            code = np.array([place[s] for s in names.dictionary.to_pylist()], np.int64)
            row = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("sources")).to_numpy())
            count = np.zeros((part.num_rows, len(sources)), np.int64)
            count[row, code[names.indices.to_numpy()]] = part.column("counts").combine_chunks().flatten().to_numpy()
            p, q = _shares(count, total, v), _shares(count.sum(1), n_lang, v)
            terms = part.column("term").to_pylist()
            for k, s in enumerate(own):
                sums[k] += np.abs(p - p[:, s : s + 1]).sum(0)
                more = np.flatnonzero((count[:, s] > 0) & (p[:, s] > q))
                f = p[more, s] - q[more]
                first = np.argsort(-f, kind="stable")[:top]  # terms are in order, so ties are too
                best[k] += [(int(f[j]), terms[more[j]]) for j in first]
        out = []
        for k, s in enumerate(own):
            out += [(lang, sources[s], "pair", sources[j], int(x)) for j, x in enumerate(sums[k]) if j != s]
            ranked = sorted(best[k], key=lambda x: (-x[0], x[1].encode("utf-8")))[:top]
            out += [(lang, sources[s], "term", t, f) for f, t in ranked]
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "part", "item", "value"])

    return run


def divergences(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    min_docs: int = 30,
    top: int = 50,
    chunk: int = CHUNK,
    block: int = BLOCK,
    entries: int = ENTRIES,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups."""
    kept = staged(stripes(docs, lang, source, text, min_docs, entries), "stripes")
    entry = kept.select("lang", (F.col("term") == "").alias("itself"), F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    n = F.sum(F.when(F.col("itself"), 0).otherwise(F.col("e.counts"))).alias("n")
    groups = entry.groupBy("lang", F.col("e.sources").alias("source")).agg(n)
    of_lang = groups.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count(F.lit(1)).alias("n_sources"))
    terms = kept.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("v"))
    groups = staged(groups.join(of_lang, "lang").join(terms, "lang"), "stripe-groups")

    # Two numbers set how finely the last step is dealt out.
    sizes = groups.select("lang", "v", "n_sources").distinct().agg(F.sum("v").alias("v"), F.max("n_sources").alias("s")).first()
    chunks, blocks = max(1, -(-(sizes.v or 0) // chunk)), max(1, -(-(sizes.s or 0) // block))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = kept.withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int")).withColumn("block", every_block)
    right = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("block", every_block)
    right = right.withColumn("mine", F.pmod(F.xxhash64("source"), F.lit(blocks)) == F.col("block"))
    keys = ["lang", "chunk", "block"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _diverge(top), "lang string, source string, part string, item string, value bigint"
    )
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


#: The same rows in DuckDB, by joins of all kept terms with all groups.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
o AS (SELECT i, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT g.lang, g.source, CAST(coalesce(sum(c.c), 0) AS BIGINT) AS n
      FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000 * (coalesce(c.c, 0) + 5)) // (n.n + 5 * v.v) AS p
      FROM n JOIN v ON n.lang = v.lang JOIN k ON n.lang = k.lang
      LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
m AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM n GROUP BY lang),
q AS (SELECT p.lang, p.term, 1 + (1000000000 * (CAST(sum(p.c) AS BIGINT) + 5)) // (any_value(m.n) + 5 * any_value(v.v)) AS q
      FROM p JOIN m ON p.lang = m.lang JOIN v ON p.lang = v.lang GROUP BY p.lang, p.term),
s AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS f
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.f, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q),
t AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM t WHERE part = 'pair' OR rank <= 50
"""
