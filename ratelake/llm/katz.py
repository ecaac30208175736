"""Katz backoff language model, scored over the corpus it is learned from.

``P(w | h) = d(c) c / c(h)`` for a bigram seen ``c`` times in training, else
``alpha(h) P(w)``; for a history never seen, ``P(w)``. Counts up to 5 get
Good-Turing discounts ``d`` (Katz's form), larger ones lose a constant 0.01,
so every history keeps mass for what it has not seen. ``alpha(h)`` is exactly
the mass left over by the discounts of ``h`` divided by the unigram mass of
words not seen after ``h``. Unigrams back off once more: their discounted mass
goes to one class of unknown words. All of that sums to 1 per history.

How it is spread: tasks cut texts into tokens and pack, per slice of texts,
the distinct (word, history, document, count) rows by word partition. These
packed tables are shuffled once; every partition then has all counts of its
words. A first job over them adds up counts of counts; the second scores what
depends on the word, and sends on, by history partition, the mass each history
has left and the tokens that must back off. The last step evaluates those and
adds up the parts of each document.

Words and bigrams that hold a large share of all tokens (over 1 in
``HOT_SHARE``, so at most that many) are dealt by history or by slice instead,
and their totals, a bounded table, go to all tasks. No key's rows meet in one
task. Lost executors rebuild their partitions from the shuffles' inputs.

Defined cases: NULL text counts as empty; an empty text is its end token
alone; repeated rows are separate documents; without training documents all
words are unknown (probability 1); an empty table gives no rows. Words are
64-bit hashes, histories their lower 48 bits.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.llm.text import Words, map_texts, mix64

CUT, TAIL = 5, 0.01
HOT_SHARE = 2000
END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0x00FEDCBA98765432)
_48 = np.uint64((1 << 48) - 1)


# ---- packed tables


def _pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps([(a.dtype.str, zlib.compress(np.ascontiguousarray(a).tobytes(), 1)) for a in arrays])


def _unpack(blob: bytes) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(b), t) for t, b in pickle.loads(blob)]


def _six(h: np.ndarray) -> np.ndarray:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view("<u8").ravel()


def _pair(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix64(w ^ (h * np.uint64(0x9E3779B97F4A7C15)))


class Slice:
    """Distinct (word, history, document) rows of some texts, in that order."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        n, docs = len(words.starts), words.n_docs
        doc = words.doc_of()
        token = np.full(n + docs, END, np.uint64)
        token[np.arange(n) + doc] = words.hashes()
        at = np.repeat(np.arange(docs), np.diff(words.off) + 1)
        before = np.empty_like(token)
        if len(token):
            before[0] = START
            before[1:] = np.where(at[1:] == at[:-1], token[:-1], START)
        self.words, w = np.unique(token, return_inverse=True)
        histories, h = np.unique(before & _48, return_inverse=True)
        key = w.astype(np.int64) * max(len(histories), 1) + h
        order = np.argsort(key, kind="stable")  # documents stay in order
        key, at = key[order], at[order]
        new_pair = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        new_row = new_pair | np.concatenate([[True], at[1:] != at[:-1]])[: len(key)]
        first = np.flatnonzero(new_row)
        self.doc = at[first]
        self.count = np.diff(np.concatenate([first, [len(key)]]))
        self.pair_of_row = np.cumsum(new_pair)[first] - 1
        pair_key = key[new_pair]
        self.w_of_pair = pair_key // max(len(histories), 1)
        self.h = histories[pair_key % max(len(histories), 1)]
        self.tokens = len(token)


# ---- the model


def discounts(n: np.ndarray) -> np.ndarray:
    """d(1..CUT) from counts of counts n[1..CUT + 1] (Good-Turing as Katz uses it)."""
    r = np.arange(1, CUT + 1)
    if n[1] > 0:
        top = (CUT + 1) * n[CUT + 1] / n[1]
        with np.errstate(divide="ignore", invalid="ignore"):
            d = ((r + 1) * n[2 : CUT + 2] / (r * n[1 : CUT + 1]) - top) / (1 - top)
        if np.isfinite(d).all() and (d > 0).all() and (d < 1).all():
            return d
    # Too few counts for Good-Turing: subtract the usual constant.
    return (r - np.clip(n[1] / max(n[1] + 2 * n[2], 1e-9), 0.1, 0.9)) / r


class Counts:
    """Totals all tasks know: hot tables, token totals, discounts."""

    def __init__(self, hot_w: dict[int, int], hot_pairs: dict[tuple[int, int], int], n_w: np.ndarray, n_p: np.ndarray, types: int, tokens: int):
        self.hot_w = np.array(sorted(hot_w), np.uint64)
        self.hot_w_count = np.array([hot_w[int(x)] for x in self.hot_w], np.int64)
        pairs = sorted(hot_pairs)
        self.pair_w = np.array([p[0] for p in pairs], np.uint64)
        self.pair_h = np.array([p[1] for p in pairs], np.uint64)
        self.pair_count = np.array([hot_pairs[p] for p in pairs], np.int64)
        g = _pair(self.pair_w, self.pair_h)
        self.pair_order = np.argsort(g)
        self.pair_sorted = g[self.pair_order]
        self.hot_h = np.unique(np.concatenate([self.hot_w & _48, [START & _48]]))
        self.types, self.tokens = types, tokens
        self.d_w, self.d_p = discounts(n_w), discounts(n_p)
        r = np.arange(1, CUT + 1)
        many = types - n_w[1 : CUT + 1].sum()
        lost = (n_w[1 : CUT + 1] * r * (1 - self.d_w)).sum() + many * TAIL
        self.unknown = lost / tokens if tokens else 1.0

    @staticmethod
    def _less(c: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Counts after discounting."""
        low = c * d[np.clip(c, 1, CUT) - 1]
        return np.where(c <= CUT, low, c - TAIL)

    def p_word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self._less(c, self.d_w) / max(self.tokens, 1), self.unknown)

    def pair_mass(self, c: np.ndarray) -> np.ndarray:
        return self._less(c, self.d_p)


def _where(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each x in sorted ``known``, -1 if absent."""
    if not len(known):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return np.where(known[at] == x, at, -1)


class Shard:
    """All rows of one word partition."""

    def __init__(self, blobs):
        w, h, pair, doc, count, train, row, doc_id = ([] for _ in range(8))
        docs = pairs = 0
        for blob in blobs:
            words, per_word, hist, per_pair, d, c, t, rows, ids = _unpack(blob)
            w.append(np.repeat(words, per_word))
            h.append(_from_six(hist))
            pair.append(np.repeat(np.arange(len(per_pair), dtype=np.int32) + np.int32(pairs), per_pair))
            doc.append(d.astype(np.int32) + np.int32(docs))
            count.append(c.astype(np.int32))
            train.append(t)
            row.append(np.cumsum(rows))
            doc_id.append(np.cumsum(ids))
            docs += len(t)
            pairs += len(per_pair)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        w, h = cat(w, np.uint64), cat(h, np.uint64)
        self.doc, self.count = cat(doc, np.int32), cat(count, np.int32)
        self.train, self.row, self.doc_id = cat(train, bool), cat(row, np.int64), cat(doc_id, np.int64)
        g, first, inverse = np.unique(_pair(w, h), return_index=True, return_inverse=True)
        self.pair_hash, self.w, self.h = g, w[first], h[first]
        self.pair = inverse.astype(np.int32)[cat(pair, np.int32)]
        learned = self.count * self.train[self.doc]
        self.c_pair = np.bincount(self.pair, learned, len(g)).astype(np.int64)
        self.words, self.word = np.unique(self.w, return_inverse=True)
        self.c_word = np.bincount(self.word, self.c_pair, len(self.words)).astype(np.int64)


def _totals(hot_w: np.ndarray, hot_pairs: np.ndarray):
    """Job 1: counts of counts and the parts of the hot totals."""

    def run(blobs):
        s = Shard(b for _, b in blobs)
        hot = _where(hot_pairs, s.pair_hash) >= 0
        for i in np.flatnonzero(hot):
            yield ("p", int(s.w[i]), int(s.h[i])), int(s.c_pair[i])
        n = np.bincount(np.minimum(s.c_pair[~hot], CUT + 2), minlength=CUT + 3)
        hot = _where(hot_w, s.words) >= 0
        for i in np.flatnonzero(hot):
            yield ("w", int(s.words[i]), 0), int(s.c_word[i])
        m = np.bincount(np.minimum(s.c_word[~hot], CUT + 2), minlength=CUT + 3)
        for r in range(1, CUT + 2):
            yield ("np", r, 0), int(n[r])
            yield ("nw", r, 0), int(m[r])
        yield ("types", 0, 0), int(m[1:].sum())
        yield ("tokens", 0, 0), int(s.c_word.sum())

    return run


def _score_words(shared, parts: int):
    """Job 2: what depends on the word; the rest goes on by history."""

    def run(index, blobs):
        m: Counts = shared.value
        s = Shard(b for _, b in blobs)
        at = _where(m.hot_w, s.words)
        c_w = np.where(at >= 0, m.hot_w_count[at] if len(m.hot_w) else 0, s.c_word)[s.word] if len(s.words) else s.c_word
        at = _where(m.pair_sorted, s.pair_hash)
        hot_pair = at >= 0
        c_p = np.where(hot_pair, m.pair_count[m.pair_order[at]] if len(m.pair_w) else 0, s.c_pair)
        p_w = m.p_word(c_w)
        # Mass of histories: hot bigrams count once, in the first partition.
        own = (c_p > 0) & ~hot_pair
        h, mass, p, c = s.h[own], m.pair_mass(c_p[own]), p_w[own], c_p[own]
        if index == 0 and len(m.pair_w):
            i = np.flatnonzero(m.pair_count > 0)
            c_hot = m.hot_w_count[np.maximum(_where(m.hot_w, m.pair_w[i]), 0)]
            h = np.concatenate([h, m.pair_h[i]])
            mass = np.concatenate([mass, m.pair_mass(m.pair_count[i])])
            p, c = np.concatenate([p, m.p_word(c_hot)]), np.concatenate([c, m.pair_count[i]])
        u, k = np.unique(h, return_inverse=True)
        left = np.bincount(k, c - mass, len(u))
        seen_p, total = np.bincount(k, p, len(u)), np.bincount(k, c, len(u))
        to = (mix64(u) % np.uint64(parts)).astype(np.int64)
        for q in np.unique(to):
            x = to == q
            yield int(q), ("h", _pack(u[x], left[x], seen_p[x], total[x].astype(np.int64)))
        # Tokens that back off.
        n = s.count
        back = c_p[s.pair] == 0
        h, row, cnt = s.h[s.pair[back]], s.row[s.doc[back]], n[back]
        hot_h = _where(m.hot_h, h) >= 0
        to = (mix64(np.where(hot_h, h ^ mix64(row.astype(np.uint64)), h)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(parts + 1))
        for q in range(parts):
            x = order[cuts[q] : cuts[q + 1]]
            if len(x):
                yield q, ("b", _pack(h[x], row[x], cnt[x]))
        # Sums per document.
        with np.errstate(divide="ignore"):
            base = np.log10((c_w + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
            score = np.where(c_p > 0, np.log10(np.where(c_p > 0, m.pair_mass(c_p), 1.0)), np.log10(p_w))
            # The word is the next token's history, unless it ends the text.
            score = score - np.where((c_w > 0) & (s.w != END), np.log10(np.maximum(c_w, 1)), 0.0)
        d = len(s.row)
        sums = [
            np.bincount(s.doc, n, d).astype(np.int64),
            np.bincount(s.doc, n * (c_w > 0)[s.pair], d).astype(np.int64),
            np.bincount(s.doc, n * base[s.pair], d),
            np.bincount(s.doc, n * score[s.pair], d),
        ]
        some = sums[0] > 0
        to = (mix64(s.row.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        for q in np.unique(to[some]):
            x = some & (to == q)
            yield int(q), ("d", _pack(s.row[x], s.doc_id[x], *[v[x] for v in sums]))

    return run


def _histories(items, hot: np.ndarray):
    """(history, left, p, total) sums of the "h" tables, hot ones told apart."""
    parts = [_unpack(b) for k, b in items if k == "h"]
    if not parts:
        z = np.zeros(0)
        return z.astype(np.uint64), z, z, z, z.astype(bool)
    h, left, p, c = (np.concatenate(x) for x in zip(*parts))
    u, k = np.unique(h, return_inverse=True)
    return u, np.bincount(k, left, len(u)), np.bincount(k, p, len(u)), np.bincount(k, c, len(u)), _where(hot, u) >= 0


def _hot_histories(hot: np.ndarray):
    def run(records):
        u, left, p, c, is_hot = _histories([r for _, r in records], hot)
        for i in np.flatnonzero(is_hot):
            yield int(u[i]), (float(left[i]), float(p[i]), float(c[i]))

    return run


def _finish(hot: np.ndarray, table: dict, train_docs: int):
    """Last job: backed-off tokens get log alpha; documents are added up."""

    def run(records):
        items = [r for _, r in records]
        u, left, p, c, _ = _histories(items, hot)
        keep = _where(hot, u) < 0
        u, left, p, c = u[keep], left[keep], p[keep], c[keep]
        more = sorted(table)
        u = np.concatenate([u, np.array(more, np.uint64)])
        left, p, c = (np.concatenate([x, np.array([table[m][i] for m in more])]) for i, x in enumerate((left, p, c)))
        order = np.argsort(u)
        u, left, p, c = u[order], left[order], p[order], c[order]
        # log alpha(h), plus log c(h) that job 2 took off for every known history.
        gain = np.log10(np.maximum(left / c, 1e-300) / np.maximum(1 - p, 1e-12)) + np.log10(c) if len(u) else u
        sums: dict[int, list] = {}
        for kind, blob in items:
            if kind == "d":
                for row, doc_id, n, known, base, score in zip(*[x.tolist() for x in _unpack(blob)]):
                    s = sums.setdefault(row, [doc_id, 0, 0, 0.0, 0.0])
                    s[1] += n
                    s[2] += known
                    s[3] += base
                    s[4] += score
        for row, s in sums.items():
            yield row, s[0], s[1], s[2], s[3], s[4] - (float(np.log10(train_docs)) if train_docs else 0.0)
        back = [_unpack(b) for k, b in items if k == "b"]
        if back:
            h, row, cnt = (np.concatenate(x) for x in zip(*back))
            at = _where(u, h)
            value = np.where(at >= 0, gain[at] if len(u) else 0.0, 0.0)
            r, k = np.unique(row, return_inverse=True)
            for x, v in zip(r.tolist(), np.bincount(k, value * cnt).tolist()):
                yield x, None, 0, 0, 0.0, v

    return run


_OUT = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("packed_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)
_NO_ID = np.iinfo(np.int64).min


def _hot(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words, and hashes of bigrams, with a large share of all tokens.

    A slice reports what holds that share of its own tokens; whatever holds it
    of all tokens does so in some slice.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        s = Slice(part.column(0))
        per_pair = np.bincount(s.pair_of_row, s.count, len(s.h)).astype(np.int64)
        per_word = np.bincount(s.w_of_pair, per_pair, len(s.words)).astype(np.int64)
        least = max(1, s.tokens // HOT_SHARE)
        i, j = np.flatnonzero(per_word >= least), np.flatnonzero(per_pair >= least)
        if len(part) and s.tokens < HOT_SHARE:  # too small a slice to judge by
            i, j = i[per_word[i] * 20 >= s.tokens], j[per_pair[j] * 20 >= s.tokens]
        pairs = _pair(s.words[s.w_of_pair[j]], s.h[j])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([[0], np.zeros(len(i), np.int64), np.ones(len(j), np.int64)]).astype(np.int64)),
                pa.array(np.concatenate([[END], s.words[i], pairs]).astype(np.uint64).view(np.int64)),
                pa.array(np.concatenate([[0], per_word[i], per_pair[j]]).astype(np.int64)),
                pa.array(np.concatenate([[s.tokens], np.zeros(len(i) + len(j), np.int64)]).astype(np.int64)),
            ],
            names=["kind", "key", "n", "tokens"],
        )

    found = rows.select("text").mapInArrow(map_texts(run), "kind bigint, key bigint, n bigint, tokens bigint")
    found = found.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))
    total = found.agg(F.sum("tokens")).first()[0] or 0
    # The shares of different keys add up to 1 at most: HOT_SHARE words and bigrams at most.
    big = found.where(F.col("n") * HOT_SHARE >= total).where("n > 0").select("kind", "key").collect()
    as_set = lambda k: np.sort(np.array([r[1] for r in big if r[0] == k], np.int64).view(np.uint64))
    return np.unique(np.concatenate([as_set(0), [END]])), as_set(1)


def _packed(rows: DataFrame, hot_w: np.ndarray, hot_pairs: np.ndarray, parts: int) -> DataFrame:
    """(part, blob): the rows of each slice by word partition."""

    def run(batches):
        for part in map_texts(lambda p: p)(batches):
            s = Slice(part.column(0))
            row = part.column(1).to_numpy(zero_copy_only=False)
            train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            ids = part.column(3).fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False)
            w = s.words[s.w_of_pair]
            pair = _pair(w, s.h)
            deal = np.where(_where(hot_w, w) >= 0, pair, mix64(w))
            deal = np.where(_where(hot_pairs, pair) >= 0, mix64(pair + np.uint64(row[0] + 1)), deal)
            to = (deal % np.uint64(parts)).astype(np.int64)
            rows_of = np.bincount(s.pair_of_row, minlength=len(w))
            order = np.argsort(to, kind="stable")
            first = np.concatenate([[0], np.cumsum(rows_of)])
            cuts = np.searchsorted(to[order], np.arange(parts + 1))
            meta = [train, np.diff(row, prepend=0), np.diff(ids, prepend=0)]
            for q in range(parts):
                mine = order[cuts[q] : cuts[q + 1]]
                if not len(mine):
                    continue
                n = rows_of[mine]
                at = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                new = np.concatenate([[True], np.diff(s.w_of_pair[mine]) != 0])
                starts = np.flatnonzero(new)
                blob = _pack(
                    w[mine][starts],
                    np.diff(np.concatenate([starts, [len(mine)]])).astype(np.uint32),
                    _six(s.h[mine]),
                    n.astype(np.uint16),
                    s.doc[at].astype(np.uint16),
                    s.count[at].astype(np.uint32),
                    *meta,
                )
                yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32()), pa.array([blob], pa.binary())], names=["part", "blob"])

    return rows.select("text", "row", "train", "doc_id").mapInArrow(run, "part int, blob binary")


def corpus_scores(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per document.

    The model is learned from documents for which ``learn`` holds.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(text).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(learn, F.lit(False)).alias("train"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
    )
    hot_w, hot_pairs = _hot(rows)
    tables = _packed(rows, hot_w, hot_pairs, parts).rdd.map(tuple).partitionBy(parts, int)
    parts = tables.getNumPartitions()
    total = dict(tables.mapPartitions(_totals(hot_w, hot_pairs)).reduceByKey(lambda a, b: a + b).collect())  # hot tables and a few sums
    n_w, n_p = np.zeros(CUT + 2), np.zeros(CUT + 2)
    for r in range(1, CUT + 2):
        n_w[r], n_p[r] = total.get(("nw", r, 0), 0), total.get(("np", r, 0), 0)
    words = {k[1]: v for k, v in total.items() if k[0] == "w"}
    pairs = {k[1:]: v for k, v in total.items() if k[0] == "p"}
    for counts, n in ((words, n_w), (pairs, n_p)):
        for c in counts.values():
            if 1 <= c <= CUT + 1:
                n[c] += 1
    types = total.get(("types", 0, 0), 0) + sum(c > 0 for c in words.values())
    tokens = total.get(("tokens", 0, 0), 0)
    model = Counts(words, pairs, n_w, n_p, types, tokens)
    by_history = tables.mapPartitionsWithIndex(_score_words(sc.broadcast(model), parts)).partitionBy(parts, int)
    add = lambda a, b: tuple(x + y for x, y in zip(a, b))
    table = dict(by_history.mapPartitions(_hot_histories(model.hot_h)).reduceByKey(add).collect())  # hot histories
    out = by_history.mapPartitions(_finish(model.hot_h, table, words.get(int(END), 0)))
    out = spark.createDataFrame(out, _OUT).groupBy("row").agg(
        F.max("packed_id").alias("packed_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    )
    ids = F.when(F.col("packed_id") != int(_NO_ID), F.col("packed_id"))
    return out.select(
        ids.alias("doc_id"), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
