"""Toxicity by the nearest labelled examples.

A text is a TF-IDF vector (``1 + ln(count)`` times ``ln(documents / document
frequency)``, length 1) over all terms that the labelled examples hold. Its
``k`` nearest examples by exact cosine are found in an inverted index: the
posting lists of rarer terms are summed as they are, terms held by many
examples are a dense matrix cut into blocks of examples with their highest
weight per block. The rare sums plus those maxima bound every cosine in a
block, so only blocks that can reach the current k-th cosine are multiplied
out. Neighbours vote with weight ``1 / (distance + 0.05)`` and are returned as
evidence.

A few toxic words hardly move the whole vector of a long text, so a second
index of the same kind holds the vectors over the terms tied to one label, and
the vote is the mean of both. Votes become calibrated scores by isotonic
regression on the votes that the examples get from each other (each left out
of its own neighbours).

Examples are at most ``max_examples`` labelled rows per label (smallest id
hashes; votes and calibration undo the unequal shares); the second index has
at most ``max_terms`` terms. Document frequencies are counted over all
documents. Words of a scored text that no example holds are in none of its
products and not in its length either, which alters no order of neighbours.

Defined cases: NULL or empty text, or text without any term of an example, has
no neighbours and gets the calibrated score of such examples; text without any
label-tied term counts there with the share of such examples; NULL labels are
not learned from; an id labelled more than once counts with its mean, rounded
up at one half; without labels, or with labels all alike, the score is their
smoothed share; repeated rows stay. Ties between examples go to the smaller
index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.text import NOT_ALNUM, Words, map_texts

K, BLOCK = 15, 512
#: Terms in this share of the examples are held densely; texts searched at once,
#: and postings summed at once.
COMMON, ROWS, POSTINGS = 0.05, 64, 1 << 21
#: Terms of the second index must deviate this far from independence (root of the G statistic), in
#: this many examples, and be this many times as frequent in one label's examples.
MIN_Z, MIN_DOCS, MIN_LIFT = 4.5, 4, 4.0


def _term_counts(words: Words, terms: np.ndarray):
    """(document, term index, count) of the sorted ``terms`` in documents."""
    h = words.hashes()
    at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    hit = np.flatnonzero(terms[at] == h) if len(terms) else np.zeros(0, np.int64)
    pair, count = np.unique(words.doc_of()[hit] * max(len(terms), 1) + at[hit], return_counts=True)
    return pair // max(len(terms), 1), pair % max(len(terms), 1), count


class NeighbourIndex:
    """Block-max inverted index over example vectors."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, y: np.ndarray, weight: np.ndarray, ids: np.ndarray):
        self.terms, self.idf = terms, idf
        n, m = len(y), len(terms)
        w = self._weigh(doc, term, count, n)
        # Examples alike in their heaviest term share blocks, so bounds are tight.
        top = np.full(n, m)
        order = np.lexsort((-w, doc))
        if len(order):
            first = order[np.concatenate([[True], np.diff(doc[order]) > 0])]
            top[doc[first]] = term[first]
        inside = np.lexsort((ids, top))  # example at each place of the index
        self.place = np.empty(n, np.int64)  # place of each example
        self.place[inside] = np.arange(n)
        self.y, self.weight, self.ids = y[inside], weight[inside], ids[inside]
        doc = self.place[doc]
        order = np.lexsort((doc, term))
        self.example, self.value = doc[order].astype(np.int32), w[order]
        self.n, self.blocks = n, max(-(-n // BLOCK), 1)
        # Postings of term t: ptr[t] up to the next entry.
        self.ptr = np.searchsorted(term[order], np.arange(m + 1))
        common = np.flatnonzero(np.diff(self.ptr) > COMMON * n)
        self.row = np.full(m, -1, np.int32)  # row of each common term in the dense matrix
        self.row[common] = np.arange(len(common))
        self._dense = None

    def __getstate__(self):
        return {**self.__dict__, "_dense": None}

    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the common terms by example, and their highest per block."""
        if self._dense is None:
            common = np.flatnonzero(self.row >= 0)
            held = np.zeros((len(common), self.blocks * BLOCK))
            for r, t in enumerate(common):
                part = slice(self.ptr[t], self.ptr[t + 1])
                held[r, self.example[part]] = self.value[part]
            self._dense = held, held.reshape(len(common), self.blocks, BLOCK).max(axis=2)
        return self._dense

    def _weigh(self, doc, term, count, n):
        w = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(doc, w * w, n))
        return w / np.maximum(norm[doc], 1e-12) if len(w) else w

    def nearest(self, term: np.ndarray, q: np.ndarray, k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Indices and cosines of the ``k`` nearest examples that share a term."""
        return self._search(np.zeros(len(term), np.int64), term, q, 1, k, np.array([without]))[0]

    def _search(self, doc, term, q, n: int, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of ``n`` texts at once."""
        held, peak = self.dense()
        width = self.blocks * BLOCK
        row = self.row[term]
        common, rare = row >= 0, np.flatnonzero(row < 0)
        cos = np.zeros(n * width)
        begin, size = self.ptr[term[rare]], self.ptr[term[rare] + 1] - self.ptr[term[rare]]
        upto = np.cumsum(size)
        i = 0
        while i < len(rare):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] - size[i] + POSTINGS, "right")))
            many = size[i:j]
            at = np.arange(many.sum()) + np.repeat(begin[i:j] - (np.cumsum(many) - many), many)
            cell = np.repeat(doc[rare[i:j]] * width, many) + self.example[at]
            cos += np.bincount(cell, np.repeat(q[rare[i:j]], many) * self.value[at], n * width)
            i = j
        cos = cos.reshape(n, self.blocks, BLOCK)
        dense = np.zeros((n, len(held)))
        dense[doc[common], row[common]] = q[common]
        bound = cos.max(axis=2) + dense @ peak
        floor = np.zeros(n)  # no higher than the k-th cosine
        done = np.zeros((n, self.blocks), bool)
        for b in np.argsort(-bound.max(axis=0), kind="stable"):
            some = np.flatnonzero((bound[:, b] > 0) & (bound[:, b] + 1e-12 >= floor))
            if not len(some):
                continue
            got = cos[some, b] + dense[some] @ held[:, b * BLOCK : (b + 1) * BLOCK]
            mine = np.flatnonzero((own[some] >= 0) & (own[some] // BLOCK == b))
            got[mine, own[some[mine]] % BLOCK] = 0
            cos[some, b], done[some, b] = got, True
            if not floor.any() and k <= BLOCK:
                floor[some] = np.partition(got, BLOCK - k, axis=1)[:, BLOCK - k]
        cos = np.where(done[:, :, None], cos, 0).reshape(n, width)
        if k < width:
            floor = np.partition(cos, width - k, axis=1)[:, width - k]
        d, idx = np.nonzero((cos > 0) & (cos >= floor[:, None] - 1e-12))
        score = cos[d, idx]
        order = np.lexsort((idx, -np.round(score, 12), d))
        d, idx, score = d[order], idx[order], score[order]
        cut = np.searchsorted(d, np.arange(n + 1))
        return [(idx[s : min(e, s + k)], score[s : min(e, s + k)]) for s, e in zip(cut[:-1], cut[1:])]

    def vote(self, idx: np.ndarray, cos: np.ndarray) -> float:
        w = self.weight[idx] / (np.maximum(1 - cos, 0) + 0.05)
        return float((w * self.y[idx]).sum() / w.sum()) if len(idx) else -1.0

    def votes(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, own: np.ndarray | None = None):
        """Votes of ``n`` texts (-1: no neighbour) and their neighbours."""
        w = self._weigh(doc, term, count, n)
        vote, near = np.full(n, -1.0), [[] for _ in range(n)]
        own = np.full(n, -1) if own is None else own
        for i in range(0, n, ROWS):
            j = min(i + ROWS, n)
            part = slice(*np.searchsorted(doc, (i, j)))
            for d, (idx, cos) in enumerate(self._search(doc[part] - i, term[part], w[part], j - i, K, own[i:j]), i):
                vote[d], near[d] = self.vote(idx, cos), self.ids[idx]
        return vote, near


class ToxicityModel:
    def __init__(self, index: NeighbourIndex | None, share: float, tied: NeighbourIndex | None = None, held=None, held_tied=None):
        """``index`` over all terms, ``tied`` over label-tied ones; ``held``: their (document, term, count)."""
        self.index, self.tied, self.blank, self.steps, self.levels = index, tied, share, np.zeros(0), np.zeros(0)
        if index is None:
            return
        # Votes of the examples among themselves, each without itself.
        y, w = index.y[index.place], index.weight[index.place]
        mean = lambda of: float(((w * y)[of].sum() + share) / (w[of].sum() + 1))
        vote, _ = index.votes(*held, index.n, own=index.place)
        if tied is not None:
            second, _ = tied.votes(*held_tied, index.n, own=tied.place)
            self.untied = mean(second < 0)
            vote = self._both(vote, second)
        some = vote >= 0
        if (~some).any():
            self.blank = mean(~some)
        self.steps, self.levels = isotonic(vote[some], y[some], w[some], share)

    def _both(self, vote: np.ndarray, second: np.ndarray) -> np.ndarray:
        return np.where(vote >= 0, (vote + np.where(second >= 0, second, self.untied)) / 2, -1.0)

    def votes(self, words: Words) -> tuple[np.ndarray, list]:
        """Votes of texts (-1: no neighbour) and their nearest examples."""
        vote, near = self.index.votes(*_term_counts(words, self.index.terms), words.n_docs)
        if self.tied is not None:
            vote = self._both(vote, self.tied.votes(*_term_counts(words, self.tied.terms), words.n_docs)[0])
        return vote, near

    def score(self, vote: np.ndarray) -> np.ndarray:
        out = np.full(len(vote), self.blank)
        if len(self.steps):
            out = np.where(vote >= 0, np.interp(vote, self.steps, self.levels), out)
        return np.clip(out, 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of the mean of ``y`` over ``x`` (pool adjacent violators)."""
    if not len(x):
        return np.zeros(0), np.zeros(0)
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # mean, weight, sum of x
    for part in np.array_split(order, max(1, min(40, len(x) // 10))):
        n = w[part].sum()
        pools.append([((w[part] * y[part]).sum() + prior) / (n + 1), n, (w[part] * x[part]).sum() / n])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            a, b = pools.pop(-2), pools.pop(-1)
            n = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / n, n, (a[2] * a[1] + b[2] * b[1]) / n])
    return np.array([p[2] for p in pools]), np.array([p[0] for p in pools])


def _choose_terms(term: np.ndarray, y: np.ndarray, n: np.ndarray, max_terms: int) -> np.ndarray:
    """Terms (hashes, one entry per example holding it) tied to one label."""
    u, at = np.unique(term, return_inverse=True)
    c1 = np.bincount(at, y, len(u))
    c0 = np.bincount(at, minlength=len(u)) - c1
    n0, n1 = n
    total, held = n0 + n1, c0 + c1
    cells = ((c1, held * n1), (c0, held * n0), (n1 - c1, (total - held) * n1), (n0 - c0, (total - held) * n0))
    g = 2 * sum(o * np.log(np.maximum(o, 1e-300) * total / np.maximum(e, 1e-300)) for o, e in cells)
    z = np.sqrt(np.maximum(g, 0))
    lift = np.abs(np.log((c1 + 0.5) / (n1 + 1) * (n0 + 1) / (c0 + 0.5)))
    good = np.flatnonzero((lift >= np.log(MIN_LIFT)) & (z >= MIN_Z) & (c0 + c1 >= MIN_DOCS))
    good = good[np.lexsort((u[good], -np.abs(z[good])))][:max_terms]
    return np.sort(u[good])


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
    max_examples: int = 4000, max_terms: int = 2048,
) -> ToxicityModel:
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_i")).agg(
        (F.avg(label) >= 0.5).cast("int").alias("_y")
    )
    pool = docs.where(learn).select(F.col(doc_id).alias("_i")).distinct().join(known, "_i")
    order = Window.partitionBy("_y").orderBy(F.xxhash64("_i"), "_i")
    ids = staged(pool.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= max_examples).drop("_r"), "toxic-sample")
    per = {r[0]: r[1] for r in pool.groupBy("_y").count().collect()}
    total = sum(per.values())
    share = (per.get(1, 0) + 1.0) / (total + 2.0)
    if len(per) < 2:
        return ToxicityModel(None, share)

    def terms_of(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(part.column(2), NOT_ALNUM)
        h = words.hashes()
        out = [np.unique(h[words.off[d] : words.off[d + 1]], return_counts=True) for d in range(words.n_docs)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *[pa.array([o[i].astype(np.int64).tobytes() for o in out], pa.binary()) for i in (0, 1)]],
            names=["i", "y", "h", "c"],
        )

    sample = docs.select(F.col(doc_id).alias("_i"), F.col(text).cast("string").alias("text")).join(ids, "_i")
    sample = sample.select(F.col("_i").cast("bigint").alias("i"), F.col("_y").alias("y"), "text")
    got = sample.mapInArrow(map_texts(terms_of, "text"), "i bigint, y int, h binary, c binary")
    rows = staged(got.dropDuplicates(["i"]), "toxic-examples").collect()  # 2 * max_examples rows at most
    rows.sort(key=lambda r: r[0])
    y = np.array([r[1] for r in rows], float)
    h = [np.frombuffer(r[2], np.int64).view(np.uint64) for r in rows]
    c = [np.frombuffer(r[3], np.int64) for r in rows]
    n1 = y.sum()
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in h])
    flat, count = np.concatenate([np.zeros(0, np.uint64), *h]), np.concatenate([np.zeros(0, np.int64), *c])
    if not len(flat):
        return ToxicityModel(None, share)
    terms, term = np.unique(flat, return_inverse=True)
    order = np.lexsort((term, doc))
    doc, term, count = doc[order], term[order], count[order]
    idf = _idf(docs.select(F.col(text).cast("string").alias("text")), terms)
    weight = np.where(y == 1, per[1] / max(n1, 1), per[0] / max(len(y) - n1, 1))
    about = y, weight / weight.min(), np.array([r[0] for r in rows])
    index = NeighbourIndex(terms, idf, doc, term, count, *about)
    chosen = _choose_terms(terms[term], y[doc], (len(y) - n1, n1), max_terms)
    if not len(chosen):
        return ToxicityModel(index, share, held=(doc, term, count))
    at = np.searchsorted(terms, chosen)
    place = np.full(len(terms), -1)
    place[at] = np.arange(len(at))
    hit = place[term] >= 0
    held = doc[hit], place[term[hit]], count[hit]
    return ToxicityModel(index, share, NeighbourIndex(chosen, idf[at], *held, *about), (doc, term, count), held)


def _idf(texts: DataFrame, terms: np.ndarray) -> np.ndarray:
    shared = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        total, n = np.zeros(len(shared.value), np.int64), 0
        for part in map_texts(lambda p: p)(batches):
            words = Words(part.column(0), NOT_ALNUM)
            _, term, _ = _term_counts(words, shared.value)
            total += np.bincount(term, minlength=len(total))
            n += words.n_docs
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1], held])), pa.array(np.concatenate([[n], total[held]]))], names=["t", "n"]
        )

    got = texts.mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a row per term
    frequency = np.zeros(len(terms) + 1, np.int64)  # last: all documents
    frequency[got["t"].to_numpy()] = got["n"].to_numpy()
    return np.log((frequency[-1] + 1) / (frequency[:-1] + 0.5))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, evidence): score and ids of the neighbours that voted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        n = part.num_rows
        vote, near = np.full(n, -1.0), [[]] * n
        if model.index is not None:
            vote, near = model.votes(Words(part.column(1), NOT_ALNUM))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(model.score(vote)), pa.array(near, pa.list_(pa.int64()))],
            names=["doc_id", "score", "evidence"],
        )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(map_texts(run), "doc_id bigint, score double, evidence array<bigint>")
