"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a fixed list of numbers (shape of the text, not its words).
Every number is cut into quantile bins. Training goes round the features
again and again; each visit fits one shallow tree on that feature's bins to
the current errors and adds a small share of it to the feature's lookup
table. Then the most useful feature pairs get tables of their own in the same
way. A score is the sum of the looked-up entries through the logistic curve,
so scoring is vectorised additions of bin entries.

The model is fitted on the driver from at most ``max_examples`` labelled rows
(those with the smallest hashes of their ids), a documented bound; all
documents are then scored in one pass without a shuffle.

Defined cases: NULL text counts as empty, an empty text has all-zero features
and gets a score like any other; labels that are NULL are not learned from;
an id labelled more than once counts with its mean, rounded up at one half;
without labels every score is 0.5; repeated rows stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.text import SMALL, Words, map_texts, shingles, utf8

FEATURES = (
    "bytes", "upper", "digits", "symbols", "stops", "shouts", "bars", "blanks", "foreign", "word_length",
    "words", "distinct_words", "top_word", "distinct_shingles", "repeated_lines", "line_words", "short_words", "longest_word",
)
BINS, PAIR_BINS, PAIRS = 32, 8, 6


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_UPPER = _class(bytes(range(65, 91)))
_LETTER = _class(bytes([*range(65, 91), *range(97, 123)]))
_CLASSES = {
    "digits": _class(b"0123456789"),
    "symbols": _class(b"#$%&*+<=>@\\^_`{}~[]/"),
    "stops": _class(b".,;:?"),
    "shouts": _class(b"!"),
    "bars": _class(b"|"),
    "blanks": _class(b" \t\n\r\x0b\x0c"),
    "foreign": _class(bytes(range(128, 256))),
}
_NEWLINE = _class(b"\n\r")


def text_features(column: pa.Array) -> np.ndarray:
    """(documents, features) as float32."""
    data, off = utf8(column)
    n = len(off) - 1
    size = np.diff(off)
    some = np.maximum(size, 1)

    def count(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return total[off[1:]] - total[off[:-1]]

    x = dict.fromkeys(FEATURES, np.zeros(n))
    x["bytes"] = np.log1p(size)
    x["upper"] = count(_UPPER) / np.maximum(count(_LETTER), 1)
    for name, table in _CLASSES.items():
        x[name] = count(table) / some
    words = Words(column)
    h, wo = words.hashes(), words.off
    n_words = np.diff(wo)
    length = words.ends - words.starts
    total = np.concatenate([[0], np.cumsum(length)])
    short = np.concatenate([[0], np.cumsum(length <= 3)])
    some_words = np.maximum(n_words, 1)
    x["words"] = np.log1p(n_words)
    x["word_length"] = (total[wo[1:]] - total[wo[:-1]]) / some_words
    x["short_words"] = (short[wo[1:]] - short[wo[:-1]]) / some_words
    sh, so = shingles(h, wo, 5)
    lines = Words(column, _NEWLINE)
    lh, lo = lines.hashes(), lines.off
    distinct, top, repeated, fresh, longest = (np.zeros(n) for _ in range(5))
    for d in np.flatnonzero(n_words):
        _, c = np.unique(h[wo[d] : wo[d + 1]], return_counts=True)
        distinct[d], top[d] = len(c) / n_words[d], c.max() / n_words[d]
        fresh[d] = len(np.unique(sh[so[d] : so[d + 1]])) / (so[d + 1] - so[d])
        repeated[d] = 1 - len(np.unique(lh[lo[d] : lo[d + 1]])) / max(lo[d + 1] - lo[d], 1)
        longest[d] = np.log1p(length[wo[d] : wo[d + 1]].max())
    x["distinct_words"], x["top_word"], x["distinct_shingles"] = distinct, top, fresh
    x["repeated_lines"], x["longest_word"] = repeated, longest
    x["line_words"] = np.log1p(n_words / np.maximum(np.diff(lo), 1))
    return np.column_stack([x[f] for f in FEATURES]).astype(np.float32)


class AdditiveModel:
    """Lookup tables per feature and per chosen pair of features."""

    def __init__(self, bins: int = BINS, pair_bins: int = PAIR_BINS, rate: float = 0.15, rounds: int = 120):
        self.bins, self.pair_bins, self.rate, self.rounds = bins, pair_bins, rate, rounds
        self.bias, self.cuts, self.pair_cuts = 0.0, [], []
        self.tables: np.ndarray | None = None
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []

    @staticmethod
    def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))

    @staticmethod
    def _step(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """A tree of depth two over ordered bins: leaf value per bin.

        ``g`` and ``h`` are sums of gradients and curvatures per bin.
        """

        def gain(a, b):
            return a * a / (b + 1.0)

        def best(lo, hi):
            gs, hs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            if hi - lo < 2:
                return None
            left = gain(gs[:-1], hs[:-1]) + gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1])
            at = int(left.argmax())
            return lo + at + 1 if left[at] > gain(gs[-1], hs[-1]) + 1e-9 else None

        n = len(g)
        edges = [0, n]
        cut = best(0, n)
        if cut is not None:
            edges = sorted({0, n, cut, best(0, cut) or cut, best(cut, n) or cut})
        out = np.zeros(n)
        for a, b in zip(edges[:-1], edges[1:]):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
        return out

    def _step2(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One split on either axis, then one on the other axis on each side."""
        options = []
        for flip in (False, True):
            a, b = (g.T, h.T) if flip else (g, h)
            out = np.zeros_like(a)
            gs, hs = np.cumsum(a.sum(1)), np.cumsum(b.sum(1))
            if len(gs) > 1:
                gains = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
                cut = int(gains.argmax()) + 1
            else:
                cut = len(gs)
            for rows in (slice(0, cut), slice(cut, None)):
                out[rows] = self._step(a[rows].sum(0), b[rows].sum(0))
            err = -(out * a).sum() + 0.5 * (out * out * b).sum()
            options.append((err, flip, out.T if flip else out))
        return min(options, key=lambda o: o[:2])[2]

    def _code(self, x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        k = x.shape[1]
        p = (y.sum() + 1.0) / (len(y) + 2.0)
        self.bias = float(np.log(p / (1 - p)))
        self.tables = np.zeros((k, self.bins))
        self.cuts = [self._cuts(x[:, j], self.bins) if len(x) else np.zeros(0) for j in range(k)]
        self.pair_cuts = [self._cuts(x[:, j], self.pair_bins) if len(x) else np.zeros(0) for j in range(k)]
        if not len(y) or y.min() == y.max():
            return self
        code = self._code(x, self.cuts)
        f = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            for j in range(k):
                q = 1 / (1 + np.exp(-f))
                step = self._step(
                    np.bincount(code[:, j], y - q, self.bins), np.bincount(code[:, j], q * (1 - q), self.bins)
                )
                self.tables[j] += self.rate * step
                f += self.rate * step[code[:, j]]
        coarse = self._code(x, self.pair_cuts)
        m = self.pair_bins
        q = 1 / (1 + np.exp(-f))
        useful = []
        for i in range(k):
            for j in range(i + 1, k):
                cell = coarse[:, i] * m + coarse[:, j]
                g, h = np.bincount(cell, y - q, m * m), np.bincount(cell, q * (1 - q), m * m)
                useful.append((-(g * g / (h + 1)).sum(), i, j))
        self.pairs = [(i, j) for _, i, j in sorted(useful)[:PAIRS]]
        self.pair_tables = [np.zeros((m, m)) for _ in self.pairs]
        for _ in range(self.rounds // 3):
            for t, (i, j) in enumerate(self.pairs):
                q = 1 / (1 + np.exp(-f))
                cell = coarse[:, i] * m + coarse[:, j]
                g, h = np.bincount(cell, y - q, m * m), np.bincount(cell, q * (1 - q), m * m)
                step = self._step2(g.reshape(m, m), h.reshape(m, m))
                self.pair_tables[t] += self.rate * step
                f += self.rate * step.ravel()[cell]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        code = self._code(x, self.cuts)
        f = np.full(len(x), self.bias)
        for j in range(x.shape[1]):
            f += self.tables[j][code[:, j]]
        if self.pairs:
            coarse = self._code(x, self.pair_cuts)
            for (i, j), table in zip(self.pairs, self.pair_tables):
                f += table[coarse[:, i], coarse[:, j]]
        return 1 / (1 + np.exp(-f))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    max_examples: int = 20_000,
) -> AdditiveModel:
    """Fit on at most ``max_examples`` labelled documents for which ``learn`` holds."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_i")).agg(
        (F.avg(label) >= 0.5).cast("int").alias("_y")
    )
    ids = docs.where(learn).select(F.col(doc_id).alias("_i")).distinct().join(known, "_i")
    ids = staged(ids.orderBy(F.xxhash64("_i"), "_i").limit(max_examples), "quality-sample")
    rows = docs.select(F.col(doc_id).alias("_i"), F.col(text).cast("string").alias("text")).join(ids, "_i")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        x = text_features(part.column(1))
        return pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([r.tobytes() for r in x], pa.binary())], names=["_i", "y", "x"])

    picked = rows.select(F.col("_i").cast("bigint").alias("_i"), "text", "_y").mapInArrow(map_texts(run, limit=SMALL), "_i bigint, y int, x binary")
    picked = picked.orderBy(F.xxhash64("_i"), "_i", "x").limit(max_examples).select("x", "y").collect()
    x = np.frombuffer(b"".join(r[0] for r in picked), np.float32).reshape(len(picked), len(FEATURES))
    return AdditiveModel().fit(x, np.array([r[1] for r in picked], float))


def quality_scores(docs: DataFrame, model: AdditiveModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score), one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(shared.value.score(text_features(part.column(1))))], names=["doc_id", "score"]
        )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(map_texts(run, limit=SMALL), "doc_id bigint, score double")


def drop_low_quality(docs: DataFrame, model: AdditiveModel, at_least: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` whose score reaches ``at_least``, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        x = text_features(part.column(part.schema.get_field_index(text)))
        return part.filter(pa.array(shared.value.score(x) >= at_least))

    return docs.mapInArrow(map_texts(run, text, SMALL), docs.schema)
