"""Language by the nearest of several centroids per language.

A text is a TF-IDF vector of hashed bigrams and trigrams over its UTF-8 bytes,
ASCII and Latin-1 letters lower-cased and other ASCII read as blanks (``ln(1 +
count)`` times inverse document frequency, length 1). Every language has a
few centroids, found by clustering its vectors with spherical k-means; a text
gets the language of the centroid with the highest cosine. A text farther from
its centroid than the centroid's learned radius is marked ``rejected``: it
still carries the nearest language, with its score cut to under one half.

Document frequencies are counted over all training documents. Centroids are
fitted on the driver from at most ``max_examples`` training documents, dealt
evenly to the languages (those with the smallest id hashes); so at most
``max_examples`` languages are learned.

Defined cases: NULL text, or text without a letter, is ``und`` with score 0;
rows without language are not learned from; without training rows every text
is ``und``; repeated rows stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged
from ratelake.llm.text import LOWER, map_texts, utf8

DIMS = 2048
_FOLD = LOWER.copy()
_FOLD[[i for i in range(128) if not (65 <= i <= 90 or 97 <= i <= 122)]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def ngram_counts(column: pa.Array) -> np.ndarray:
    """(documents, DIMS) counts of letter bigrams and trigrams, by hash."""
    data, off = utf8(column)
    n_docs = len(off) - 1
    if not len(data):
        return np.zeros((n_docs, DIMS), np.float32)
    b = _FOLD[data].astype(np.uint32)
    # Upper-case Latin-1 letters in UTF-8: C3 80-9E (but the sign C3 97).
    after = np.concatenate([[False], data[:-1] == 0xC3])
    b[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
    doc = np.repeat(np.arange(n_docs, dtype=np.int64), np.diff(off)) * DIMS
    out = np.zeros(n_docs * DIMS, np.int64)
    half = DIMS // 2
    for k in (2, 3):
        m = len(b) - k + 1
        if m <= 0:
            continue
        h = np.zeros(m, np.uint32)
        for j in range(k):
            h = (h ^ b[j : m + j]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        slot = (h % np.uint32(half)).astype(np.int64) + (half if k == 3 else 0)
        same = doc[:m] == doc[k - 1 :]
        # Grams of nothing but blanks, or with a blank inside, say little.
        keep = same & (b[:m] != 32) if k == 2 else same & (b[1 : m + 1] != 32)
        out += np.bincount(doc[:m][keep] + slot[keep], minlength=len(out))
    return out.reshape(n_docs, DIMS).astype(np.float32)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(column: pa.Array) -> np.ndarray:
    data, off = utf8(column)
    total = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = (total[off[1:]] - total[off[:-1]]) > 0
    for d in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[d] = any(map(str.isalpha, column[int(d)].as_py()))
    return out


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; centroids and the distance that 99 % of members keep."""
    centers = [x.mean(0)]
    while len(centers) < min(k, len(x)):  # next: the vector least like those chosen
        centers.append(x[np.max(x @ np.array(centers).T, axis=1).argmin()])
    c = np.array(centers)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        own = (x @ c.T).argmax(1)
        c = np.array([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    sim = x @ c.T
    own, near = sim.argmax(1), 1 - sim.max(1)
    radius = [np.quantile(near[own == i], 0.99) if (own == i).any() else near.max() for i in range(len(c))]
    return c, np.array(radius)


class CentroidModel:
    def __init__(self, idf: np.ndarray, vectors: dict[str, np.ndarray], k: int):
        self.idf, self.langs = idf.astype(np.float32), sorted(vectors)
        parts = [_clusters(vectors[lang], k) for lang in self.langs]
        self.centers = np.concatenate([p[0] for p in parts]).astype(np.float32) if parts else np.zeros((0, DIMS), np.float32)
        self.radius = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
        self.lang_of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])

    def predict(self, column: pa.Array):
        """(language index or -1, score, rejected) per text."""
        n = len(column)
        letters = has_letter(column)
        if not self.langs:
            return np.full(n, -1), np.zeros(n), np.zeros(n, bool)
        sim = _weigh(ngram_counts(column), self.idf) @ self.centers.T
        best = sim.argmax(1)
        per = np.stack([sim[:, self.lang_of == i].max(1) for i in range(len(self.langs))], 1)
        e = np.exp(16 * (per - per.max(1, keepdims=True)))
        score = e.max(1) / e.sum(1)
        rejected = letters & (1 - sim.max(1) > self.radius[best] * 1.05)
        score = np.where(rejected, np.minimum(score, 0.49), score)
        return np.where(letters, self.lang_of[best], -1), np.where(letters, score, 0.0), rejected


def train(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    clusters: int = 4, max_examples: int = 2400,
) -> CentroidModel:
    """Fit on documents with a language for which ``learn`` holds."""
    known = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())

    def frequencies(batches):
        total = np.zeros(DIMS, np.int64)
        n = 0
        for part in map_texts(lambda p: p)(batches):
            total += (ngram_counts(part.column(0)) > 0).sum(0)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate([[n], total]))], names=["slot", "n"]
        )

    counts = known.select(F.col(text).alias("text")).mapInArrow(frequencies, "slot bigint, n bigint")
    got = {r[0]: r[1] for r in counts.groupBy("slot").agg(F.sum("n")).collect()}  # DIMS rows
    n = got.get(-1, 0)
    df = np.array([got.get(i, 0) for i in range(DIMS)])
    idf = np.log((n + 1) / (df + 1)) + 0.1

    langs = [r[0] for r in known.select(lang).distinct().orderBy(lang).limit(max_examples).collect()]
    if not langs:
        return CentroidModel(idf, {}, clusters)
    order = Window.partitionBy(lang).orderBy(F.xxhash64(doc_id), doc_id)
    ids = known.select(doc_id, lang).withColumn("_r", F.row_number().over(order))
    ids = staged(ids.where(F.col("_r") <= max(1, max_examples // len(langs))).select(doc_id).distinct(), "lang-sample")
    sample = known.select(doc_id, F.col(lang).alias("lang"), F.col(text).alias("text")).join(ids, doc_id, "left_semi")

    def vectors(part: pa.RecordBatch) -> pa.RecordBatch:
        c = np.minimum(ngram_counts(part.column(2)), 65535).astype(np.uint16)
        return pa.RecordBatch.from_arrays([part.column(1), pa.array([r.tobytes() for r in c], pa.binary())], names=["lang", "c"])

    rows = sample.mapInArrow(map_texts(vectors), "lang string, c binary").collect()  # max_examples rows and repeated ids
    by: dict[str, list] = {}
    for name, c in sorted((r[0], r[1]) for r in rows):
        by.setdefault(name, []).append(np.frombuffer(c, np.uint16))
    return CentroidModel(idf, {k: _weigh(np.array(v, np.float32), idf) for k, v in by.items()}, clusters)


def predict(docs: DataFrame, model: CentroidModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        names = [*shared.value.langs, "und"]
        lang, score, rejected = shared.value.predict(part.column(1))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([names[i] for i in lang], pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
            names=["doc_id", "lang_pred", "score", "rejected"],
        )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(map_texts(run), "doc_id bigint, lang_pred string, score double, rejected boolean")
