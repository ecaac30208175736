"""Nearest labelled examples: exact search, held-out accuracy, odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ratelake.llm import toxicity as tx
from ratelake.llm.queries import op1_toxicity
from tests.llm.util import frame, spark_rows

SF = "/root/testdata/sf0.01"


def random_index(seed, n=1500, m=60):
    rng = np.random.default_rng(seed)
    rows = [np.unique(rng.geometric(0.08, rng.integers(0, 9)) % m) for _ in range(n)]
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    term = np.concatenate(rows)
    count = rng.integers(1, 4, len(term))
    y = (rng.random(n) < 0.3).astype(float)
    idf = rng.random(m) + 0.1
    index = tx.NeighbourIndex(np.arange(m, dtype=np.uint64), idf, doc, term, count, y, np.ones(n), np.arange(n) * 10)
    dense = np.zeros((n, m))
    dense[doc, term] = (1 + np.log(count)) * idf[term]
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    return index, dense


def test_search_is_exact():
    for seed in range(3):
        index, dense = random_index(seed)
        for d in range(0, len(dense), 37):
            t = np.flatnonzero(dense[d])
            idx, cos = index.nearest(t, dense[d, t], without=index.place[d])
            all_cos = dense @ dense[d]
            all_cos[d] = 0
            want = np.sort(all_cos[all_cos > 1e-12])[::-1][: tx.K]
            assert np.allclose(cos, want) and len(cos) == len(want)
            assert np.allclose(all_cos[index.ids[idx] // 10], cos)


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    x = rng.random(500)
    steps, levels = tx.isotonic(x, (rng.random(500) < x).astype(float), np.ones(500), 0.3)
    assert (np.diff(levels) > 0).all() and abs(np.interp(0.5, steps, levels) - 0.5) < 0.2


def test_odd_rows(spark):
    rows = [(i, "awful vile words " + "abc def " * (i % 5)) for i in range(0, 40)]
    rows += [(100 + i, "calm kind words " + "abc def " * (i % 5)) for i in range(200)]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(200)] + [(300, None), (None, 1), (5, 1)]
    rows += [(300, None), (301, ""), (302, "vile " * 9000), (303, "kind"), (303, "kind"), (None, "awful")]
    docs = frame(spark, [(t, i, 9) for i, t in rows], "text string, doc_id long, toxic int")
    known = frame(spark, labels, "doc_id long, toxic int")
    model = tx.train(docs, known, F.lit(True))
    out = spark_rows(tx.toxicity_scores(docs, model))
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[302]["score"] > 0.5 and by[None]["score"] > 0.5 and by[303]["score"] < 0.3
    assert set(by[302]["evidence"]) <= set(range(40)) and by[300]["evidence"] == by[301]["evidence"] == []
    for few in ([], [(1, 1)], [(1, None)]):
        same = tx.train(docs, frame(spark, few, "doc_id long, toxic int"), F.lit(True))
        assert len({r["score"] for r in spark_rows(tx.toxicity_scores(docs, same))}) == 1
    assert tx.toxicity_scores(docs.where("doc_id < 0"), model).count() == 0


def test_held_out_accuracy(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = spark_rows(op1_toxicity(spark, SF))
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in out if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)
    assert sum(p for p, y in held if y) >= 0.6 * sum(y for _, y in held)


def test_neighbours_by_all_terms(spark):
    """Texts without any label-tied term, against brute-force cosines over all their terms."""
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(400)])
    texts = [" ".join(words[rng.geometric(0.02, 30) % 400]) for _ in range(130)]
    docs = frame(spark, list(enumerate(texts)), "doc_id long, text string")
    known = frame(spark, [(i, int(i % 3 == 0)) for i in range(100)], "doc_id long, toxic int")
    model = tx.train(docs, known, F.lit(True))
    vocabulary = sorted({w for t in texts[:100] for w in t.split()})
    counts = np.array([[t.split().count(w) for w in vocabulary] for t in texts])
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * np.log((130 + 1) / ((counts > 0).sum(axis=0) + 0.5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for r in spark_rows(tx.toxicity_scores(docs.where("doc_id >= 100"), model)):
        cos = x[:100] @ x[r["doc_id"]]
        assert len(r["evidence"]) == tx.K
        assert np.allclose(cos[r["evidence"]], np.sort(cos)[::-1][: tx.K])
