"""Additive quality model: learning, held-out accuracy, odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ratelake.llm import quality
from ratelake.llm.queries import op8_quality
from tests.llm.util import frame, spark_rows

SF = "/root/testdata/sf0.01"


def test_learns_curves_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 4)).astype(np.float32)
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (np.abs(x[:, 2] - 0.5) < 0.1)).astype(float)
    model = quality.AdditiveModel().fit(x[:4000], y[:4000])
    assert ((model.score(x[4000:]) >= 0.5) == y[4000:]).mean() > 0.9
    assert (0, 1) in model.pairs


def test_features_of_odd_texts():
    x = quality.text_features(pa.array([None, "", "a", "A!! " * 4000, "é\n\né", "x | y | z"]))
    at = quality.FEATURES.index
    assert np.isfinite(x).all() and (x[0] == x[1]).all()
    assert x[3, at("upper")] == 1 and x[3, at("shouts")] > 0.4 and x[4, at("repeated_lines")] == 0.5
    assert x[5, at("bars")] > 0.2
    assert quality.text_features(pa.array([], pa.string())).shape == (0, len(quality.FEATURES))


def test_odd_rows(spark):
    docs = frame(spark, [("y", 1, "ok text here"), ("y", 2, None), ("y", None, ""), ("y", 1, "again")], "x string, doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, 1), (2, 0), (2, None), (None, 0)]):
        model = quality.train(docs, frame(spark, labels, "doc_id long, quality int"), F.lit(True))
        out = spark_rows(quality.quality_scores(docs, model))
        assert len(out) == 4 and all(0 <= r["score"] <= 1 for r in out)
        if not labels:
            assert {r["score"] for r in out} == {0.5}
    assert quality.drop_low_quality(docs, model, 0.0).collect() and quality.drop_low_quality(docs, model, 1.1).count() == 0


def test_held_out_accuracy(spark):
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = spark_rows(op8_quality(spark, SF))
    held = [(r["predicted"], good[r["doc_id"]]) for r in out if r["held_out"] and good.get(r["doc_id"]) is not None]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
