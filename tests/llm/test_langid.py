"""Nearest-centroid language: held-out accuracy, rejection, odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ratelake.llm import langid
from ratelake.llm.queries import op6_language
from tests.llm.util import frame, spark_rows

SF = "/root/testdata/sf0.01"


def test_counts_stay_inside_texts():
    one = langid.ngram_counts(pa.array(["abc", "ABC", "ÉÀ", "éà", "", None, "a b", "12 !"]))
    assert (one[0] == one[1]).all() and (one[2] == one[3]).all()
    assert one[4:6].sum() == 0 and one[7].sum() == 0
    both = langid.ngram_counts(pa.array(["ab", "c"]))
    assert both[1].sum() == 0 or both[0].sum() < one[0].sum()


def test_odd_rows_and_rejection(spark):
    rows = [(i, "the cat and the dog are there " * (1 + i % 3), "en") for i in range(30)]
    rows += [(100 + i, "der hund und die katze sind dort " * (1 + i % 3), "de") for i in range(30)]
    rows += [(200, None, "en"), (201, "", None), (202, "123 !?", "de"), (203, "zqx wqz qqx xzz", None), (204, "日本語", None), (205, "the dog " * 9000, None), (1, "the dog", "en")]
    docs = frame(spark, [(x, i, t, 0.0) for i, t, x in rows], "lang string, doc_id long, text string, score double")
    out = spark_rows(langid.predict(docs, langid.train(docs, F.lit(True))))
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    assert [by[i]["lang_pred"] for i in (200, 201, 202)] == ["und"] * 3 and by[200]["score"] == 0
    assert by[205]["lang_pred"] == "en" and by[110]["lang_pred"] == "de"
    assert by[203]["rejected"] and by[203]["lang_pred"] in ("en", "de") and by[203]["score"] < 0.5
    none = langid.train(docs.where("lang IS NULL"), F.lit(True))
    assert {r["lang_pred"] for r in spark_rows(langid.predict(docs, none))} == {"und"}
    assert langid.predict(docs.where("doc_id < 0"), none).count() == 0


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = spark_rows(op6_language(spark, SF))
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(lang) and all(0 <= r["score"] <= 1 for r in out)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.97
