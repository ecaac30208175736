"""Katz model against a dictionary model; distributions sum to one."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import katz
from ratelake.llm.queries import op7_katz
from tests.llm.util import SF, frame, spark_rows


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


class Literal:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.c, self.pair, self.h = Counter(), Counter(), Counter()
        for t in texts:
            before = "<s>"
            for w in tokens(t):
                self.c[w] += 1
                self.pair[before, w] += 1
                self.h[before] += 1
                before = w
        self.n = sum(self.c.values())
        self.dw, self.dp = (self._discounts(Counter(x.values())) for x in (self.c, self.pair))
        self.unknown = 1 - sum(self.p_word(w) for w in self.c) if self.n else 1.0
        self.left, self.seen = Counter(), Counter()
        for (h, w), c in self.pair.items():
            self.left[h] += c - self._less(c, self.dp)
            self.seen[h] += self.p_word(w)

    @staticmethod
    def _discounts(n):
        d = {}
        for r in range(1, 6):
            if not n[r] or not n[1] or not n[r + 1]:
                break
            top = 6 * n[6] / n[1]
            if top == 1:
                break
            d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top)
        if len(d) == 5 and all(0 < x < 1 for x in d.values()):
            return d
        const = min(max(n[1] / max(n[1] + 2 * n[2], 1e-9), 0.1), 0.9)
        return {r: (r - const) / r for r in range(1, 6)}

    @staticmethod
    def _less(c, d):
        return c * d[c] if c <= 5 else c - 0.01

    def p_word(self, w):
        return self._less(self.c[w], self.dw) / self.n if self.c[w] else self.unknown

    def p(self, h, w):
        if (h, w) in self.pair:
            return self._less(self.pair[h, w], self.dp) / self.h[h]
        if not self.h[h]:
            return self.p_word(w)
        return self.left[h] / self.h[h] / (1 - self.seen[h]) * self.p_word(w)

    def score(self, text):
        total, before = 0.0, "<s>"
        for w in tokens(text):
            total += math.log10(self.p(before, w))
            before = w
        return total

    def base(self, text):
        return sum(math.log10((self.c[w] + 0.5) / (self.n + 0.5 * (len(self.c) + 1))) for w in tokens(text))


def corpus():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)]
    zipf = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(rng.choices(vocab, zipf, k=rng.randrange(0, 60)))) for i in range(400)]
    rows += [(1000 + i, "hot pair " * 4 + "The end") for i in range(60)]  # a bigram in many documents
    rows += [(2000, None), (2001, ""), (2002, "new unseen words only"), (2003, "W1 w2 É é"), (2004, "w1 " * 5000)]
    rows += [(7, "w1 w2"), (7, "w1 w2"), (None, "w5 w6 w7")]
    return rows


@pytest.mark.parametrize("share", [katz.HOT_SHARE, 20])
def test_scores_match_dictionaries(spark, monkeypatch, share):
    monkeypatch.setattr(katz, "HOT_SHARE", share)
    rows = corpus()
    docs = frame(spark, [(t, "x", i) for i, t in rows], "text string, row string, doc_id long").repartition(3)
    out = spark_rows(katz.corpus_scores(docs, F.coalesce(F.col("doc_id") % 5 != 1, F.lit(True)), parts=5))
    model = Literal([t for i, t in rows if i is None or i % 5 != 1])
    want = Counter()
    for i, t in rows:
        tk = tokens(t)
        want[i, len(tk), sum(model.c[w] > 0 for w in tk), model.n, round(model.base(t), 5), round(model.score(t), 5)] += 1
    got = Counter(
        (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in out
    )
    assert got == want


def test_distributions_sum_to_one():
    model = Literal([t for i, t in corpus() if i is None or i % 5 != 1])
    for h in ["<s>", "w1", "w2", "w250", "pair", "never seen"]:
        total = sum(model.p(h, w) for w in model.c) + model.p(h, "something unknown")
        assert total == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "a b"), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in spark_rows(katz.corpus_scores(docs, F.lit(False)))}
    assert [(out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"], out[i]["score"]) for i in (1, 2)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert katz.corpus_scores(frame(spark, [], "doc_id long, text string"), F.lit(True)).count() == 0


def test_discounts_fall_back():
    assert katz.discounts(np.zeros(7)).tolist() == pytest.approx([0.9, 0.95, 2.9 / 3, 3.9 / 4, 4.9 / 5])


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    model = Literal([t for d, t in docs if not held(d)])
    got = {r["doc_id"]: r for r in spark_rows(op7_katz(spark, SF))}
    assert len(got) == len(docs)
    for d, t in docs:
        r, tk = got[d], tokens(t)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(d), len(tk), model.n)
        assert r["n_known"] == sum(model.c[w] > 0 for w in tk)
        assert r["base_score"] == pytest.approx(model.base(t)) and r["score"] == pytest.approx(model.score(t))
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
