"""Benchmark windows against a plain scan, slices, odd rows."""

import hashlib
import random
import re

from ratelake.llm import decontaminate as dec
from ratelake.llm.queries import op5_decontaminate
from tests.llm.util import SF, frame, spark_rows


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def literal(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        for s in range(max(1, len(w) - 9)):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(str(i))
    lengths = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                own = windows.get(tuple(w[s : s + n]))
                if own:
                    found |= own
                    hit.update(range(s, s + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((repr(d), len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out)


def got(df):
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((repr(r["doc_id"]), *[r[c] for c in cols]) for r in spark_rows(df))


def case():
    rng = random.Random(3)
    vocab = ["alpha", "beta", "gamma", "delta", "x1", "é", "zeta9"]
    seq = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(seq(n))) for i, n in enumerate([30, 10, 11, 9, 5, 4, 3, 2, 12, 25])]
    items += [(50, items[0][1].upper()), (51, "beta " * 14), (50, "short one"), (None, "no id here"), (60, None), (61, " .,! ")]
    docs = []
    for d in range(120):
        parts = seq(rng.randrange(0, 30))
        for _ in range(rng.randrange(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(w) - 3))
            parts += w[a : a + rng.randrange(1, 20)] + seq(rng.randrange(0, 4))
        docs.append((d, rng.choice([" ", ", ", " - "]).join(parts)))
    docs += [(500, None), (501, ""), (502, "beta " * 4000), (503, "Beta-beta beta"), (7, "gamma"), (7, "gamma"), (None, items[0][1])]
    return docs, items


def test_against_plain_scan(spark):
    docs, items = case()
    d = frame(spark, [(t, i, "x") for i, t in docs], "text string, doc_id int, items string")
    b = frame(spark, items, "item_id int, text string")
    assert got(dec.digest_rows(dec.find_benchmark(d, b))) == literal(docs, items)


def test_slices_agree(spark):
    docs, items = case()
    d, b = frame(spark, docs, "doc_id int, text string"), frame(spark, items, "item_id int, text string")
    assert got(dec.digest_rows(dec.find_benchmark(d, b, slice_words=200))) == literal(docs, items)


def test_empty_tables(spark):
    docs, items = case()
    none = frame(spark, [], "item_id int, text string")
    d = frame(spark, docs[:5], "doc_id int, text string")
    assert got(dec.digest_rows(dec.find_benchmark(d, none))) == literal(docs[:5], [])
    e = frame(spark, [], "doc_id int, text string")
    assert dec.find_benchmark(e, frame(spark, items, "item_id int, text string")).count() == 0


def test_drop(spark):
    docs, items = case()
    d, b = frame(spark, docs, "doc_id int, text string"), frame(spark, items, "item_id int, text string")
    out = dec.drop_contaminated(d, b)
    clean = sorted(r[0] for r in literal(docs, items) if not r[-1])
    assert out.columns == d.columns and sorted(repr(r.doc_id) for r in out.collect()) == clean


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = literal(docs, items)
    assert got(op5_decontaminate(spark, SF)) == want and any(r[-1] for r in want)
