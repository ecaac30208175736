"""Source divergence: stripes against a plain count and against SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ratelake.llm import divergence
from ratelake.llm.queries import op11_divergence
from tests.llm.util import SF, frame, oracle_rows, spark_rows

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, counts string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang or "", source or ""))
        docs[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        of = {s: shares(counts[lang, s]) for g, s in groups if g == lang}
        q = shares(sum((counts[lang, s] for s in of), Counter()))
        for s, p in of.items():
            pair = [(-sum(abs(p[t] - of[o][t]) for t in kept), o.encode()) for o in of if o != s]
            term = [(q[t] - p[t], t.encode()) for t in kept if counts[lang, s][t] > 0 and p[t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, i.decode(), -f, r) for r, (f, i) in enumerate(items, 1)]
    return sorted(out)


def made(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def sample(seed=1, n=300):
    rnd = random.Random(seed)
    words = ["The", "the", "tHE", "été", "Été", "日本", "a", "b1b", "x_y", "ünder", "K", "zz", "q" * 300]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(words[: rnd.randint(2, len(words))]) for _ in range(rnd.randint(0, 30)))
        # One source holds a third of all rows.
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "ß", None, ""])
        rows.append((i, text, rnd.choice(["en", "en", "en", None, "fr"]), source, "x", "y"))
    rows += [rows[0]] * 5 + [(None, None, "en", "none", None, None), (7, "", "empty", "only", "x", "y"), (8, "1 2 3", "empty", "more", "x", "y")]
    return rows + [(9, "long words " * 30_000, "fr", "long", "x", "y")]


@pytest.mark.parametrize("min_docs", [1, 5, 30])
def test_against_plain_counts(spark, min_docs):
    rows = sample()
    docs = frame(spark, rows, SCHEMA).repartition(5)
    assert made(divergence.divergences(docs, min_docs=min_docs)) == plain(rows, min_docs)


def test_spills_chunks_and_blocks(spark):
    rows = sample(2, 200)
    docs = frame(spark, rows, SCHEMA).repartition(3)
    got = divergence.divergences(docs, min_docs=2, top=3, chunk=2, block=2, entries=1)
    assert made(got) == plain(rows, 2, top=3)


def test_stripes_are_whole(spark):
    rows = sample(3)
    out = divergence.stripes(frame(spark, rows, SCHEMA).repartition(4), min_docs=1).collect()
    assert len({(r.lang, r.term) for r in out}) == len(out)
    want = Counter()
    for _, text, lang, source, *_ in rows:
        want.update((lang or "", source or "", t) for t in TERM.findall((text or "").translate(LOWER)))
    got = {(r.lang, s, r.term): n for r in out if r.term for s, n in zip(r.sources, r.counts)}
    assert got == dict(want)


def test_long_text_in_stretches(monkeypatch):
    monkeypatch.setattr(divergence, "STRETCH", 16)
    held = divergence.Stripes()
    text = "some words of a text, averyverylongwordofmorethansixteen and more of a text " * 20
    held.add("en", "s", text)
    assert held.counts["en", "s"] == Counter(t.encode() for t in TERM.findall(text))
    assert set(held.docs["en"].values()) == {1}


def test_counts_beyond_64_bits():
    import numpy as np

    count, n = np.array([3 * 10**10, 0]), np.array([4 * 10**12, 7])
    assert divergence._shares(count, n, 9).tolist() == [1 + 10**9 * (c + 5) // (m + 45) for c, m in zip(count.tolist(), n.tolist())]


def test_empty_table(spark):
    out = divergence.divergences(frame(spark, [], SCHEMA))
    assert out.collect() == []
    assert [f.dataType.simpleString() for f in out.schema] == ["string"] * 4 + ["bigint", "int"]


def test_query_against_sql(spark):
    key = lambda r: tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank"))
    got, want = spark_rows(op11_divergence(spark, SF)), oracle_rows(divergence.ORACLE_SQL)
    assert sorted(map(key, got)) == sorted(map(key, want)) and got
