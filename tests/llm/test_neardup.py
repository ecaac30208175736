"""Near-duplicates against all-pairs brute force, components, odd rows."""

import random
import re

import pytest

from ratelake.llm import neardup
from ratelake.llm.components import components
from ratelake.llm.queries import op4_near_dedup
from tests.llm.util import SF, frame, spark_rows


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def literal(rows):
    sets = {}
    for d, t in rows:
        sets.setdefault(d, set()).add(shingle_set(t))
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for d in ids:
        for s in sets[d]:
            for g in s:
                where.setdefault(g, set()).add(d)
    pairs = {(a, b) for ds in where.values() if len(ds) < 400 for a in ds for b in ds if a < b}
    for a, b in pairs:
        for s in sets[a]:
            for t in sets[b]:
                i = len(s & t)
                if i and 100 * i >= 85 * (len(s) + len(t) - i):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return sorted((d, len(shingle_set(t)), find(d), find(d) == d) for d, t in rows)


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in spark_rows(df))


def near_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, d = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.choice([6, 30, 60, 200]))]
        for _ in range(rng.choice([1, 2, 4, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = word()
            rows.append((d := d + 3, " ".join(w)))
    base = [word() for _ in range(120)]  # a chain: neighbours alike, ends apart
    for i in range(40):
        base = list(base)
        base[(i * 7) % 120] = word()
        rows.append((d := d + 3, " ".join(base)))
    return rows


ODD = [(1, None), (2, ""), (4, " \t\n "), (5, "one two"), (7, "ONE  two"), (8, "one two three four five"),
       (10, "x " * 3000), (11, "x x x x x"), (13, "same doc text here now"), (13, "same doc text here now"),
       (14, "é É"), (16, "é É"), (17, "é é"), (19, "a" * 30000)]


def test_against_all_pairs(spark):
    rows = near_rows() + ODD
    docs = frame(spark, [(t, "clash", d) for d, t in rows], "text string, component string, doc_id int")
    assert got(neardup.near_duplicates(docs)) == literal(rows)


def test_split_ids_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(9, a), (9, b), (4, a + " z"), (20, b + " z")]
    docs = frame(spark, rows + [(None, a), (None, "q")], "doc_id int, text string")
    out = spark_rows(neardup.near_duplicates(docs))
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(9, 4), (4, 4), (20, 4), (None, None)}
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == ["doc_id", "text"]
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted([(4, a + " z"), (-1, a), (-1, "q")])


def test_empty(spark):
    assert neardup.near_duplicates(frame(spark, [], "doc_id bigint, text string")).count() == 0


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got(op4_near_dedup(spark, SF)) == literal([tuple(r) for r in docs])


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    links += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    rng.shuffle(links)
    out = {r.node: r.component for r in components(frame(spark, links, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert out == {x: find(x) for x in list(root) if x != 200}


def test_signature_follows_percent():
    for percent in (50, 70, 80, 85, 95):
        p, plan = percent / 100, neardup.plan_for(percent)
        missed = (1 - p**6 - 6 * (1 - p) * p**5) ** plan.chunks
        assert missed < 1e-5 and plan.far > 6 * plan.chunks * (1 - p)
    assert neardup.plan_for(85).chunks == 8 and neardup.plan_for(85).far == 21
    with pytest.raises(ValueError):
        neardup.plan_for(30)


def loose_group(rng, n, size=146, edits=(4, 9)):
    """Texts alike but mostly below the threshold: one base, each with edits of its own choice of words."""
    words = [f"w{i}" for i in range(40)]
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(*edits)):
            w[rng.randrange(size)] = rng.choice(words)
        out.append(" ".join(w))
    return out


def test_loose_group_reaches_the_last_round(spark, monkeypatch):
    """Ids with two texts in a group whose links are left for the last round."""
    rng = random.Random(11)
    texts = loose_group(rng, 160, size=90, edits=(1, 5))
    rows = [(i, t) for i, t in enumerate(texts)]
    other = loose_group(rng, 60, size=30, edits=(1, 2))
    rows += [(i, t) for i, t in enumerate(other)]  # the same ids again, with another text
    reached = []
    plain = neardup._across
    monkeypatch.setattr(neardup, "_across", lambda *a: reached.append(1) or plain(*a))
    docs = frame(spark, rows, "doc_id int, text string")
    assert got(neardup.near_duplicates(docs)) == literal(rows)
    assert reached


def test_across_with_two_texts_of_one_id(spark):
    """The last step called directly: nodes are sets, not ids."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    a, b = [word() for _ in range(20)], [word() for _ in range(110)]
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a + ["x"])), (3, " ".join(b[:-1] + ["y"]))]
    docs = frame(spark, rows, "doc_id int, text string")
    plan = neardup.plan_for(85)
    full = neardup.describe(docs, plan)
    nodes = full.groupBy("set_a", "set_b", "n_shingles").agg(neardup.F.min("doc_id").alias("rep"), neardup.F.first("sig").alias("sig"))
    nodes = neardup.staged(neardup._named(nodes), "t-nodes")
    assert nodes.select("node").distinct().count() == 4
    members = neardup.chunk_keys(nodes, plan).select("node", neardup.F.explode("keys").alias("key"))
    able = neardup._able(members.withColumn("component", neardup.F.col("node")), nodes, docs, 85, "doc_id", "text", 5)
    pairs = neardup._across(able, nodes, 85).distinct()
    found = neardup.confirm(docs, nodes, pairs, 85, "doc_id", "text", 5).collect()
    size = {r.node: (r.rep, r.n_shingles) for r in nodes.collect()}
    assert sorted(sorted((size[r.u], size[r.v])) for r in found) == [[(1, 16), (2, 17)], [(1, 106), (3, 106)]]


def test_one_text_of_several_stays_whatever_the_order(spark):
    rows = [(5, f"text number {i} " + "word " * i) for i in range(1, 9)] + [(6, "alone here")]
    kept = [
        sorted(r.text for r in neardup.drop_near_duplicates(frame(spark, order, "doc_id int, text string").repartition(n)).collect())
        for order, n in ((rows, 1), (rows[::-1], 3), (rows[4:] + rows[:4], 2))
    ]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2


def test_pairs_below_the_similarity_are_not_made(spark):
    """A loose group (all pairs alike at about 0.79) makes few pairs to confirm, and loses no link."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(1000)]
    texts = []
    for i in range(40):
        w = list(base)
        for j in rng.sample(range(0, 1000, 5), 12):
            w[j] = f"e{i}x{j}"
        texts.append(" ".join(w))
    texts += [f"{texts[0]} one more", f"{texts[1]} another end"]
    rows = list(enumerate(texts))
    docs = frame(spark, rows, "doc_id int, text string")
    plan = neardup.plan_for(85)
    nodes = neardup.describe(docs, plan).withColumnRenamed("doc_id", "rep").withColumn("node", neardup.F.col("rep"))
    nodes = neardup.staged(nodes, "t-nodes")
    members = neardup.chunk_keys(nodes, plan).select("node", neardup.F.explode("keys").alias("key"))
    able = neardup._able(members.withColumn("component", neardup.F.col("node")), nodes, docs, 85, "doc_id", "text", 5)
    pairs = {tuple(r) for r in neardup._across(able, nodes, 85).distinct().collect()}
    assert {(0, 40), (1, 41)} <= pairs and len(pairs) < 42 * 41 // 2 // 4
    assert got(neardup.near_duplicates(docs)) == literal(rows)
