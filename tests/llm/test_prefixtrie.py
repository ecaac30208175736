"""Prefix trie by Euler tour: against a plain trie and against SQL; the list helpers alone."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratelake.llm import lists, prefixtrie
from ratelake.llm.queries import op13_prefix_trie
from tests.llm.util import SF, frame, oracle_rows, spark_rows

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, node string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}"), role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(c - rest, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
        ends[ts].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[q] for q in children[p]]
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *sums[p], sha(",".join(map(str, sorted(ends[p])))))
        for p, m in members.items()
    )


def made(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def sample(seed=1, n=60):
    rnd = random.Random(seed)
    texts = ["Hi", "Hi", "hello", "é日", "", None, "a longer text " * 3]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 12)):
            rows.append((c * 2, t, rnd.choice(["user", "assistant", None]), rnd.choice(texts[: rnd.randint(1, 7)]), "x", "y"))
    rows += [(1000 + i, t, "user", "same", "x", "y") for i in range(40) for t in range(3)]  # copies
    rows += [(2001, t, "user", f"deep {t}", "x", "y") for t in range(400)]  # one very long conversation
    rows += [(2002, None, "user", "no turn", "x", "y"), (2002, 1, "user", "b", "x", "y"), (2002, 1, "user", "b", "x", "y"), (2002, 1, "user", "a", "x", "y")]
    rows += [(None, 1, "user", "no conversation", "x", "y"), (-7, 1, "user", "below zero", "x", "y"), (-5, 1, "user", "base", "x", "y")]
    return rows + [(3000, 0, "user", "long " * 50_000, "x", "y")]


def test_against_plain_trie(spark):
    rows = sample()
    assert made(prefixtrie.conversation_trie(frame(spark, rows, SCHEMA).repartition(6))) == plain(rows)


def test_in_small_blocks(spark):
    """Blocks of a few rows and a short last walk, so that every round runs."""
    rows = sample(2, 40)
    got = prefixtrie.conversation_trie(frame(spark, rows, SCHEMA).repartition(3), fan=30, small=4, ends=3)
    assert made(got) == plain(rows)


def test_few_rows(spark):
    for rows in ([], [(3, 0, "user", "x", "", "")], [(None, 0, "user", "x", "", "")]):
        assert made(prefixtrie.conversation_trie(frame(spark, rows, SCHEMA))) == plain(rows)


def test_ordered_turns_over_many_parts(spark):
    rows = [(1, t // 7, "user", str(t % 3), "", "") for t in range(500)] + [(2, 0, None, None, "", "")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = prefixtrie.ordered_turns(frame(spark, rows, SCHEMA)).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    digests = sorted((t // 7, sha("4:user" + str(t % 3))) for t in range(500))
    assert [(r.depth, r.digest) for r in sorted(got, key=lambda r: r.depth) if r.conv_id == 1] == [(i + 1, d) for i, (_, d) in enumerate(digests)]


@pytest.mark.parametrize("small", [1, 5, 10_000])
def test_list_places(spark, small):
    rnd = random.Random(small)
    order = list(range(3000))
    rnd.shuffle(order)
    links = [(a, b) for a, b in zip(order, order[1:] + [-1])]
    out = lists.list_places(frame(spark, links, "id bigint, next bigint").repartition(5), len(links), small)
    assert {r.id: r.position for r in out.collect()} == {x: i for i, x in enumerate(order)}


@pytest.mark.parametrize("fan", [3, 50, 10_000])
def test_running_totals_and_followers(spark, fan):
    rnd = random.Random(fan)
    rows = [(k, p, rnd.randint(-5, 9)) for k in range(3) for p in range(400 - k * 90)]
    df = frame(spark, rows, "k bigint, p bigint, x bigint")
    got = {(r.k, r.p): r.x for r in lists.running_totals(df, ["k"], "p", ["x"], 400, fan).collect()}
    want = {(k, p): sum(x for a, b, x in rows if a == k and b <= p) for k, p, _ in rows}
    assert got == want
    ids = [(rnd.choice([0, 0, 1, 2]), i) for i in rnd.sample(range(500), 300)]
    out = lists.followers(frame(spark, ids, "k bigint, i bigint"), "k", "i", 500, fan).collect()
    want = {(k, i): min((b for a, b in ids if a == k and b > i), default=None) for k, i in ids}
    assert {(r.key, r.id): r.following for r in out} == want


def test_numbers(spark):
    df = frame(spark, [(x % 11,) for x in range(200)], "x bigint")
    got = lists.numbered(df, [F.col("x").desc()], "n", "t").collect()
    assert [r.x for r in sorted(got, key=lambda r: r.n)] == sorted((x % 11 for x in range(200)), reverse=True)
    assert sorted(r.n for r in got) == list(range(200))


def test_query_against_sql(spark):
    out = op13_prefix_trie(spark, SF)
    assert [out.schema[c].dataType.simpleString() for c in COLUMNS] == ["bigint"] * 7 + ["string"]
    want = oracle_rows(prefixtrie.ORACLE_SQL)
    key = lambda r: tuple(-1 if r[c] is None else r[c] for c in COLUMNS)
    assert sorted(map(key, spark_rows(out))) == sorted(map(key, want)) and want
